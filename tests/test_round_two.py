"""Regression tests: exact tails at any size, infinite values, and labels with a dot."""

from math import comb

from conftest import by, rows

from cladegrid.functions.stats import rank_sum_counts, rank_sum_exact
from cladegrid.operators import evidence
from cladegrid.operators.expression import long_from_wide, wide_with_status
from cladegrid.operators.grouptests import inference_note
from cladegrid.operators.occupancy import membership_from_wide
from cladegrid.sources import delimited


def test_rank_sum_counts_are_exact_for_large_sides():
    counts = rank_sum_counts(8, 7000)
    assert sum(counts) == comb(7008, 8) and min(counts) >= 1
    assert f"{rank_sum_exact(0.99 * 8 * 7000, 8, 7000):.4e}" == f"{2 * (sum(counts[55440:]) / comb(7008, 8)):.4e}"


def test_infinite_values_are_no_units(spark):
    units = spark.createDataFrame([("m", "a", float("inf")), ("m", "a", 1.0), ("m", "b", 1.0), ("m", "b", 2.0)], "metric string, g string, v double")
    assert "withheld" in by(inference_note(units, ["metric"], "g", "v"), "metric")["m"]["inference_note"]


def test_labels_with_a_dot(spark):
    wide = spark.createDataFrame([("g1", "x, y", None)], "grp string, `O.sativa` string, `Z.mays` string")
    assert rows(membership_from_wide(wide, "grp", ["O.sativa", "Z.mays"])) == {("g1", "O.sativa", "x"), ("g1", "O.sativa", "y")}
    members = spark.createDataFrame([("x",)], "stable_id string")
    matrix = spark.createDataFrame([("x", 2.0)], "stable_id string, `leaf.1` double")
    joined = wide_with_status(members, matrix, "stable_id", ["leaf.1"])
    assert {r["sample_id"] for r in long_from_wide(joined, ["stable_id"], ["leaf.1"], 1.0).collect()} == {"leaf.1"}


def test_files_with_other_column_orders_are_put_together_by_name(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("stable_id\tgene_start\tgene_end\nA__a\t1\t9\n")
    (tmp_path / "b.tsv").write_text("stable_id\tgene_end\tgene_start\nB__b\t8\t2\n")
    (tmp_path / "c.tsv").write_text("stable_id\tgene_start\nC__c\t3\n")
    found = delimited.canonical_maps(spark, [str(tmp_path / f"{n}.tsv") for n in "abc"])
    assert {tuple(r) for r in found.select("stable_id", "gene_start", "gene_end").collect()} == {("A__a", 1, 9), ("B__b", 2, 8), ("C__c", 3, None)}


def test_members_with_several_modes_get_none(spark):
    members = spark.createDataFrame([("x",), ("y",), ("z",), ("n",)], "k string")
    modes = spark.createDataFrame([("x", "WGD"), ("x", "WGD"), ("y", "TD"), ("y", "WGD"), ("n", None)], "k string, m string")
    found = {r["k"]: r["m"] for r in evidence.assign_modes(members, modes, "k", "m").collect()}
    assert found == {"x": "WGD", "y": None, "z": "Unclassified", "n": "Unclassified"}
