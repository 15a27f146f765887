import itertools
import math
import os
import random

import pytest
from conftest import by, rows

from cladegrid.operators import evidence, expect, joins, occupancy, pairs, ranking, rarefaction, reuse
from cladegrid.operators.expect import QualityError
from cladegrid.plans import genomics
from cladegrid.sources import groups


def orthology_run(folder, name, header, lines):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as handle:
        handle.write("\n".join(["\t".join(header), *("\t".join(x) for x in lines)]) + "\n")
    return folder


@pytest.fixture()
def members(spark):
    ids = ["SpA__G1", "SpA__G2", "SpB__G1", "SpB__G9"]
    return spark.createDataFrame([(i, *i.split("__"), "S1", "g") for i in ids], "stable_id string, species_id string, gene_id string, subfamily string, group string")


def test_pan_family(spark, folder, members):
    lines = [["H1", "OG1", "n0", "SpA__G1, SpA__G2;SpA__X", "SpB__G1"], ["H2", "OG2", "n0", "SpA__X", "NA"]]
    orthology_run(folder, f"{groups.NODE_FOLDER}/N2.tsv", ["HOG", "OG", "Gene Tree Parent Clade", "SpA", "SpB"], lines)
    orthology_run(folder, f"{groups.NODE_FOLDER}/N11.tsv", ["HOG", "SpA"], [])
    source = groups.select_group_table(spark, folder)
    assert (source.node, source.node_status, source.group_type) == ("N2", "AUTO_DISCOVERY", "HOG")
    wide, column = groups.read_group_table(spark, source)
    tables = genomics.pan_family(wide, column, source, members, ["SpA", "SpB"])
    row = tables["classification"].collect()
    assert len(row) == 1 and row[0].pan_family_class == "Core" and row[0].species_occupancy == 2
    assert (row[0].family_gene_count, row[0].max_copy_number, row[0].single_copy_species_fraction) == (3, 2, 0.5)
    assert row[0].presence_basis == "ANNOTATION_AND_HOG_MEMBERSHIP" and not row[0].is_private
    assert rows(tables["membership"], "stable_id", "copy_number_in_species") == {("SpA__G1", 2), ("SpA__G2", 2), ("SpB__G1", 1)}
    assert rows(tables["unassigned"], "stable_id", "reason") == {("SpB__G9", "NOT_FOUND_IN_SELECTED_HOG_NODE")}
    assert rows(tables["presence"]) == {("H1", 1, 1)}
    assert rows(tables["rarefaction"], "n_species", "iteration", "subset", "pan_family_hog_count") == {(1, 1, "SpA", 1), (1, 2, "SpB", 1), (2, 1, "SpA,SpB", 1)}
    assert tables["rarefaction_summary"].count() == 2 and tables["class_summary"].count() == 8


def test_wrong_prefix_and_missing_unit(spark, folder, members):
    orthology_run(folder, f"{groups.NODE_FOLDER}/N0.tsv", ["HOG", "SpA", "SpB"], [["H1", "SpB__G1", ""]])
    source = groups.select_group_table(spark, folder, "N0")
    assert source.node_status == "CONFIGURED"
    wide, column = groups.read_group_table(spark, source)
    with pytest.raises(QualityError, match="PREFIX_IS_UNIT"):
        genomics.pan_family(wide, column, source, members, ["SpA", "SpB"])
    with pytest.raises(ValueError, match="SpC"):
        genomics.pan_family(wide, column, source, members, ["SpA", "SpC"])
    with pytest.raises(FileNotFoundError):
        groups.select_group_table(spark, folder, "N7")


def test_fallback_group_table(spark, folder):
    orthology_run(folder, "Orthogroups/Orthogroups.tsv", ["Orthogroup", "SpA"], [["OG1", "SpA__G1"]])
    source = groups.select_group_table(spark, folder)
    assert (source.node_status, source.group_type, source.analysis_unit) == ("AUTO_ORTHOGROUP_FALLBACK", "ORTHOGROUP", "ORTHOFINDER_ORTHOGROUP")
    assert groups.read_group_table(spark, source)[1] == "Orthogroup"


@pytest.mark.parametrize("n,max_exact,iterations", [(4, 1000, 5000), (6, 10, 12), (6, 10, 100), (24, 300, 40), (70, 80, 30)])
def test_rarefaction_by_brute_force(spark, n, max_exact, iterations):
    rng = random.Random(n)
    units = [f"u{i:02d}" for i in range(n)]
    held = {g: {u for u in units if rng.random() < 0.7} for g in range(30)}
    df = spark.createDataFrame([(g, u) for g, s in held.items() for u in s], "g long, u string")
    found = rarefaction.rarefaction(df, "g", "u", units, max_exact, iterations, seed=3).collect()
    for k in range(1, n + 1):
        own = [r for r in found if r.subset_size == k]
        assert len(own) == min(math.comb(n, k), max(iterations, max_exact if math.comb(n, k) <= max_exact else 0)), k
        assert len({r.subset for r in own}) == len(own)
        assert sorted(r.iteration for r in own) == list(range(1, len(own) + 1))
    for r in found:
        subset = set(r.subset.split(","))
        assert len(subset) == r.subset_size
        assert r.pan_count == sum(bool(s & subset) for s in held.values())
        assert r.core_count == sum(subset <= s for s in held.values())
    exact = [r for r in sorted(found, key=lambda r: (r.subset_size, r.iteration)) if r.sampling == "exact" and r.subset_size == 2]
    assert [r.subset for r in exact] == ([",".join(c) for c in itertools.combinations(units, 2)] if exact else [])


def test_drawn_ranks_are_a_permutation():
    for size in (1, 2, 3, 50, 5041, 5042):
        assert sorted(rarefaction.permuted(i, size, 5, 3) for i in range(size)) == list(range(size))
    ranks = range(math.comb(7, 3))
    assert [tuple(rarefaction.subset_of_rank(r, 7, 3)) for r in ranks] == list(itertools.combinations(range(7), 3))
    assert len({rarefaction.permuted(i, math.comb(200, 90), 5, 90) for i in range(500)}) == 500


def test_subsets_are_sent_in_parts(spark, monkeypatch):
    units = [f"u{i}" for i in range(6)]
    df = spark.createDataFrame([(g, units[(g * i) % 6]) for g in range(20) for i in range(3)], "g long, u string")
    whole = rows(rarefaction.rarefaction(df, "g", "u", units, 10, 12))
    monkeypatch.setattr(rarefaction, "PART_BYTES", 200)
    assert rows(rarefaction.rarefaction(df, "g", "u", units, 10, 12)) == whole and len(whole) == 49


def test_pairs_merge_in_arrival_order(spark):
    membership = spark.createDataFrame(
        [("H1", "R", "r1"), ("H1", "A", "a1"), ("H1", "B", "b1"), ("H1", "B", "b2"), ("H2", "R", "r2"), ("H2", "R", "r3"), ("H2", "A", "a2")],
        "HOG_ID string, species_id string, stable_id string",
    )
    listed = spark.createDataFrame(
        [("a1", "r1", "WGD", "A", 2), ("r1", "a1", "WGD", "R", 1), ("a1", "a1", "WGD", "A", 3), ("a1", "zz", "WGD", "A", 4), ("b2", "a1", "Tandem", "B", 5)],
        "stable_id_1 string, stable_id_2 string, duplication_mode string, species_id string, ordinal long",
    )
    members = membership.select("stable_id").distinct()
    found = by(genomics.substitution_pairs(members, membership, listed, "R"), "stable_id_1", "stable_id_2")
    assert set(found) == {("a1", "r1"), ("a1", "b2")}
    merged = found[("a1", "r1")]
    assert merged["pair_type"] == "orthology_single_copy_to_reference;duplication_WGD" and merged["group_id"] == "H1;R"


def test_pair_strata_and_summary(spark):
    labels = spark.createDataFrame([("A1", "S1", "Cultivated", "Core"), ("B1", "S1", "Wild", "Core"), ("A2", "S2", None, "Shell")], "stable_id string, subfamily string, group string, pan_family_class string")
    modes = spark.createDataFrame([("A1", "WGD"), ("B1", "WGD")], "stable_id string, duplication_mode string")
    wanted = spark.createDataFrame([("A1", "B1"), ("A1", "A2")], "stable_id_1 string, stable_id_2 string")
    estimates = spark.createDataFrame([("A1", "B1", 0.1, 0.0)], "stable_id_1 string, stable_id_2 string, Ka double, Ks double")
    estimates = pairs.with_ratio(estimates, "Ka", "Ks", None)
    full, summary = genomics.annotated_estimates(wanted, estimates, labels, modes)
    found = by(full, "stable_id_1", "stable_id_2")
    first, second = found[("A1", "B1")], found[("A1", "A2")]
    assert [first[c] for c in genomics.PAIR_STRATA.values()] == ["S1", "Mixed", "Core", "WGD"]
    assert first["qc_status"] == "KS_ZERO;RATIO_NON_FINITE" and first["Ka_Ks"] == float("inf")
    assert [second[c] for c in genomics.PAIR_STRATA.values()] == ["Mixed", "Unassigned", "Mixed", "Unassigned"]
    assert second["qc_status"] == "FAILED"
    table = by(summary, "stratification", "stratum", "metric")
    assert table[("SUBFAMILY", "S1", "Ka")]["median"] == 0.1 and table[("SUBFAMILY", "Mixed", "Ka")]["n_pairs"] == 0
    assert table[("GROUP", "Mixed", "Ka_Ks")]["maximum"] == float("inf")


def test_limit_above_pushed_size(spark):
    df = spark.range(5000).selectExpr("id % 2 AS k", "id AS v")
    found = ranking.first_n_per_key(df, ["k"], ["v"], 1500)
    assert by(found.groupBy("k").agg({"v": "max", "*": "count"}), "k")[0] == {"k": 0, "max(v)": 2998, "count(1)": 1500}


def test_reuse(spark):
    todo = reuse.with_signature(spark.createDataFrame([("a",), ("b",), ("c",)], "id string"), ["id"], {"m": "x"})
    previous = todo.where("id <> 'c'").selectExpr("*", "IF(id = 'b', 'FAILED', 'PASS') AS qc_status")
    reused, pending = reuse.split_by_reuse(todo, previous)
    assert rows(reused, "id") == {("a",)} and rows(pending, "id") == {("b",), ("c",)}


def test_evidence_modes(spark):
    hmm, blast = (spark.createDataFrame([(x,) for x in ids], "stable_id string") for ids in ("ab", "bc"))
    flags = evidence.combine_sources({"hmm": hmm, "blast": blast}, "stable_id")
    both = by(evidence.decide(flags, "intersection"), "stable_id")
    assert [both[i]["rejection_reason"] for i in "abc"] == ["missing_blast_evidence", None, "missing_hmm_evidence"]
    assert rows(evidence.decide(flags, "blast_only").where("decision = 'PASS'"), "stable_id") == {("b",), ("c",)}
    assert rows(evidence.decide(flags, "union"), "decision") == {("PASS",)}


def test_classify_elements_prefers_the_map(spark):
    hits = spark.createDataFrame([("E1", "own"), ("E2", "own"), ("E3", None)], "element string, major_class string")
    categories = spark.createDataFrame([("E1", "mapped")], "element string, major_class string")
    assert rows(evidence.classify_elements(hits, categories), "element", "major_class") == {("E1", "mapped"), ("E2", "own"), ("E3", "Unclassified")}


def test_integration_suffixes_and_duplicates(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "stable_id string, x int")
    other = spark.createDataFrame([("a", 9, "q"), ("a", 8, "p")], "stable_id string, x int, y string")
    wide = joins.integrate(base, [(None, "", []), (other, "_o", ["x"])], "stable_id")
    assert by(wide, "stable_id")["a"] == {"stable_id": "a", "x": 1, "x_o": 8, "y": "p"} and by(wide, "stable_id")["b"]["y"] is None


def test_master_table(spark):
    members = spark.createDataFrame([("A1", "SpA", "g1"), ("B1", "SpB", "g2")], "stable_id string, species_id string, gene_id string")
    kaks = spark.createDataFrame([("A1", "B1", 0.1, 0.5, 0.2), ("A1", "C1", 0.3, 0.5, None)], "stable_id_1 string, stable_id_2 string, Ka double, Ks double, Ka_Ks double")
    per_gene = spark.createDataFrame([("A1", "x", 2), ("A1", "a", 3)], "stable_id string, major_class string, element_count long")
    membership = spark.createDataFrame([("H1", "A1", "SpA")], "HOG_ID string, stable_id string, species_id string")
    classes = spark.createDataFrame([("H1", "Core")], "HOG_ID string, pan_family_class string")
    found = by(genomics.master_table(members, kaks=kaks, promoter_per_gene=per_gene, membership=membership, classes=classes), "stable_id")
    a = found["A1"]
    assert (a["kaks_pair_count"], a["median_Ka"], a["median_Ka_Ks"]) == (1, pytest.approx(0.2), 0.2)
    assert (a["cis_element_total"], a["cis_element_major_classes"], a["pan_family_class"], a["species_id_pan_family"]) == (5, "a;x", "Core", "SpA")
    assert found["B1"]["HOG_ID"] is None and found["B1"]["kaks_pair_count"] == 1


def test_expectations(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), (None, None), ("b", float("inf"))], "k string, v double")
    assert rows(expect.duplicate_keys(df, ["k"]), "key", "detail") == {("a", "rows=2")}
    assert expect.outside_domain(df, "v", "k").count() == 2 and expect.outside_domain(df, "v", "k", nullable=False).count() == 3
    with pytest.raises(QualityError):
        expect.require_columns(df, ["z"])
    expect.enforce([expect.empty_result(df, "empty")])
    with pytest.raises(QualityError, match="empty"):
        expect.enforce([expect.empty_result(df.where("v = 99"), "empty")])
    species = spark.createDataFrame([("A", "B"), ("B", "B"), ("C", "Z"), ("C", None)], "species_id string, outgroup string")
    samples = spark.createDataFrame([("s1", "A"), ("s1", "Q")], "sample_id string, species_id string")
    assert rows(expect.metadata_violations(species, samples), "rule") == {(r,) for r in ("SPECIES_ID_UNIQUE", "OUTGROUP_KNOWN", "OUTGROUP_NOT_SELF", "SAMPLE_ID_UNIQUE", "SAMPLE_SPECIES_KNOWN")}


def test_copies_of_a_heavy_pair(spark):
    df = spark.range(4000).selectExpr("IF(id < 3000, 0, id) AS g", "'u' AS u", "id AS m")
    found = occupancy.with_copies(df, "g", "u", "m")
    assert found.count() == 4000 and by(found.groupBy("g").agg({"copies_in_unit": "max", "*": "count"}), "g")[0]["max(copies_in_unit)"] == 3000
