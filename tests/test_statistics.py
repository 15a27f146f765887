import itertools
import math
import random

import numpy as np
import pandas as pd
import pytest
from conftest import by, rows
from pyspark.sql import functions as F

from cladegrid.functions import stats
from cladegrid.operators import cumulative, describe, grouptests
from cladegrid.operators.expect import QualityError
from cladegrid.plans import genomics


def test_adjustment_within_one_family(spark):
    df = spark.createDataFrame([("a", 0.01), ("a", 0.04), ("a", 0.03), ("a", 1.0), ("a", None), ("b", 0.5)], "k string, p double")
    found = {(r.k, r.p): r.q for r in cumulative.adjusted_p_values(df, ["k"], "p", "q").collect()}
    assert found[("a", 0.01)] == pytest.approx(0.04)
    assert found[("a", 0.04)] == pytest.approx(0.0533333333)
    assert found[("a", 0.03)] == pytest.approx(0.0533333333)
    assert found[("a", 1.0)] == 1.0
    assert found[("a", None)] is None
    assert found[("b", 0.5)] == 0.5


def test_chi_square_tail_closed_forms():
    assert stats.chi_square_tail(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi_square_tail(5.991464547107979, 2) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi_square_tail(7.814727903251179, 3) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi_square_tail(11.070497693516351, 5) == pytest.approx(0.05, abs=1e-9)
    assert stats.chi_square_tail(0.0, 4) == 1.0


@pytest.mark.parametrize("m,n", [(2, 3), (4, 4), (3, 6), (5, 5)])
def test_rank_sum_counts_by_enumeration(m, n):
    counts = [0] * (m * n + 1)
    for chosen in itertools.combinations(range(m + n), m):
        counts[sum(chosen) - m * (m - 1) // 2] += 1
    assert list(stats.rank_sum_counts(m, n)) == counts


def test_rank_sum_p_values(spark):
    assert stats.rank_sum_tail(4, 4)[16] == pytest.approx(2 / math.comb(8, 4))
    assert stats.rank_sum_tail(4, 4)[8] == 1.0
    found = {(r.m, r.n, r.u): r.p for r in stats.rank_sum_tails(spark.createDataFrame([(3, 5), (8, 9)], "m long, n long")).collect()}
    assert found[3, 5, 15] == pytest.approx(2 / math.comb(8, 3)) and found[8, 9, 72] == pytest.approx(2 / math.comb(17, 8))
    assert len(found) == 9 + 37
    # published example: U = 25 of 10 x 10 without ties
    rows = [(25.0, 10, 10, 0.0), (50.0, 10, 10, 0.0), (0.0, 3, 3, 210.0)]
    p = [r.p for r in spark.createDataFrame(rows, "u double, m long, n long, t double").select(stats.rank_sum_normal(*map(F.col, "umnt")).alias("p")).collect()]
    assert p[0] == pytest.approx(0.064022, abs=1e-5) and p[1] == p[2] == 1.0


def test_normal_tail(spark):
    z = [-1.0, 0.0, 1e-9, 0.3, 1.0, 3.5, 3.54, 8.0, 20.0]
    found = spark.createDataFrame([(v,) for v in z], "z double").select("z", stats.normal_tail(F.col("z")).alias("p")).collect()
    for r in found:
        assert r.p == pytest.approx(min(1.0, math.erfc(r.z / math.sqrt(2))), rel=1e-12)


def separated(spark):
    values = [1.0, 2.0, 1.5, 2.5, 10.0, 11.0, 12.0, 9.0]
    data = [(f"G{i}", f"Sp{i % 4}", "PASS", "A" if i < 4 else "B", v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "stable_id string, species_id string, structure_qc string, subfamily string, gene_length double")


def test_separated_groups(spark):
    tables = genomics.group_tests(separated(spark), ["subfamily"], ["gene_length"])
    overall, pair, qc = (tables[k].collect()[0] for k in ("global", "pairwise", "quality"))
    assert overall.analysis_unit == "SPECIES_MEDIAN" and overall.test_name == "Kruskal-Wallis"
    assert overall.p_value == pytest.approx(0.020921335, abs=1e-6) and overall.test_status == "PASS"
    assert overall.inference_warning == "LOW_SPECIES_REPLICATION"
    assert pair.test_status == "PASS" and pair.rank_biserial_effect == -1.0 and pair.u_statistic == 0.0
    assert pair.p_value == pytest.approx(2 / 70) and pair.p_adjusted_bh == pytest.approx(pair.p_value)
    assert (pair.n_items_1, pair.n_units_1) == (4, 4)
    assert qc.eligible_unit_group_cells == 8 and qc.low_power_warning


def test_gene_tables_have_their_column_names(spark):
    tables = genomics.gene_group_tests(separated(spark), ["subfamily"], ["gene_length"])
    overall, pair, qc = (tables[k].collect()[0] for k in ("global", "pairwise", "quality"))
    assert (overall.n_genes, overall.n_species, overall.n_species_group_units, overall.min_group_units) == (8, 4, 8, 2)
    assert (pair.n_genes_1, pair.n_species_2, pair.median_gene_1, pair.median_species_unit_2) == (4, 4, 1.75, 10.5)
    assert pair.median_species_unit_difference == -8.75
    assert (qc.input_gene_rows, qc.eligible_gene_rows, qc.excluded_gene_rows, qc.eligible_species_group_units) == (8, 8, 0, 8)
    assert not {"n_items", "n_units"} & {c for t in tables.values() for c in t.columns}


def test_one_unit_per_group_withholds(spark):
    data = [("A1", "SpA", "Cultivated", 2), ("A2", "SpA", "Cultivated", 3), ("B1", "SpB", "Wild", 8), ("B2", "SpB", "Wild", 9)]
    df = spark.createDataFrame(data, "stable_id string, species_id string, group string, exon_count int")
    tables = genomics.group_tests(df, ["group"], ["exon_count"])
    overall, pair, qc = (tables[k].collect()[0] for k in ("global", "pairwise", "quality"))
    assert overall.test_status == "INSUFFICIENT_GROUP_UNITS" and overall.p_value is None
    assert pair.test_status == "INSUFFICIENT_GROUP_UNITS" and pair.p_value is None
    assert pair.inference_warning == "INSUFFICIENT_SPECIES_REPLICATION" and pair.rank_biserial_effect == -1.0
    assert qc.inference_warning == "INSUFFICIENT_SPECIES_REPLICATION"


def test_equal_values_have_no_variance(spark):
    data = [(f"G{i}", f"Sp{i % 3}", "A" if i < 3 else "B", 5.0) for i in range(6)]
    df = spark.createDataFrame(data, "stable_id string, species_id string, subfamily string, m double")
    overall = genomics.group_tests(df, ["subfamily"], ["m"])["global"].collect()[0]
    assert (overall.h_statistic, overall.p_value, overall.test_status) == (0.0, 1.0, "ZERO_VARIANCE")


def test_conflicting_assignment_is_refused(spark):
    data = [("A1", "SpA", "x", 1.0), ("A1", "SpA", "y", 2.0)]
    df = spark.createDataFrame(data, "stable_id string, species_id string, group string, m double")
    with pytest.raises(QualityError, match="ONE_GROUP_PER_ITEM"):
        genomics.group_tests(df, ["group"], ["m"])


def test_kruskal_with_ties_by_brute_force(spark):
    rng = random.Random(3)
    data = [(f"i{i}", f"u{i}", f"g{i % 3}", float(rng.randint(0, 6))) for i in range(40)]
    df = spark.createDataFrame(data, "stable_id string, species_id string, g string, m double")
    comparison = grouptests.GroupComparison(df, "g", ["m"])
    h = comparison.global_tests().collect()[0].h_statistic
    frame = pd.DataFrame(data, columns=["i", "u", "g", "m"])
    ranks = frame["m"].rank()
    n = len(frame)
    raw = 12 / (n * (n + 1)) * sum(ranks[frame.g == g].sum() ** 2 / (frame.g == g).sum() for g in ("g0", "g1", "g2")) - 3 * (n + 1)
    ties = frame["m"].value_counts()
    assert h == pytest.approx(raw / (1 - (ties**3 - ties).sum() / (n**3 - n)))
    for r in comparison.pair_statistics().collect():
        a, b = frame.m[frame.g == r.group_1], frame.m[frame.g == r.group_2]
        assert r.u_statistic == sum((x > y) + 0.5 * (x == y) for x in a for y in b)


def test_notes(spark):
    data = [("p", "a", 1.0), ("p", "a", 1.0), ("p", "b", 1.0), ("q", "a", 1.0), ("q", "a", 2.0), ("q", "b", 3.0), ("q", "b", 4.0)]
    found = by(grouptests.inference_note(spark.createDataFrame(data, "k string, g string, v double"), ["k"], "g", "v"), "k")
    assert found["p"]["inference_note"].split("\n") == [
        "Inference withheld: <2 species units in at least one group", "No between-unit variation",
    ]
    assert found["q"]["inference_note"] == "Low species replication: <5 units in at least one group"


@pytest.mark.parametrize("spread", ["narrow", "wide", "repeated", "signed"])
def test_quantiles_and_ranks_by_brute_force(spark, spread):
    rng = np.random.default_rng(5)
    n = 3000
    values = {
        "narrow": rng.normal(1e6, 1, n), "wide": np.exp(rng.normal(0, 40, n)),
        "repeated": rng.integers(-3, 4, n).astype(float), "signed": rng.normal(0, 10, n),
    }[spread]
    keys = np.where(rng.random(n) < 0.6, "hot", rng.integers(0, 40, n).astype(str))
    frame = pd.DataFrame({"k": keys, "v": values})
    df = spark.createDataFrame(frame)
    wanted = {"a": 0.0, "b": 0.025, "c": 0.5, "d": 0.75, "e": 1.0}
    found = by(cumulative.quantiles(df, ["k"], "v", wanted), "k")
    for key, group in frame.groupby("k"):
        expected = group["v"].quantile(list(wanted.values()))
        assert [found[key][c] for c in wanted] == pytest.approx(list(expected), rel=1e-12)
    frame["rank"] = frame.groupby("k")["v"].rank()
    ranks = {(r.k, r.v): r.avg_rank for r in cumulative.rank_table(df, ["k"], "v").collect()}
    assert all(ranks[(r.k, r.v)] == r.rank for r in frame.rename(columns={"rank": "rank_"}).assign(rank=frame["rank"]).itertuples())


def test_quantiles_keep_null_keys_and_infinity(spark):
    inf = float("inf")
    data = [(None, 1.0), (None, 3.0), ("x", inf), ("x", 1.0), ("x", 2.0), ("y", inf), ("y", inf), ("z", float("nan"))]
    found = by(cumulative.quantiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", {"m": 0.5}), "k")
    assert found[None]["m"] == 2.0 and found["x"]["m"] == 2.0 and found["y"]["m"] == inf and "z" not in found


def test_describe_keeps_null_stratum_and_empty_metric(spark):
    df = spark.createDataFrame([("s", 1.0, None), ("s", 3.0, None), (None, 5.0, None)], "g string, a double, b double")
    long = describe.stratified_metrics(df, {"G": "g"}, {"a": "a", "b": "b"})
    found = by(describe.describe(long, ["stratification", "stratum", "metric"]), "stratum", "metric")
    assert found[("s", "a")]["sd"] == pytest.approx(math.sqrt(2)) and found[("s", "a")]["q1"] == 1.5
    assert found[(None, "a")]["sd"] is None and found[(None, "a")]["median"] == 5.0
    assert found[("s", "b")]["n"] == 0 and found[("s", "b")]["median"] is None
    assert len(rows(describe.describe(long, ["metric", "stratum"], keep_empty=False))) == 2
    assert long.where(F.col("metric") == "a").count() == 3


def test_split_points_even_out_a_narrow_band(spark):
    """100,000 values within 100 of 1.7e9, a few far away, and small keys that stay whole."""
    values = F.when(F.col("id") % 1000 == 7, -F.pow(F.lit(10.0), F.col("id") % 300)).otherwise(F.lit(1.7e9) + F.col("id") / 1000)
    points = spark.range(100_000).select(F.lit("a").alias("k"), values.alias("v")).dropDuplicates(["v"])
    points = points.unionByName(spark.range(3000).select((F.col("id") % 30).cast("string").alias("k"), F.col("id").cast("double").alias("v")))
    found = by(cumulative.with_buckets(points, ["k"], "v", share=50, small=1000).groupBy("k", "_bucket").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")), "k", "_bucket")
    sizes = [r["n"] for (k, _), r in found.items() if k == "a"]
    total = points.count()
    assert max(sizes) <= total / 50 and sum(sizes) == points.where("k = 'a'").count() and len(sizes) > 50
    assert all(b == 0 for k, b in found if k != "a")
    ends = [(found["a", b]["lo"], found["a", b]["hi"]) for b in sorted(b for k, b in found if k == "a")]
    assert all(x[1] < y[0] for x, y in zip(ends, ends[1:]))


def test_ranks_and_adjustment_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(cumulative.with_buckets, "__defaults__", (20, 50))
    rng = random.Random(6)
    data = [(k, rng.choice([1.0, 0.0, 0.5, round(rng.random() ** 3, 3)])) for k in "aaaab" for _ in range(400)] + [("c", None), ("c", 0.2), ("a", float("nan"))]
    df = spark.createDataFrame(data, "k string, p double")
    expected = []
    for k in "abc":
        own = sorted(p for key, p in data if key == k and p is not None and not math.isnan(p))
        low, out = 1.0, {}
        for i in range(len(own), 0, -1):
            low = min(low, own[i - 1] * len(own) / i)
            out[own[i - 1]] = low
        expected += [(k, p, pytest.approx(out[p])) for p in own]
    found = cumulative.adjusted_p_values(df, ["k"], "p", "q").collect()
    assert sorted((r.k, r.p, r.q) for r in found if r.q is not None) == expected
    assert sorted(r.k for r in found if r.q is None) == ["a", "c"]
    ranks = {r.v: r.avg_rank for r in cumulative.rank_table(df.where("k = 'a'").withColumnRenamed("p", "v"), ["k"], "v").collect()}
    own = pd.Series([p for k, p in data if k == "a" and p is not None and not math.isnan(p)])
    assert ranks == dict(zip(own, own.rank()))
