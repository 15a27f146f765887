"""The registered queries: plans without cross products, and results equal to their SQL counterparts."""

import os

import pytest

import __spark_entry__ as entry

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
# A sample of the families; the whole list is compared by the correctness run.
COMPARED = ("occupancy_class", "rarefaction_exact", "best_alignment_hits", "interval_overlap_counts", "element_distribution_quality", "merged_pairs")

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="benchmark tables are not here")


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


def test_no_query_forms_a_cross_product(spark):
    # queries that cut lineage run jobs while they are built and are left to the comparison
    eager = {"kruskal_wallis", "mann_whitney_effects", "mann_whitney_tests", "rank_sum_statistics", "group_test_quality"}
    for name, query in entry.queries().items():
        if name not in eager:
            plan = query(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
            assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name


def test_best_hits_are_limited_below_the_exchange(spark):
    plan = entry.queries()["best_alignment_hits"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Partial", plan.index("Exchange")) > 0 and "WindowGroupLimit" in plan


@pytest.mark.parametrize("name", COMPARED)
def test_results_equal_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{SMALL}/{table}.parquet'")
    df = entry.queries()[name](spark, SMALL)
    columns = sorted(df.columns)
    relation = con.execute(entry.oracle_sql()[name])
    positions = [[d[0] for d in relation.description].index(c) for c in columns]
    expected = sorted(tuple(str(row[i]) for i in positions) for row in relation.fetchall())
    assert sorted(tuple(str(r[c]) for c in columns) for r in df.collect()) == expected


def test_long_matrix_has_every_word_length(spark):
    cells = entry.queries()["level_matrix_long"](spark, SMALL)
    words = entry.queries()["element_distribution"](spark, SMALL).where("aggregation_level = 'SPECIES_SUBFAMILY'")
    total = lambda df: df.selectExpr("sum(hit_count)", "max(int(substring(element, 2)))").first()
    assert tuple(total(cells)) == tuple(total(words)) and total(cells)[1] > 12
