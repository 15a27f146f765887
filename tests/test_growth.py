"""Tables that grow: equal unit medians, and tasks whose rows do not grow with the tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cladegrid.operators import pairs, tiles
from cladegrid.plans.quality_queries import flag_files
from cladegrid.plans.registry import Tables
from cladegrid.session import apply_plan_settings
from cladegrid.sources.order import with_file_order

SMALL, MIDDLE = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(MIDDLE), reason="benchmark tables are not here")


def sql_rows(name, folder, columns, **views):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for table in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"create view {table} as select * from '{views.get(table, f'{folder}/{table}.parquet')}'")
    relation = con.execute(entry.oracle_sql()[name])
    positions = [[d[0] for d in relation.description].index(c) for c in columns]
    return sorted(tuple(str(row[i]) for i in positions) for row in relation.fetchall())


@needs_tables
def test_equal_unit_medians_have_the_warning_in_the_sql_too(spark, folder):
    duckdb = pytest.importorskip("duckdb")
    for table in ("nation", "supplier", "lineitem"):
        # one tax, and one price in two of the bands: no variance at all, and none in one pair
        flat = "* replace (0.04 as l_tax, case when l_quantity <= 20 then 5.0 else l_extendedprice end as l_extendedprice)"
        duckdb.sql(f"copy (select {flat if table == 'lineitem' else '*'} from '{MIDDLE}/{table}.parquet') to '{folder}/{table}.parquet'")
    df = entry.queries()["mann_whitney_tests"](spark, folder)
    columns = sorted(df.columns)
    found = df.collect()
    views = {table: f"{MIDDLE}/{table}.parquet" for table in ("region", "customer", "part", "orders")}
    assert sorted(tuple(str(r[c]) for c in columns) for r in found) == sql_rows("mann_whitney_tests", folder, columns, **views)
    assert {(r["global_p_value"], r["inference_warning"]) for r in found if r["metric"] == "tax"} == {(1.0, "NO_BETWEEN_UNIT_VARIATION")}
    assert {r["p_value"] for r in found if (r["metric"], r["group_1"], r["group_2"]) == ("price", "B1", "B2")} == {1.0}


@pytest.fixture()
def no_size_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_of_files_are_not_gathered_by_file(no_size_broadcast, folder):
    spark = no_size_broadcast
    spark.range(40).selectExpr("concat('s', id) as value").repartition(4).write.text(f"{folder}/a")
    plan = plan_of(with_file_order(spark.read.text(f"{folder}/a"), f"{folder}/a"))
    assert "BroadcastHashJoin" in plan and "hashpartitioning(_file" not in plan


@needs_tables
def test_written_files_follow_the_number_of_partitions(spark):
    before = {key: spark.conf.get(key) for key in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "24")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        paths = flag_files(Tables(spark, SMALL), [F.col("l_suppkey"), F.col("l_partkey")], "\t")
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert len({r[0] for r in spark.read.text(paths).select(F.regexp_extract("_metadata.file_path", "part-(\\d+)", 1)).collect()}) > 8


def test_single_copy_pairs_count_repeated_rows_once(spark):
    rows = [("g", "R", 1), ("g", "R", 1), ("g", "A", 2), ("g", "A", 2), ("g", "B", 3), ("g", "B", 4), ("g", "C", None)]
    found = pairs.single_copy_pairs(spark.createDataFrame(rows, "part_id string, unit string, member long"), "part_id", "unit", "member", "R")
    assert [(r["left_id"], r["right_id"]) for r in found.collect()] == [(1, 2)]
    assert "count(" not in plan_of(found)  # a count of distinct members takes two more hash maps


@needs_tables
def test_lines_are_not_moved_for_each_end_of_a_pair(no_size_broadcast):
    plan = plan_of(entry.queries()["pair_strata_and_flags"](no_size_broadcast, SMALL))
    assert "hashpartitioning(stable_id" not in plan


def test_residues_stay_where_they_are_read(no_size_broadcast, folder):
    with open(f"{folder}/a.fa", "w") as f:
        f.write(">a\nACGTAC\n")
    assert "BroadcastHashJoin" in plan_of(tiles.read_tiles(no_size_broadcast, f"{folder}/a.fa", 4))


def test_bytes_of_a_task_are_bounded_and_smaller_settings_stay(spark):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(key) for key in keys]
    spark.conf.set(keys[0], "1GB")
    spark.conf.set(keys[1], "16k")
    try:
        apply_plan_settings(spark)
        assert (spark.conf.get(keys[0]), spark.conf.get(keys[1])) == (f"{32 << 20}b", "16k")
    finally:
        for key, value in zip(keys, before):
            spark.conf.set(key, value)


@needs_tables
def test_few_samples_are_no_keys_of_tasks(no_size_broadcast):
    plan = plan_of(entry.queries()["abundance_long"](no_size_broadcast, SMALL))
    assert "hashpartitioning(o_orderstatus" not in plan and "hashpartitioning(_block" not in plan
