"""Descriptive statistics, group tests, expression tables and interval features on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.functions.scalars import closed_length
from cladegrid.functions.stats import TAIL_FAR, TAIL_TERMS
from cladegrid.operators import cumulative, describe, expression, grouptests, intervals, joins, ranking
from cladegrid.operators.distribution import ordered_matrix
from cladegrid.plans.membership_queries import nation_customers
from cladegrid.plans.registry import Tables, day, query, rounded

LINE_METRICS = {"price": "l_extendedprice", "quantity": "l_quantity", "discount": "l_discount"}

_LINE_LONG = " UNION ALL ".join(
    f"SELECT '{name}' AS stratification, {stratum} AS stratum, '{m}' AS metric, {c} AS v FROM lineitem"
    for name, stratum in (("FLAG", "l_returnflag"), ("STATUS", "l_linestatus"))
    for m, c in LINE_METRICS.items()
)


@query(f"""
WITH l AS ({_LINE_LONG})
SELECT stratification, stratum, metric, count(v) AS n, round(avg(v), 4) AS mean, round(stddev_samp(v), 4) AS sd,
       round(min(v), 4) AS minimum, round(max(v), 4) AS maximum, round(quantile_cont(v, 0.5), 4) AS median,
       round(quantile_cont(v, 0.25), 4) AS q1, round(quantile_cont(v, 0.75), 4) AS q3
FROM l GROUP BY ALL
""")
def describe_by_group(t: Tables) -> DataFrame:
    strata = {"FLAG": "l_returnflag", "STATUS": "l_linestatus"}
    long = describe.stratified_metrics(t.lineitem, strata, LINE_METRICS)
    return rounded(describe.describe(long, ["stratification", "stratum", "metric"]), 4)


@query("""
SELECT l_suppkey, round(quantile_cont(l_extendedprice, 0.025), 6) AS q025, round(quantile_cont(l_extendedprice, 0.5), 6) AS median,
       round(quantile_cont(l_extendedprice, 0.975), 6) AS q975 FROM lineitem GROUP BY l_suppkey
""")
def exact_quantiles(t: Tables) -> DataFrame:
    wanted = {"q025": 0.025, "median": 0.5, "q975": 0.975}
    return rounded(cumulative.quantiles(t.lineitem, ["l_suppkey"], "l_extendedprice", wanted))


@query("""
SELECT l_returnflag, l_quantity, count(*) AS n,
       CAST(sum(count(*)) OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - count(*) AS BIGINT) AS n_before,
       CAST(sum(count(*)) OVER (PARTITION BY l_returnflag) AS BIGINT) AS n_total,
       CAST(sum(count(*)) OVER (PARTITION BY l_returnflag ORDER BY l_quantity) - count(*) AS DOUBLE) + (count(*) + 1) / 2.0::DOUBLE AS avg_rank
FROM lineitem GROUP BY l_returnflag, l_quantity
""")
def average_ranks(t: Tables) -> DataFrame:
    return cumulative.rank_table(t.lineitem, ["l_returnflag"], "l_quantity")


@query("""
SELECT n_name AS unit, c_mktsegment, count(DISTINCT c_custkey) AS n_items, round(quantile_cont(c_acctbal, 0.5), 6) AS unit_value
FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL
""")
def unit_medians(t: Tables) -> DataFrame:
    rows = nation_customers(t)
    keys = ["unit", "c_mktsegment"]
    counts = rows.groupBy(*keys).agg(F.countDistinct("c_custkey").alias("n_items"))
    medians = cumulative.quantiles(rows, keys, "c_acctbal", {"unit_value": 0.5})
    return rounded(joins.keyed_join(counts, medians, keys))


def segment_comparison(t: Tables) -> grouptests.GroupComparison:
    rows = nation_customers(t)
    return grouptests.GroupComparison(rows, "c_mktsegment", ["c_acctbal"], unit="unit", item="c_custkey")


UNITS_SQL = """
u AS (SELECT n_name AS unit, c_mktsegment AS g, quantile_cont(c_acctbal, 0.5) AS v FROM customer
      JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
sizes AS (SELECT g, count(*) AS n FROM u GROUP BY g),
e AS (SELECT u.* FROM u JOIN sizes USING (g) WHERE n >= 2),
r AS (SELECT *, rank() OVER (ORDER BY v) + (count(*) OVER (PARTITION BY v) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY v) AS ties FROM e),
gsum AS (SELECT g, sum(rk) AS rs, count(*) AS n FROM r GROUP BY g),
tot AS (SELECT count(*)::DOUBLE AS n, sum(ties * ties - 1)::DOUBLE AS t FROM r),
h AS (SELECT (12.0 / (tot.n * (tot.n + 1)) * (SELECT sum(rs * rs / n) FROM gsum) - 3 * (tot.n + 1)) / (1 - tot.t / (tot.n ** 3 - tot.n)) AS h,
             (SELECT count(*) FROM gsum) AS k FROM tot)
"""


@query(f"""
WITH {UNITS_SQL}
SELECT 'C_MKTSEGMENT' AS comparison_scope, 'c_mktsegment' AS group_field, 'c_acctbal' AS metric, 'SPECIES_MEDIAN' AS analysis_unit,
       'Kruskal-Wallis' AS test_name, (SELECT count(*) FROM sizes) AS n_groups_observed, k AS n_groups_eligible,
       (SELECT count(DISTINCT c_custkey) FROM customer) AS n_items, (SELECT count(DISTINCT unit) FROM u) AS n_units,
       (SELECT count(*) FROM u) AS n_unit_group_cells, 2::BIGINT AS min_group_units, round(h, 6) AS h_statistic,
       round(exp(-h / 2) * (1 + h / 2), 6) AS p_value, 0.05::DOUBLE AS alpha, 'PASS' AS test_status,
       CASE WHEN (SELECT min(n) FROM gsum) < 5 THEN 'LOW_SPECIES_REPLICATION' ELSE 'NONE' END AS inference_warning,
       (SELECT min(n) FROM gsum) < 5 AS low_power_warning
FROM h
""")
def kruskal_wallis(t: Tables) -> DataFrame:
    """Five segments, so the chi-square tail has four degrees of freedom and a closed form."""
    return rounded(segment_comparison(t).global_tests())


@query(f"""
WITH {UNITS_SQL},
p AS (SELECT a.g AS group_1, b.g AS group_2, CAST(sum((a.v > b.v)::INT + 0.5 * (a.v = b.v)::INT) AS DOUBLE) AS u_statistic
      FROM u a JOIN u b ON a.g < b.g GROUP BY ALL),
st AS (SELECT g, count(*) AS n, quantile_cont(v, 0.5) AS mu FROM u GROUP BY g),
it AS (SELECT c_mktsegment AS g, count(*) AS n_items, quantile_cont(c_acctbal, 0.5) AS mi FROM customer GROUP BY 1)
SELECT group_1, group_2, u_statistic, s1.n AS n_units_1, s2.n AS n_units_2, i1.n_items AS n_items_1, i2.n_items AS n_items_2,
       round(s1.mu - s2.mu, 6) AS median_unit_difference, round(i1.mi, 6) AS median_item_1, round(i2.mi, 6) AS median_item_2,
       round(2 * u_statistic / (s1.n * s2.n) - 1, 6) AS rank_biserial_effect,
       CASE WHEN (SELECT exp(-h / 2) * (1 + h / 2) FROM h) < 0.05 THEN 'PASS' ELSE 'SKIPPED_GLOBAL_NOT_SIGNIFICANT' END AS test_status
FROM p JOIN st s1 ON s1.g = group_1 JOIN st s2 ON s2.g = group_2 JOIN it i1 ON i1.g = group_1 JOIN it i2 ON i2.g = group_2
""")
def mann_whitney_effects(t: Tables) -> DataFrame:
    found = segment_comparison(t).pairwise_tests()
    return rounded(
        found.select(
            "group_1", "group_2", "u_statistic", "n_units_1", "n_units_2", "n_items_1", "n_items_2", "median_unit_difference",
            "median_item_1", "median_item_2", "rank_biserial_effect", "test_status",
        )
    )


def price_bands(t: Tables) -> DataFrame:
    """Lines with the nation of their supplier and one of five quantity bands, whose prices differ."""
    rows = t.lineitem.join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = rows.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey"))
    band = F.concat(F.lit("B"), F.ceil(F.col("l_quantity") / 10).cast("string"))
    item = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    return rows.select(
        item.alias("item"), "n_name", band.alias("quantity_band"), F.col("l_extendedprice").alias("price"), F.col("l_tax").alias("tax")
    )


_TAIL_SQL = f"""
CASE WHEN x <= 0 THEN 1.0::DOUBLE WHEN x < {TAIL_FAR}
  THEN 1 - 2 / sqrt(pi()) * exp(-x * x) * list_reduce(list_prepend(0::DOUBLE, list_transform(range({TAIL_TERMS}),
    lambda k: list_reduce(list_prepend(x::DOUBLE, list_transform(range(k), lambda i: (2 * x * x / (2 * i + 3))::DOUBLE)), lambda a, b: a * b))), lambda a, b: a + b)
  ELSE exp(-x * x) / (sqrt(pi()) * list_reduce(list_prepend(x::DOUBLE, list_transform(range({TAIL_TERMS}, 0, -1), lambda k: (k / 2.0)::DOUBLE)), lambda f, half: x + half / f)) END
"""
_BANDS_SQL = """
i AS (SELECT n_name, 'B' || CAST(ceil(l_quantity / 10) AS BIGINT) AS g, concat_ws('-', l_orderkey, l_linenumber, l_suppkey, l_partkey) AS item, l_extendedprice, l_tax
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
long AS (SELECT 'price' AS metric, n_name, g, item, l_extendedprice AS v FROM i UNION ALL SELECT 'tax', n_name, g, item, l_tax FROM i),
l AS (SELECT metric, n_name, g, quantile_cont(v, 0.5) AS v FROM long GROUP BY ALL),
st AS (SELECT metric, g, count(*) AS n, quantile_cont(v, 0.5) AS mu FROM l GROUP BY ALL),
it AS (SELECT metric, g, count(DISTINCT item) AS n_items, quantile_cont(v, 0.5) AS mi FROM long GROUP BY ALL),
r AS (SELECT *, rank() OVER (PARTITION BY metric ORDER BY v) + (count(*) OVER (PARTITION BY metric, v) - 1) / 2.0 AS rk, count(*) OVER (PARTITION BY metric, v) AS same FROM l),
s AS (SELECT metric, g, sum(rk) AS rs, count(*) AS n FROM r GROUP BY ALL),
h AS (SELECT metric, flat, smallest, CASE WHEN flat THEN 0.0::DOUBLE ELSE (12.0 / (n * (n + 1)) * q - 3 * (n + 1)) / (1 - same / (n ** 3 - n)) END AS h
      FROM (SELECT metric, sum(rs * rs / n) AS q, min(n) AS smallest FROM s GROUP BY metric)
      JOIN (SELECT metric, count(*)::DOUBLE AS n, count(DISTINCT v) = 1 AS flat, sum(same * same - 1)::DOUBLE AS same FROM r GROUP BY metric) USING (metric)),
overall AS (SELECT metric, exp(-h / 2) * (1 + h / 2) AS global_p,
                   CASE WHEN flat THEN 'NO_BETWEEN_UNIT_VARIATION' WHEN smallest < 5 THEN 'LOW_SPECIES_REPLICATION' ELSE 'NONE' END AS warning FROM h),
p AS (SELECT a.metric, a.g AS group_1, b.g AS group_2, CAST(sum((a.v > b.v)::INT + 0.5 * (a.v = b.v)::INT) AS DOUBLE) AS u
      FROM l a JOIN l b ON a.metric = b.metric AND a.g < b.g GROUP BY ALL),
ties AS (SELECT metric, group_1, group_2, CAST(sum(c * c * c - c) AS DOUBLE) AS ties FROM (
           SELECT p.metric, group_1, group_2, v, count(*) AS c FROM p JOIN l ON l.metric = p.metric AND l.g IN (group_1, group_2) GROUP BY ALL) GROUP BY ALL),
z AS (SELECT p.*, s1.n AS n1, s2.n AS n2, s1.mu AS mu1, s2.mu AS mu2, global_p, warning,
        (greatest(u, s1.n * s2.n - u) - s1.n * s2.n / 2.0 - 0.5) / sqrt(s1.n * s2.n / 12.0 * ((s1.n + s2.n + 1) - ties / ((s1.n + s2.n) * (s1.n + s2.n - 1))::DOUBLE)) / sqrt(2::DOUBLE) AS x
      FROM p JOIN ties USING (metric, group_1, group_2) JOIN overall USING (metric)
      JOIN st s1 ON s1.metric = p.metric AND s1.g = group_1 JOIN st s2 ON s2.metric = p.metric AND s2.g = group_2)
"""


@query(f"""
WITH {_BANDS_SQL},
tested AS (SELECT *, CASE WHEN global_p < 0.05 THEN {_TAIL_SQL} END AS p FROM z),
ranked AS (SELECT *, count(p) OVER (PARTITION BY metric) AS m, CASE WHEN p IS NOT NULL THEN count(p) OVER (PARTITION BY metric ORDER BY p) END AS k FROM tested)
SELECT 'QUANTITY_BAND' AS comparison_scope, 'quantity_band' AS group_field, r.metric, 'SPECIES_MEDIAN' AS analysis_unit, group_1, group_2,
       i1.n_items AS n_items_1, i2.n_items AS n_items_2, n1 AS n_units_1, n2 AS n_units_2,
       round(i1.mi, 9) AS median_item_1, round(i2.mi, 9) AS median_item_2, round(mu1, 9) AS median_unit_1, round(mu2, 9) AS median_unit_2,
       round(mu1 - mu2, 9) AS median_unit_difference, round(2 * u / (n1 * n2) - 1, 9) AS rank_biserial_effect, 'Mann-Whitney U' AS test_name, u AS u_statistic,
       round(global_p, 9) AS global_p_value, round(p, 9) AS p_value,
       CASE WHEN p IS NOT NULL THEN round(least(1.0, min(p * m / k) OVER (PARTITION BY r.metric ORDER BY k RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) END AS p_adjusted_bh,
       0.05::DOUBLE AS alpha, CASE WHEN global_p < 0.05 THEN 'PASS' ELSE 'SKIPPED_GLOBAL_NOT_SIGNIFICANT' END AS test_status, warning AS inference_warning
FROM ranked r JOIN it i1 ON i1.metric = r.metric AND i1.g = group_1 JOIN it i2 ON i2.metric = r.metric AND i2.g = group_2
""")
def mann_whitney_tests(t: Tables) -> DataFrame:
    """Pairwise p-values (normal tail: there are more than eight units) and their adjustment where the global test is significant.

    A metric whose unit medians are all equal, as those of taxes are on large tables, has h = 0, p = 1 and a warning.
    """
    bands = grouptests.GroupComparison(price_bands(t), "quantity_band", ["price", "tax"], unit="n_name", item="item")
    return rounded(bands.pairwise_tests(), 9)


@query("""
WITH u AS (SELECT n_name, 'B' || CAST(ceil(l_quantity / 10) AS BIGINT) AS g, quantile_cont(l_extendedprice, 0.5) AS price, quantile_cont(l_tax, 0.5) AS tax
           FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY ALL),
l AS (SELECT n_name, g, 'price' AS metric, price AS v FROM u UNION ALL SELECT n_name, g, 'tax', tax FROM u),
p AS (SELECT a.metric, a.g AS group_1, b.g AS group_2, CAST(sum((a.v > b.v)::INT + 0.5 * (a.v = b.v)::INT) AS DOUBLE) AS u_statistic,
             count(DISTINCT a.n_name) AS n_units_1, count(DISTINCT b.n_name) AS n_units_2
      FROM l a JOIN l b ON a.metric = b.metric AND a.g < b.g GROUP BY ALL),
ties AS (SELECT metric, group_1, group_2, CAST(sum(c * c * c - c) AS DOUBLE) AS ties FROM (
           SELECT p.metric, group_1, group_2, v, count(*) AS c FROM p JOIN l ON l.metric = p.metric AND l.g IN (group_1, group_2) GROUP BY ALL) GROUP BY ALL)
SELECT * FROM p JOIN ties USING (metric, group_1, group_2)
""")
def rank_sum_statistics(t: Tables) -> DataFrame:
    bands = grouptests.GroupComparison(price_bands(t), "quantity_band", ["price", "tax"], unit="n_name", item="item")
    return bands.pair_statistics().withColumnRenamed("_ties", "ties")


@query("""
WITH u AS (SELECT n_name, c_mktsegment AS g FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
s AS (SELECT g, count(*) AS n FROM u GROUP BY g)
SELECT 'C_MKTSEGMENT' AS comparison_scope, 'c_acctbal' AS metric, (SELECT count(*) FROM customer) AS input_item_rows,
       (SELECT count(c_acctbal) FROM customer) AS eligible_item_rows, (SELECT count(*) - count(c_acctbal) FROM customer) AS excluded_item_rows,
       (SELECT count(*) FROM s) AS observed_groups, (SELECT count(*) FROM s WHERE n >= 2) AS eligible_groups,
       (SELECT count(*) FROM u) AS eligible_unit_group_cells, 'PASS' AS qc_status, (SELECT min(n) FROM s WHERE n >= 2) < 5 AS low_power_warning
""")
def group_test_quality(t: Tables) -> DataFrame:
    return segment_comparison(t).quality().select(
        "comparison_scope", "metric", "input_item_rows", "eligible_item_rows", "excluded_item_rows", "observed_groups",
        "eligible_groups", "eligible_unit_group_cells", "qc_status", "low_power_warning",
    )


@query("""
WITH g AS (SELECT n_name, c_mktsegment, count(c_acctbal) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL),
s AS (SELECT n_name, min(n) AS least FROM g GROUP BY n_name),
v AS (SELECT n_name, max(c_acctbal) - min(c_acctbal) AS span FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name)
SELECT n_name AS unit, concat_ws(chr(10), CASE WHEN least < 12 THEN 'Inference withheld: <12 species units in at least one group' END,
       CASE WHEN span = 0 THEN 'No between-unit variation' WHEN least < 5 THEN 'Low species replication: <5 units in at least one group' END) AS inference_note
FROM s LEFT JOIN v USING (n_name)
""")
def inference_notes(t: Tables) -> DataFrame:
    return grouptests.inference_note(nation_customers(t), ["unit"], "c_mktsegment", "c_acctbal", min_units=12)


@query("""
WITH p AS (SELECT event_type, user_id, 1.0 / (1 + count(*)) ** 2 AS p FROM events GROUP BY ALL),
r AS (SELECT *, count(*) OVER (PARTITION BY event_type ORDER BY p) AS k, count(*) OVER (PARTITION BY event_type) AS m FROM p)
SELECT event_type, user_id, round(p, 9) AS p, round(least(1.0, min(p * m / k) OVER (PARTITION BY event_type ORDER BY k RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 9) AS p_adjusted
FROM r
""")
def adjusted_p_values(t: Tables) -> DataFrame:
    tests = t.events.groupBy("event_type", "user_id").agg((F.lit(1.0) / F.pow(F.lit(1.0) + F.count("*"), F.lit(2.0))).alias("p"))
    return rounded(cumulative.adjusted_p_values(tests, ["event_type"], "p", "p_adjusted"), 9)


EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]  # fixed values: the sample columns


def user_matrix(t: Tables) -> DataFrame:
    """User x event type matrix of mean values, missing where there is none."""
    means = t.events.groupBy("user_id", "event_type").agg(F.round(F.avg("value"), 6).alias("v"))
    return ordered_matrix(means, "user_id", "event_type", "v", EVENT_TYPES)


def user_expression(t: Tables) -> DataFrame:
    users = t.events.select("user_id").distinct()
    wide = expression.wide_with_status(users, user_matrix(t), "user_id", EVENT_TYPES)
    return expression.long_from_wide(wide, ["user_id", "expression_data_status"], EVENT_TYPES, 80.0)


_MATRIX_SQL = f"""
mean AS (SELECT user_id, event_type, round(avg(value), 6) AS v FROM events GROUP BY ALL),
l AS (SELECT u.user_id, s.sample_id, v AS expression_value FROM (SELECT DISTINCT user_id FROM events) u
      CROSS JOIN (SELECT unnest({EVENT_TYPES}) AS sample_id) s LEFT JOIN mean ON mean.user_id = u.user_id AND event_type = s.sample_id),
long AS (SELECT *, CASE count(expression_value) OVER (PARTITION BY user_id) WHEN 0 THEN 'MISSING' WHEN 5 THEN 'AVAILABLE' ELSE 'PARTIAL_MISSING' END AS expression_data_status,
                CASE WHEN expression_value IS NULL THEN 'MISSING_IN_INPUT' ELSE 'OBSERVED' END AS measurement_status,
                expression_value >= 80 AS detected FROM l)
"""


@query(f"WITH {_MATRIX_SQL} SELECT * FROM long")
def expression_long(t: Tables) -> DataFrame:
    return user_expression(t)


@query(f"""
WITH {_MATRIX_SQL}
SELECT user_id, count(expression_value) AS samples_available, CAST(coalesce(sum(detected::INT), 0) AS BIGINT) AS expression_detected_samples,
       round(avg(detected::INT), 6) AS expression_detected_fraction, round(max(expression_value), 6) AS max_expression,
       round(quantile_cont(expression_value, 0.5), 6) AS median_expression
FROM long GROUP BY user_id
""")
def expression_summary(t: Tables) -> DataFrame:
    return rounded(expression.summarize(user_expression(t), ["user_id"]))


@query(f"""
WITH {_MATRIX_SQL}, s AS (SELECT *, log2(expression_value + 1) AS x FROM long)
SELECT user_id, sample_id, round((x - avg(x) OVER w) / CASE WHEN stddev_pop(x) OVER w = 0 THEN 1 ELSE stddev_pop(x) OVER w END, 5) AS zscore_log2
FROM s WINDOW w AS (PARTITION BY user_id)
""")
def expression_zscores(t: Tables) -> DataFrame:
    return rounded(expression.row_zscores(user_expression(t), "user_id").select("user_id", "sample_id", "zscore_log2"), 5)


ABUNDANCE_SQL = """
samples AS (SELECT DISTINCT c_mktsegment || '/' || o_orderstatus AS sample_id, c_mktsegment AS sample_unit FROM orders JOIN customer ON o_custkey = c_custkey),
sums AS (SELECT s.sample_id, o_custkey, sum(o_totalprice) AS v FROM orders JOIN samples s ON o_orderstatus = split_part(s.sample_id, '/', 2)
         JOIN customer ON c_custkey = o_custkey AND c_mktsegment = sample_unit GROUP BY ALL),
long AS (SELECT c.c_custkey, c.c_mktsegment, s.sample_id, s.sample_unit,
                CASE WHEN c_mktsegment = sample_unit THEN coalesce(v, 0) END AS expression_value,
                CASE WHEN c_mktsegment <> sample_unit THEN 'NOT_APPLICABLE' WHEN v IS NOT NULL THEN 'MEASURED' ELSE 'ASSAYED_ZERO' END AS measurement_status
         FROM customer c CROSS JOIN samples s LEFT JOIN sums ON sums.sample_id = s.sample_id AND o_custkey = c_custkey)
"""


def customer_abundance(t: Tables) -> DataFrame:
    """Customers as members, segments as units, order states within a segment as samples, prices as abundance."""
    people = t.customer.select("c_custkey", "c_mktsegment")
    orders = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.sum("o_totalprice").alias("o_totalprice"))
    states = orders.join(people, F.col("o_custkey") == F.col("c_custkey"))
    sample = F.concat_ws("/", "c_mktsegment", "o_orderstatus")
    samples = states.select(sample.alias("sample_id"), "c_mktsegment").distinct()
    in_state = F.substring_index("sample_id", "/", -1) == F.col("o_orderstatus")
    abundance = orders.join(F.broadcast(samples), in_state).select("sample_id", F.col("o_custkey").alias("gene_id"), "o_totalprice")
    mapping = people.select("c_mktsegment", F.col("c_custkey").alias("gene_id"), "c_custkey")
    return expression.long_from_abundance(
        people, samples, abundance, mapping, 300000.0, key="c_custkey", unit="c_mktsegment", value="o_totalprice"
    )


@query(f"""
WITH {ABUNDANCE_SQL}
SELECT c_custkey, c_mktsegment, sample_id, sample_unit, round(expression_value, 2) AS expression_value, measurement_status,
       expression_value >= 300000 AS detected FROM long
""")
def abundance_long(t: Tables) -> DataFrame:
    return rounded(customer_abundance(t), 2)


@query(f"""
WITH {ABUNDANCE_SQL}
SELECT c_custkey, count(expression_value) AS samples_available, CAST(coalesce(sum((expression_value >= 300000)::INT), 0) AS BIGINT) AS expression_detected_samples,
       round(avg((expression_value >= 300000)::INT), 6) AS expression_detected_fraction, count(*) FILTER (measurement_status = 'MEASURED') AS measured_samples,
       count(*) FILTER (measurement_status = 'ASSAYED_ZERO') AS assayed_zero_samples, round(max(expression_value), 2) AS max_expression,
       round(quantile_cont(expression_value, 0.5), 2) AS median_expression
FROM long GROUP BY c_custkey
""")
def abundance_summary(t: Tables) -> DataFrame:
    found = expression.summarize(customer_abundance(t), ["c_custkey"], with_assay_counts=True)
    six = F.round("expression_detected_fraction", 6)
    two = {c: F.round(c, 2) for c in ("max_expression", "median_expression")}
    return found.withColumns({"expression_detected_fraction": six, **two})


INTERVALS_SQL = """
iv AS (SELECT o_orderkey, o_custkey, date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS s,
              date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) + o_orderkey % 30 AS e FROM orders)
"""


def order_intervals(t: Tables) -> DataFrame:
    """Orders as intervals of days on their customer."""
    start = day("o_orderdate")
    return t.orders.select("o_orderkey", "o_custkey", start.alias("start"), (start + F.col("o_orderkey") % 30).alias("end"))


@query(f"""
WITH {INTERVALS_SQL}, d AS (SELECT o_custkey, s, e, count(*) AS n FROM iv GROUP BY ALL),
p AS (SELECT *, lag(e) OVER (PARTITION BY o_custkey ORDER BY s, e) AS previous_end FROM d)
SELECT o_custkey, s AS "start", e AS "end", n, previous_end, greatest(0, s - previous_end - 1) * CASE WHEN previous_end IS NULL THEN NULL ELSE 1 END AS gap FROM p
""")
def interval_gaps(t: Tables) -> DataFrame:
    return intervals.gaps(order_intervals(t), ["o_custkey"], width=90)


@query(f"""
WITH {INTERVALS_SQL}, d AS (SELECT o_custkey, s, e, count(*) AS n FROM iv GROUP BY ALL),
p AS (SELECT *, lag(e) OVER (PARTITION BY o_custkey ORDER BY s, e) AS previous_end FROM d)
SELECT o_custkey, s AS "start", e AS "end", n, previous_end FROM p WHERE s <= previous_end OR n > 1
""")
def overlapping_neighbours(t: Tables) -> DataFrame:
    return intervals.overlapping_neighbours(order_intervals(t), ["o_custkey"], width=90)


WINDOWS_SQL = INTERVALS_SQL + ", w AS (SELECT o_orderkey, o_custkey, s - 20 AS ws, s - 1 AS we FROM iv)"


def order_windows(t: Tables) -> DataFrame:
    """The twenty days before each order."""
    return order_intervals(t).select("o_orderkey", "o_custkey", (F.col("start") - 20).alias("start"), (F.col("start") - 1).alias("end"))


@query(f"""
WITH {WINDOWS_SQL}
SELECT w.o_orderkey, w.o_custkey, ws AS "start", we AS "end", count(iv.o_orderkey) AS overlap_count
FROM w LEFT JOIN iv ON iv.o_custkey = w.o_custkey AND iv.o_orderkey <> w.o_orderkey AND iv.s <= we AND iv.e >= ws GROUP BY ALL
""")
def interval_overlap_counts(t: Tables) -> DataFrame:
    args = ("o_custkey", "o_orderkey", "o_orderkey")
    return intervals.overlap_counts(order_windows(t).withColumn("id", F.col("o_orderkey")), order_intervals(t), *args, width=90).drop("id")


@query(f"""
WITH {WINDOWS_SQL}
SELECT w.o_orderkey, iv.o_orderkey AS feature_id
FROM w JOIN iv ON iv.o_custkey = w.o_custkey AND iv.o_orderkey <> w.o_orderkey AND iv.s <= we AND iv.e >= ws
""")
def interval_overlap_ids(t: Tables) -> DataFrame:
    return intervals.overlap_pairs(order_windows(t), order_intervals(t), "o_custkey", "o_orderkey", "o_orderkey", width=30)


PARTS_SQL = """
parts AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 'exon' WHEN 'N' THEN 'CDS' ELSE CASE l_linestatus WHEN 'F' THEN 'five_prime_UTR' ELSE 'UTR' END END AS feature,
                 date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) AS s,
                 date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) + CAST(l_quantity AS BIGINT) AS e FROM lineitem)
"""


def order_parts(t: Tables) -> DataFrame:
    """Lines as features of their order: exons, coding parts and two kinds of UTR."""
    kind = F.when(F.col("l_returnflag") == "A", "exon").when(F.col("l_returnflag") == "N", "CDS")
    kind = kind.when(F.col("l_linestatus") == "F", "five_prime_UTR").otherwise("UTR")
    start = day("l_shipdate")
    return t.lineitem.select("l_orderkey", kind.alias("feature"), start.alias("start"), (start + F.col("l_quantity").cast("long")).alias("end"))


@query(f"""
WITH {PARTS_SQL}, a AS (
  SELECT l_orderkey, CAST(coalesce(sum(e - s + 1) FILTER (feature = 'CDS'), 0) AS BIGINT) AS cds_length, count(*) FILTER (feature = 'exon') AS exon_count,
         CAST(coalesce(sum(e - s + 1) FILTER (feature = 'exon'), 0) AS BIGINT) AS total_exon_length,
         CAST(coalesce(sum(e - s + 1) FILTER (feature = 'five_prime_UTR'), 0) AS BIGINT) AS five_prime_utr_length,
         CAST(0 AS BIGINT) AS three_prime_utr_length, CAST(coalesce(sum(e - s + 1) FILTER (feature = 'UTR'), 0) AS BIGINT) AS generic_utr_length,
         count(*) FILTER (feature = 'CDS') AS n_cds FROM parts GROUP BY l_orderkey),
g AS (SELECT l_orderkey, greatest(0, s - lag(e) OVER (PARTITION BY l_orderkey ORDER BY s, e) - 1) AS gap FROM parts WHERE feature = 'exon'),
i AS (SELECT l_orderkey, CAST(sum(gap) AS BIGINT) AS introns FROM g GROUP BY l_orderkey),
j AS (SELECT *, greatest(exon_count - 1, 0) AS intron_count, CASE WHEN exon_count > 1 THEN introns ELSE 0 END AS total_intron_length FROM a LEFT JOIN i USING (l_orderkey))
SELECT l_orderkey, cds_length, exon_count, total_exon_length, round(total_exon_length::DOUBLE / nullif(exon_count, 0)::DOUBLE, 6) AS mean_exon_length, intron_count,
       total_intron_length, round(coalesce(total_intron_length::DOUBLE / nullif(intron_count, 0)::DOUBLE, 0), 6) AS mean_intron_length, five_prime_utr_length,
       three_prime_utr_length, generic_utr_length, CASE WHEN exon_count > 0 AND n_cds > 0 THEN 'PASS' ELSE 'MISSING_EXON_OR_CDS' END AS structure_qc
FROM j
""")
def structure_metrics(t: Tables) -> DataFrame:
    return rounded(intervals.structure_metrics(order_parts(t), "l_orderkey", width=365))


@query(f"""
WITH {PARTS_SQL}, c AS (SELECT l_orderkey, CAST(sum(e - s + 1) AS BIGINT) AS cds_length FROM parts WHERE feature = 'CDS' GROUP BY l_orderkey),
r AS (SELECT o_custkey, l_orderkey, cds_length, row_number() OVER (PARTITION BY o_custkey ORDER BY cds_length DESC, l_orderkey) AS rn FROM c JOIN orders ON l_orderkey = o_orderkey)
SELECT o_custkey, l_orderkey, cds_length FROM r WHERE rn = 1
""")
def longest_per_parent(t: Tables) -> DataFrame:
    """The order with the longest coding length of each customer, ties by smallest order id."""
    lengths = intervals.coding_lengths(order_parts(t).where("feature = 'CDS'"), "l_orderkey")
    owned = lengths.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select("o_custkey", "l_orderkey", "cds_length")
    return ranking.longest_per_parent(owned, "o_custkey", "l_orderkey", "cds_length")


@query("""
WITH lens AS (SELECT l_orderkey, max(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))) AS len FROM lineitem GROUP BY l_orderkey),
p AS (SELECT o_orderkey, o_custkey, date_diff('day', DATE '1992-01-01', CAST(o_orderdate AS DATE)) AS s, len FROM orders LEFT JOIN lens ON l_orderkey = o_orderkey)
SELECT o_orderkey, o_custkey, s AS "start", s + o_orderkey % 30 AS "end", len AS chromosome_length,
       CASE WHEN len IS NOT NULL THEN (s + s + o_orderkey % 30) / 2.0::DOUBLE END AS midpoint,
       round((s + s + o_orderkey % 30) / 2.0::DOUBLE / nullif(len, 0)::DOUBLE, 9) AS relative_position,
       CASE WHEN len IS NULL THEN 'MISSING_COORDINATE_OR_CHROMOSOME' ELSE 'PASS' END AS coordinate_qc FROM p
""")
def sequence_positions(t: Tables) -> DataFrame:
    return rounded(_positions(t), 9)


def _positions(t: Tables) -> DataFrame:
    zero = F.unix_date(F.lit("1992-01-01").cast("date")).cast("long")
    items = t.orders.select("o_orderkey", "o_custkey", (day("o_orderdate") - zero).alias("start")).withColumn(
        "end", F.col("start") + F.col("o_orderkey") % 30
    )
    shipped = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey"))
    lengths = shipped.agg(F.max(day("l_shipdate") - zero).alias("chromosome_length"))
    return intervals.positions_on_sequences(items, lengths, ["o_orderkey"], "start", "end")


@query("""
WITH lens AS (SELECT l_orderkey, max(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE))) AS chromosome_length FROM lineitem GROUP BY l_orderkey)
SELECT o_custkey, chromosome_length, count(DISTINCT o_orderkey) AS item_count, round(count(DISTINCT o_orderkey) / (chromosome_length / 1000000.0::DOUBLE), 4) AS density
FROM orders JOIN lens ON l_orderkey = o_orderkey GROUP BY o_custkey, chromosome_length
""")
def sequence_density(t: Tables) -> DataFrame:
    return rounded(intervals.density_per_sequence(_positions(t), ["o_custkey"], "o_orderkey"), 4)


@query("""
SELECT l_orderkey, l_suppkey, CAST(l_quantity AS BIGINT) + 1 AS length FROM lineitem
""")
def closed_lengths(t: Tables) -> DataFrame:
    start = day("l_shipdate")
    return t.lineitem.select("l_orderkey", "l_suppkey", closed_length(start, start + F.col("l_quantity").cast("long")).alias("length"))
