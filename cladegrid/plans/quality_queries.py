"""Evidence selection, lookups, quality rules, incremental reuse and the integrated wide table."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.functions import scalars
from cladegrid.operators import audit, describe, evidence, expect, joins, occupancy, ranking, reuse
from cladegrid.plans.membership_queries import CORE, MEMBERSHIP_SQL, NATIONS, SHELL, SOFT, part_membership
from cladegrid.plans.registry import Tables, query, rounded
from cladegrid.session import shared_folder
from cladegrid.sources import hits


def line_hits(t: Tables) -> DataFrame:
    """Lines as hits on parts: discount as e-value, price as bit score, quantity as identity."""
    return t.lineitem.select(
        F.col("l_partkey").alias("stable_id"),
        F.col("l_suppkey").alias("query_id"),
        F.col("l_discount").alias("evalue"),
        F.col("l_extendedprice").alias("bitscore"),
        F.col("l_quantity").alias("identity"),
        (F.col("l_linenumber") * 15).cast("double").alias("query_coverage"),
        F.col("l_tax").alias("domain_ievalue"),
        F.col("l_discount").alias("full_evalue"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ordinal"),
    )


_HITS_SQL = """
h AS (SELECT l_partkey AS stable_id, l_suppkey AS query_id, l_discount AS evalue, l_extendedprice AS bitscore, l_quantity AS identity,
             l_linenumber * 15.0::DOUBLE AS query_coverage, l_tax AS domain_ievalue, l_discount AS full_evalue, l_orderkey * 10 + l_linenumber AS ordinal FROM lineitem)
"""


@query(f"""
WITH {_HITS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY stable_id ORDER BY evalue, bitscore DESC, ordinal) AS rn FROM h)
SELECT stable_id, query_id, evalue, bitscore, ordinal FROM r WHERE rn = 1
""")
def best_alignment_hits(t: Tables) -> DataFrame:
    return evidence.best_alignment_hit(line_hits(t)).select("stable_id", "query_id", "evalue", "bitscore", "ordinal")


@query(f"""
WITH {_HITS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY domain_ievalue, ordinal, stable_id) AS rn FROM h)
SELECT query_id, domain_ievalue, ordinal FROM r WHERE rn = 1
""")
def best_domain_hits(t: Tables) -> DataFrame:
    return evidence.best_domain_hit(line_hits(t), "query_id").select("query_id", "domain_ievalue", "ordinal")


# The order in which the folders of the return flags are given to the readers; it is not that of their names.
_FLAGS = ("R", "A", "N")


def flag_files(t: Tables, values: list, sep: str) -> list[str]:
    """Lines as texts of joined values in a folder per return flag, of very different sizes; in order inside each."""
    folder = f"{shared_folder(t.spark)}/hits-{uuid.uuid4().hex}"
    order = ["l_returnflag", "l_orderkey", "l_linenumber"]
    dealt = t.lineitem.repartitionByRange(*order).sortWithinPartitions(*order)
    text = F.concat_ws(sep, *[v.cast("string") for v in values])
    dealt.select("l_returnflag", text.alias("value")).write.partitionBy("l_returnflag").text(folder)
    return [f"{folder}/l_returnflag={flag}" for flag in _FLAGS]


_FLAG_RANK_SQL = "list_position(['R', 'A', 'N'], l_returnflag), l_orderkey, l_linenumber"


@query(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount, floor(l_quantity / 25) DESC, {_FLAG_RANK_SQL}) AS rn FROM lineitem)
SELECT CAST(l_partkey AS VARCHAR) AS stable_id, CAST(l_suppkey AS VARCHAR) AS query_id, l_discount AS evalue, floor(l_quantity / 25)::DOUBLE AS bitscore,
       l_orderkey::BIGINT AS order_key, l_linenumber::BIGINT AS line_number FROM r WHERE rn = 1
""")
def first_alignments_over_files(t: Tables) -> DataFrame:
    """Best alignment of every part over written and read-back files; of equal ones the first by file and line."""
    zero = F.lit(0)
    values = [
        F.col("l_suppkey"), F.col("l_partkey"), F.col("l_quantity"), F.col("l_orderkey"), F.col("l_linenumber"), zero, zero, zero, zero, zero,
        F.col("l_discount"), F.floor(F.col("l_quantity") / 25), F.lit(100), F.lit(100),
    ]
    read = hits.read_alignment_hits(t.spark, flag_files(t, values, "\t"))
    named = {"order_key": F.col("alignment_length"), "line_number": F.col("mismatch")}
    return evidence.best_alignment_hit(read.withColumns(named)).select("stable_id", "query_id", "evalue", "bitscore", *named)


@query(f"""
WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_tax, {_FLAG_RANK_SQL}) AS rn FROM lineitem)
SELECT CAST(l_suppkey AS VARCHAR) AS stable_id, CAST(l_partkey AS VARCHAR) AS query, l_tax AS domain_ievalue,
       l_orderkey::BIGINT AS order_key, l_linenumber::BIGINT AS line_number FROM r WHERE rn = 1
""")
def first_domains_over_files(t: Tables) -> DataFrame:
    """Best domain of every supplier over written and read-back per-domain tables, likewise."""
    dash = F.lit("-")
    values = [
        F.col("l_suppkey"), dash, dash, F.col("l_partkey"), dash, dash, F.col("l_discount"), dash, dash, dash, dash, dash,
        F.col("l_tax"), F.col("l_quantity"), dash, dash, dash, F.col("l_orderkey"), F.col("l_linenumber"), dash, dash, dash, F.lit("some words"),
    ]
    read = hits.read_domain_hits(t.spark, flag_files(t, values, "  "))
    named = {"order_key": F.col("ali_from"), "line_number": F.col("ali_to")}
    return evidence.best_domain_hit(read.withColumns(named)).select("stable_id", "query", "domain_ievalue", *named)


def _evidence(t: Tables) -> DataFrame:
    domain = evidence.domain_hits_within(line_hits(t), 0.01, 0.01)
    aligned = evidence.alignment_hits_within(line_hits(t), 0.02, 40.0, 60.0)
    listed = t.part.where("p_size = 50").select(F.col("p_partkey").alias("stable_id"))
    return evidence.combine_sources({"hmm": domain, "blast": aligned, "precomputed": listed}, "stable_id")


_EVIDENCE_SQL = f"""
{_HITS_SQL},
f AS (SELECT stable_id, bool_or(s = 'hmm') AS evidence_hmm, bool_or(s = 'blast') AS evidence_blast, bool_or(s = 'precomputed') AS evidence_precomputed FROM (
  SELECT stable_id, 'hmm' AS s FROM h WHERE full_evalue <= 0.01 AND domain_ievalue <= 0.01
  UNION ALL SELECT stable_id, 'blast' FROM h WHERE evalue <= 0.02 AND identity >= 40 AND query_coverage >= 60
  UNION ALL SELECT p_partkey, 'precomputed' FROM part WHERE p_size = 50) GROUP BY stable_id)
"""


@query(f"""
WITH {_EVIDENCE_SQL}
SELECT *, 'intersection' AS selection_basis, CASE WHEN evidence_hmm AND evidence_blast THEN 'PASS' ELSE 'REJECT' END AS decision,
       CASE WHEN evidence_hmm AND evidence_blast THEN NULL
            ELSE concat_ws(';', CASE WHEN NOT evidence_hmm THEN 'missing_hmm_evidence' END, CASE WHEN NOT evidence_blast THEN 'missing_blast_evidence' END) END AS rejection_reason
FROM f
""")
def evidence_intersection(t: Tables) -> DataFrame:
    return evidence.decide(_evidence(t), "intersection")


@query(f"""
WITH {_EVIDENCE_SQL}
SELECT *, 'union' AS selection_basis, CASE WHEN evidence_hmm OR evidence_blast THEN 'PASS' ELSE 'REJECT' END AS decision,
       CASE WHEN NOT (evidence_hmm OR evidence_blast) THEN 'did_not_pass_selection_rule' END AS rejection_reason FROM f
""")
def evidence_union(t: Tables) -> DataFrame:
    return evidence.decide(_evidence(t), "union")


@query("""
SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events) WHERE rn <= 3
""")
def first_events_per_user(t: Tables) -> DataFrame:
    return ranking.first_n_per_key(t.events, ["user_id"], ["ts", "event_id"], 3).select("user_id", "event_id", "value")


@query("""
SELECT c_custkey, o_orderkey, o_orderstatus FROM customer LEFT JOIN (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) o ON c_custkey = o_custkey AND rn = 1
""")
def last_wins_lookup(t: Tables) -> DataFrame:
    """Of the orders of a customer the one with the largest key replaces the others."""
    lookup = t.orders.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_orderstatus", F.col("o_orderkey").alias("_ord"))
    return joins.last_wins_lookup(t.customer.select("c_custkey"), lookup, "c_custkey", "_ord")


@query("""
SELECT o_orderkey, CASE WHEN l.l_orderkey IS NOT NULL THEN price ELSE o_totalprice END AS o_totalprice FROM orders
LEFT JOIN (SELECT l_orderkey, max(l_extendedprice) AS price FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey
""")
def fallback_lookup(t: Tables) -> DataFrame:
    """Price of the dearest line where an order has one, else the order's own price."""
    preferred = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("o_totalprice"))
    return joins.fallback_lookup(t.orders.select("o_orderkey", "o_totalprice"), preferred, "o_orderkey", ["o_totalprice"])


@query("""
SELECT o_orderkey, unnest(CASE o_orderkey % 3 WHEN 0 THEN ['G' || o_custkey] WHEN 1 THEN ['G' || o_custkey, 'S' || o_orderstatus] ELSE [] END) AS parent FROM orders
""")
def exploded_parents(t: Tables) -> DataFrame:
    gene = F.concat(F.lit("G"), F.col("o_custkey").cast("string"))
    both = F.concat(gene, F.lit(",S"), F.col("o_orderstatus"), F.lit(","))
    kind = F.col("o_orderkey") % 3
    rows = t.orders.select("o_orderkey", F.when(kind == 0, gene).when(kind == 1, both).otherwise(F.lit("")).alias("parent"))
    return joins.explode_parents(rows)


@query("""
WITH k AS (SELECT 'N' || c_nationkey || '__' || c_name || '__x' AS stable_id, c_acctbal FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier)
SELECT stable_id, CASE WHEN contains(stable_id, '__') THEN split_part(stable_id, '__', 1) END AS species_id,
       CASE WHEN contains(stable_id, '__') THEN substring(stable_id, strpos(stable_id, '__') + 2) ELSE stable_id END AS gene_id,
       CASE WHEN c_acctbal < 0 THEN 'Unassigned' WHEN c_acctbal < 100 THEN 'low' ELSE 'high' END AS label_or_unassigned,
       CASE WHEN c_acctbal < 0 THEN NULL WHEN c_acctbal < 100 THEN 'low' ELSE 'high' END AS label_or_null FROM k
""")
def keys_and_labels(t: Tables) -> DataFrame:
    """Keys built and split again, and the two fates of missing labels."""
    item = F.concat(F.col("c_name"), F.lit("__x"))
    built = scalars.stable_key(F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), item)
    rows = t.customer.select(built.alias("stable_id"), F.col("c_acctbal").alias("b")).unionByName(
        t.supplier.select(F.col("s_name").alias("stable_id"), F.col("s_acctbal").alias("b"))
    )
    label = F.when(F.col("b") < 0, " n/a\t").when(F.col("b") < 100, " low").otherwise("high ")
    return rows.select(
        "stable_id", scalars.key_unit("stable_id").alias("species_id"), scalars.key_item("stable_id").alias("gene_id"),
        scalars.label_or(label).alias("label_or_unassigned"), scalars.label_or_null(label).alias("label_or_null"),
    )


@query("""
WITH t AS (SELECT o_orderkey, '{"group_id":"' || o_orderpriority || '","method":"YN","stable_id":' || o_custkey || '}' AS j, o_orderdate, o_orderstatus, o_totalprice FROM orders),
s AS (SELECT *, sha256(j) AS signature FROM t),
prev AS (SELECT signature, o_orderkey FROM s WHERE o_orderdate < TIMESTAMP '1998-01-01' AND o_orderstatus <> 'P')
SELECT 'reused' AS part, o_orderkey, signature FROM prev
UNION ALL SELECT 'pending', o_orderkey, signature FROM s WHERE signature NOT IN (SELECT signature FROM prev)
""")
def incremental_reuse(t: Tables) -> DataFrame:
    """Orders to compute against results of orders before 1998, of which status P counts as failed."""
    named = t.orders.withColumns({"stable_id": F.col("o_custkey"), "group_id": F.col("o_orderpriority")})
    todo = reuse.with_signature(named, ["stable_id", "group_id"], {"method": "YN"})
    earlier = todo.where("o_orderdate < '1998-01-01'")
    previous = earlier.withColumn("qc_status", F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("PASS"))
    reused, pending = reuse.split_by_reuse(todo, previous)
    columns = ["o_orderkey", "signature"]
    return reused.select(F.lit("reused").alias("part"), *columns).unionByName(pending.select(F.lit("pending").alias("part"), *columns))


def _rules(t: Tables) -> dict[str, DataFrame]:
    lines = t.lineitem
    return {
        "UNIQUE_ORDER": expect.duplicate_keys(t.orders, ["o_orderkey"]),
        "UNIQUE_LINE": expect.duplicate_keys(lines, ["l_orderkey", "l_linenumber"]),
        "KNOWN_CUSTOMER": expect.unknown_keys(t.customer.select("c_custkey"), t.orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey"),
        "BALANCE_DOMAIN": expect.outside_domain(t.customer, "c_acctbal", "c_custkey"),
        "STATUS_ALLOWED": expect.outside_domain(t.orders, "o_orderstatus", "o_orderkey", allowed=["O", "F"]),
        "LABELS_CONSISTENT": expect.inconsistent(t.labels, t.documents.select("doc_id", (F.col("n_chars") % 2).alias("quality")), "doc_id", "quality"),
        "UNIQUE_MAPPING": expect.ambiguous_mapping(lines.select("l_suppkey"), t.supplier.select(F.col("s_nationkey").alias("l_suppkey"), "s_suppkey"), "l_suppkey", "s_suppkey"),
    }


def _check_rows(t: Tables) -> DataFrame:
    return expect.union_all([audit.rule_check(v, name, "tables", "BLOCK", name) for name, v in _rules(t).items()])


@query("""
WITH v AS (
  SELECT 'BALANCE_DOMAIN' AS check_id, count(*) AS n FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'KNOWN_CUSTOMER', count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT 'LABELS_CONSISTENT', count(*) FROM labels JOIN documents USING (doc_id) WHERE quality <> n_chars % 2
  UNION ALL SELECT 'STATUS_ALLOWED', count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
  UNION ALL SELECT 'UNIQUE_LINE', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT 'UNIQUE_MAPPING', count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem) l LEFT JOIN (SELECT s_nationkey, count(DISTINCT s_suppkey) AS k FROM supplier GROUP BY 1) s ON l_suppkey = s_nationkey WHERE coalesce(k, 0) <> 1
  UNION ALL SELECT 'UNIQUE_ORDER', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
SELECT check_id, 'tables' AS scope, 'tables' AS item_id, 'BLOCK' AS severity, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
       check_id AS message, 'violations=' || n AS evidence, '' AS remediation FROM v
""")
def quality_checks(t: Tables) -> DataFrame:
    return _check_rows(t)


@query("""
WITH v AS (SELECT count(*) AS n FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)
  UNION ALL SELECT count(*) FROM labels JOIN documents USING (doc_id) WHERE quality <> n_chars % 2
  UNION ALL SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F')
  UNION ALL SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
  UNION ALL SELECT count(*) FROM (SELECT DISTINCT l_suppkey FROM lineitem) l LEFT JOIN (SELECT s_nationkey, count(DISTINCT s_suppkey) AS k FROM supplier GROUP BY 1) s ON l_suppkey = s_nationkey WHERE coalesce(k, 0) <> 1
  UNION ALL SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1))
SELECT CASE WHEN count(*) FILTER (n > 0) > 0 THEN 'BLOCKED' ELSE 'READY' END AS overall_status, count(*) FILTER (n > 0) AS blocking_failures,
       0::BIGINT AS warnings, count(*) FILTER (n = 0) AS passed FROM v
""")
def overall_status(t: Tables) -> DataFrame:
    return audit.overall_status(_check_rows(t))


@query("""
WITH f AS (SELECT 'gene' AS kind, 'G' || c_custkey AS id, NULL AS parent FROM customer
  UNION ALL SELECT 'mrna', 'T' || o_orderkey, 'G' || o_custkey || CASE WHEN o_orderstatus = 'P' THEN ',G0' ELSE '' END FROM orders
  UNION ALL SELECT CASE l_returnflag WHEN 'A' THEN 'exon' WHEN 'N' THEN 'cds' ELSE 'note' END, NULL, 'T' || l_orderkey FROM lineitem),
tr AS (SELECT * FROM f WHERE kind = 'mrna')
SELECT 'ONE_PARENT_PER_TRANSCRIPT' AS rule, count(*) AS n FROM tr WHERE contains(parent, ',') HAVING count(*) > 0
UNION ALL SELECT 'TRANSCRIPT_PARENT_KNOWN', count(*) FROM tr WHERE NOT contains(parent, ',') AND parent NOT IN (SELECT id FROM f WHERE kind = 'gene') HAVING count(*) > 0
UNION ALL SELECT 'PART_PARENT_KNOWN', count(*) FROM f WHERE kind IN ('exon', 'cds') AND parent NOT IN (SELECT id FROM tr) HAVING count(*) > 0
""")
def hierarchy_violations(t: Tables) -> DataFrame:
    """Customers as genes, orders as transcripts, lines as parts; violations counted by rule."""
    nothing = F.lit(None).cast("string")
    gene = F.concat(F.lit("G"), F.col("o_custkey").cast("string"))
    second = F.when(F.col("o_orderstatus") == "P", ",G0").otherwise("")
    kind = F.when(F.col("l_returnflag") == "A", "exon").when(F.col("l_returnflag") == "N", "CDS").otherwise("note")
    genes = t.customer.select(
        F.lit("gene").alias("feature"), F.concat(F.lit("G"), F.col("c_custkey").cast("string")).alias("id"), nothing.alias("parent")
    )
    transcripts = t.orders.select(
        F.lit("mRNA").alias("feature"), F.concat(F.lit("T"), F.col("o_orderkey").cast("string")).alias("id"), F.concat(gene, second).alias("parent")
    )
    parts = t.lineitem.select(kind.alias("feature"), nothing.alias("id"), F.concat(F.lit("T"), F.col("l_orderkey").cast("string")).alias("parent"))
    found = expect.hierarchy_violations(genes.unionByName(transcripts).unionByName(parts))
    return found.groupBy("rule").agg(F.count("*").alias("n"))


@query("""
SELECT c_nationkey, c_mktsegment, count(*) AS n_samples FROM customer GROUP BY ALL HAVING count(*) < 10
""")
def replicate_warnings(t: Tables) -> DataFrame:
    return expect.replicate_warnings(t.customer, ["c_nationkey", "c_mktsegment"], 10)


@query(f"""
WITH {MEMBERSHIP_SQL},
best AS (SELECT l_partkey AS part_id, l_discount AS best_discount, l_extendedprice AS best_price FROM (
  SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_discount, l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey) AS rn FROM lineitem) WHERE rn = 1),
med AS (SELECT l_partkey AS part_id, count(l_tax) AS pair_count, round(quantile_cont(l_discount, 0.5), 6) AS median_l_discount, round(quantile_cont(l_tax, 0.5), 6) AS median_l_tax FROM lineitem GROUP BY 1),
modes AS (SELECT l_partkey AS part_id, string_agg(DISTINCT l_returnflag, ';' ORDER BY l_returnflag) AS flags, count(*) AS line_count, any_value('x') AS p_brand_lines FROM lineitem GROUP BY 1)
SELECT p_partkey AS part_id, p_brand, p_type, best_discount, best_price, unit_occupancy, member_count, occupancy_class,
       pair_count, median_l_discount, median_l_tax, flags, line_count, p_brand_lines
FROM part LEFT JOIN best ON best.part_id = p_partkey LEFT JOIN cls ON cls.part_id = p_partkey LEFT JOIN med ON med.part_id = p_partkey LEFT JOIN modes ON modes.part_id = p_partkey
""")
def master_table(t: Tables) -> DataFrame:
    """One row per part: best line, occupancy class, medians over its lines, packed flags."""
    base = t.part.select(F.col("p_partkey").alias("part_id"), "p_brand", "p_type")
    lines = t.lineitem.withColumnRenamed("l_partkey", "part_id")
    order = [F.col("l_discount"), F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_suppkey"]
    best = lines.withColumns({"best_discount": F.col("l_discount"), "best_price": F.col("l_extendedprice")})
    best = ranking.first_per_key(best, ["part_id"], order).select("part_id", "best_discount", "best_price")
    classes = occupancy.classify_groups(part_membership(t), "part_id", "unit", "member", NATIONS, CORE, SOFT, SHELL)
    classes = classes.select("part_id", "unit_occupancy", "member_count", "occupancy_class")
    medians = rounded(describe.per_end_medians(lines, ("part_id",), "part_id", ("l_discount", "l_tax"), "l_tax"))
    flags = lines.groupBy("part_id", "l_returnflag").agg(F.count("*").alias("n"))
    packed = flags.groupBy("part_id").agg(
        scalars.pack_sorted("l_returnflag").alias("flags"), F.sum("n").alias("line_count"), F.lit("x").alias("p_brand")
    )
    tables = [(best, "_best", []), (classes, "_pan", []), (medians, "_kaks", []), (None, "_absent", []), (packed, "_lines", [])]
    return joins.integrate(base, tables, "part_id")
