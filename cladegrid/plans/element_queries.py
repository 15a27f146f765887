"""Elements in texts: a document carries elements (words by length), a language and a source label it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.functions import scalars, sequences
from cladegrid.operators import distribution, evidence, expect, intervals, ranking, tiles
from cladegrid.plans.registry import Tables, query, rounded
from cladegrid.session import shared_folder
from cladegrid.sources import fasta, gff, hits

# Aggregation levels and the labels each needs.
LEVELS = {
    "SPECIES_SUBFAMILY": ("species_id", "subfamily"),
    "SUBFAMILY": ("subfamily",),
    "SPECIES": ("species_id",),
    "GROUP": ("group",),
    "GROUP_SUBFAMILY": ("group", "subfamily"),
}
DIMENSIONS = ("species_id", "subfamily", "group")
WORD = "[ \\t\\r\\n]+"


def word_hits(t: Tables) -> DataFrame:
    """One row per word of every text; its element is its length."""
    words = t.documents.select("doc_id", F.explode(F.split("text", WORD)).alias("word")).where("word <> ''")
    return words.select("doc_id", F.concat(F.lit("L"), F.length("word").cast("string")).alias("element"), "word")


def carriers(t: Tables) -> DataFrame:
    labels = t.labels.select("doc_id", F.concat(F.lit("Q"), F.col("quality").cast("string")).alias("group"))
    named = t.documents.select(
        "doc_id", "n_chars", F.col("lang").alias("species_id"), F.when(F.col("source") != "src7", F.col("source")).alias("subfamily")
    )
    return named.join(labels, "doc_id", "left")


def elements_of_texts(t: Tables) -> distribution.ElementDistribution:
    hits_of_words = word_hits(t).select("doc_id", "element")
    return distribution.ElementDistribution(hits_of_words, carriers(t), "doc_id", "element", "n_chars", DIMENSIONS, LEVELS)


HITS_SQL = """
words AS (SELECT doc_id, unnest(regexp_split_to_array(text, '[ \\t\\r\\n]+')) AS word FROM documents),
hits AS (SELECT doc_id, 'L' || length(word) AS element, word FROM words WHERE word <> '')
"""
LEVELS_SQL = f"""
{HITS_SQL},
c AS (SELECT d.doc_id, n_chars, lang AS species_id, CASE WHEN source <> 'src7' THEN source END AS subfamily, 'Q' || quality AS "group"
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
lv AS ({" UNION ALL ".join(
    f"SELECT doc_id, n_chars, '{name}' AS aggregation_level, "
    + " || '|' || ".join(f"'{d}=' || " + f'"{d}"' for d in used) + " AS cell_id, "
    + ", ".join((f'"{d}"' if d in used else "'NOT_APPLICABLE'") + f' AS "{d}"' for d in DIMENSIONS)
    + ", " + " AND ".join(f'"{d}" IS NOT NULL' for d in used) + " AS eligible FROM c"
    for name, used in LEVELS.items())}),
cells AS (SELECT aggregation_level, cell_id, species_id, subfamily, "group", count(*) AS n_carriers, CAST(sum(n_chars) AS BIGINT) AS total_length
          FROM lv WHERE eligible GROUP BY ALL),
per AS (SELECT doc_id, element, count(*) AS h FROM hits GROUP BY ALL),
counts AS (SELECT aggregation_level, cell_id, element, sum(h) AS hit_count, count(*) AS carriers_with_hit
           FROM per JOIN lv USING (doc_id) WHERE eligible GROUP BY ALL),
grid AS (SELECT cells.*, e.element, CAST(coalesce(hit_count, 0) AS BIGINT) AS hit_count, coalesce(carriers_with_hit, 0) AS carriers_with_hit,
                coalesce(hit_count, 0)::DOUBLE / nullif(n_carriers, 0)::DOUBLE AS hits_per_carrier,
                coalesce(hit_count, 0)::DOUBLE / nullif(total_length / 1000.0, 0)::DOUBLE AS hits_per_kb
         FROM cells CROSS JOIN (SELECT DISTINCT element FROM hits) e LEFT JOIN counts USING (aggregation_level, cell_id, element))
"""


def _z_sql(value: str) -> tuple[str, str]:
    w = "(PARTITION BY aggregation_level, element)"
    sd = f"stddev_pop({value}) OVER {w}"
    status = (
        f"CASE WHEN {value} IS NULL THEN 'MISSING_DENOMINATOR' WHEN count({value}) OVER {w} < 2 THEN 'INSUFFICIENT_CELLS' "
        f"WHEN {sd} <= 1e-12 THEN 'ZERO_VARIANCE' ELSE 'PASS' END"
    )
    score = (
        f"CASE WHEN {value} IS NULL OR count({value}) OVER {w} < 2 THEN NULL WHEN {sd} <= 1e-12 THEN 0 "
        f"ELSE ({value} - avg({value}) OVER {w}) / {sd} END"
    )
    return status, score


_RAW, _RATE = _z_sql("hit_count"), _z_sql("hits_per_kb")


@query(f"""
WITH {LEVELS_SQL}
SELECT aggregation_level, cell_id, species_id, subfamily, "group", element, hit_count, carriers_with_hit, n_carriers, total_length,
       round(hits_per_carrier, 6) AS hits_per_carrier, round(hits_per_kb, 6) AS hits_per_kb, round({_RAW[1]}, 5) AS zscore_hit_count,
       {_RAW[0]} AS raw_zscore_status, round({_RATE[1]}, 5) AS zscore_hits_per_kb, {_RATE[0]} AS rate_zscore_status,
       'PER_ELEMENT_ACROSS_CELLS' AS zscore_axis, 0::BIGINT AS zscore_ddof
FROM grid
""")
def element_distribution(t: Tables) -> DataFrame:
    found = elements_of_texts(t).distribution()
    scores = {c: F.round(c, 5) for c in ("zscore_hit_count", "zscore_hits_per_kb")}
    return rounded(found.withColumns(scores))


@query(f"""
WITH {LEVELS_SQL}
SELECT aggregation_level, CASE aggregation_level {" ".join(f"WHEN '{n}' THEN '{','.join(d)}'" for n, d in LEVELS.items())} END AS required_annotations,
       count(*) AS total_carriers, count(*) FILTER (eligible) AS eligible_carriers, count(*) FILTER (NOT eligible) AS excluded_missing_annotation,
       (SELECT count(*) FROM cells WHERE cells.aggregation_level = lv.aggregation_level) AS n_cells, (SELECT count(DISTINCT element) FROM hits) AS n_elements,
       (SELECT count(*) FROM cells WHERE cells.aggregation_level = lv.aggregation_level) * (SELECT count(DISTINCT element) FROM hits) AS complete_grid_rows,
       (SELECT count(*) FROM cells WHERE cells.aggregation_level = lv.aggregation_level AND total_length <= 0) AS cells_zero_length,
       'PER_ELEMENT_ACROSS_CELLS' AS zscore_axis, 0::BIGINT AS zscore_ddof, 'PASS' AS qc_status
FROM lv GROUP BY aggregation_level
""")
def element_distribution_quality(t: Tables) -> DataFrame:
    return elements_of_texts(t).quality()


@query(f"""
WITH {HITS_SQL}, w AS (SELECT doc_id, element, CASE element WHEN 'L1' THEN 'short' WHEN 'L2' THEN 'short' ELSE CASE WHEN substr(element, 2)::INT >= 12 THEN 'long' ELSE 'Unclassified' END END AS major_class,
  CASE element WHEN 'L1' THEN 'one' ELSE element END AS subclass FROM hits)
SELECT doc_id, major_class, subclass, element, count(*) AS element_count FROM w GROUP BY ALL
""")
def element_counts(t: Tables) -> DataFrame:
    """Hits per document, class and element after the category map; unmapped elements are Unclassified.

    The map calls one or two letters short and twelve or more long.
    """
    hits = word_hits(t).select("doc_id", "element")
    rows = [("L1", "short", "one"), ("L2", "short", None)]  # fixed values: the short part of the map
    categories = t.spark.createDataFrame(rows, "element string, major_class string, subclass string")
    long = hits.select("element").distinct().where(F.substr("element", F.lit(2)).cast("int") >= 12)
    categories = categories.unionByName(long.select("element", F.lit("long").alias("major_class"), F.lit(None).cast("string").alias("subclass")))
    classed = evidence.classify_elements(hits, categories)
    filled = classed.withColumn("subclass", F.coalesce("subclass", "element"))
    return filled.groupBy("doc_id", "major_class", "subclass", "element").agg(F.count("*").alias("element_count"))


@query(f"""
WITH {HITS_SQL} SELECT doc_id, count(*) AS element_total, string_agg(DISTINCT element, ';' ORDER BY element) AS elements FROM hits GROUP BY doc_id
""")
def element_totals(t: Tables) -> DataFrame:
    """Hits per document and the sorted list of its elements, of which there are at most twelve."""
    per_element = word_hits(t).groupBy("doc_id", "element").agg(F.count("*").alias("n"))
    return per_element.groupBy("doc_id").agg(F.sum("n").alias("element_total"), scalars.pack_sorted("element").alias("elements"))


@query(f"WITH {HITS_SQL} SELECT word, count(*) AS count FROM hits GROUP BY word ORDER BY count(*) DESC, word LIMIT 25")
def top_words(t: Tables) -> DataFrame:
    return ranking.top_labels(word_hits(t), "word", 25)


@query(f"""
WITH {LEVELS_SQL} SELECT element, CAST(sum(hit_count) AS BIGINT) AS total FROM grid WHERE aggregation_level = 'SPECIES'
GROUP BY element ORDER BY total DESC, element LIMIT 5
""")
def heatmap_elements(t: Tables) -> DataFrame:
    """The five elements with most hits within one level."""
    species = elements_of_texts(t).distribution().where("aggregation_level = 'SPECIES'")
    return ranking.top_by_sum(species, "element", "hit_count", 5)


_LENGTHS = [f"L{i}" for i in range(1, 13)]


@query(f"""
WITH {LEVELS_SQL} SELECT cell_id, {", ".join(f"coalesce(max(hit_count::DOUBLE) FILTER (element = '{e}'), 0) AS {e}" for e in _LENGTHS)},
  coalesce(sum(hit_count) FILTER (element NOT IN ({", ".join(f"'{e}'" for e in _LENGTHS)})), 0)::DOUBLE AS longer
FROM grid WHERE aggregation_level = 'SPECIES_SUBFAMILY' GROUP BY cell_id
""")
def level_matrix(t: Tables) -> DataFrame:
    """A column for each of twelve word lengths, and one for all longer words."""
    cells = elements_of_texts(t).distribution().where("aggregation_level = 'SPECIES_SUBFAMILY'")
    column = F.when(F.col("element").isin(_LENGTHS), F.col("element")).otherwise("longer")
    summed = cells.groupBy("cell_id", column.alias("element")).agg(F.sum("hit_count").alias("hit_count"))
    return distribution.ordered_matrix(summed, "cell_id", "element", "hit_count", [*_LENGTHS, "longer"], fill=0.0)


@query(f"""
WITH {LEVELS_SQL} SELECT cell_id, element, hit_count FROM grid WHERE aggregation_level = 'SPECIES_SUBFAMILY'
""")
def level_matrix_long(t: Tables) -> DataFrame:
    """The whole matrix, a row for each cell and element."""
    return elements_of_texts(t).distribution().where("aggregation_level = 'SPECIES_SUBFAMILY'").select("cell_id", "element", "hit_count")


@query("SELECT lang, count(*) AS count FROM documents GROUP BY lang HAVING count(*) > 0")
def positive_label_counts(t: Tables) -> DataFrame:
    return distribution.positive_slices(distribution.label_counts(t.documents, "lang"), "lang")


@query("""
SELECT doc_id, len(parts) AS n_items, parts[1] AS first_item, parts[-1] AS last_item FROM (
  SELECT doc_id, CASE WHEN upper(trim(text, ' ' || chr(9) || chr(10) || chr(13))) = 'NA' THEN [] ELSE
    [y FOR y IN [trim(x, ' ' || chr(9) || chr(10) || chr(13)) FOR x IN string_split(replace(text, ';', ','), ',')] IF y <> ''] END AS parts FROM documents)
""")
def packed_items(t: Tables) -> DataFrame:
    """Texts as packed cells: number of items, the first and the last."""
    items = t.documents.select("doc_id", scalars.split_multi("text").alias("items"))
    return items.select(
        "doc_id",
        F.size("items").cast("long").alias("n_items"),
        F.try_element_at("items", F.lit(1)).alias("first_item"),
        F.try_element_at("items", F.lit(-1)).alias("last_item"),
    )


@query("""
WITH g AS (SELECT doc_id, text, length(text) AS len, CAST(n_chars // 3 + 1 AS BIGINT) AS gs, CAST(n_chars // 3 + 40 AS BIGINT) AS ge,
                  CASE doc_id % 5 WHEN 0 THEN '.' WHEN 1 THEN '-' ELSE '+' END AS strand, doc_id NOT IN (SELECT doc_id FROM labels) AS lost FROM documents),
r AS (SELECT *, CASE strand WHEN '+' THEN gs - 1 - 200 WHEN '-' THEN ge - 10 END AS rs, CASE strand WHEN '+' THEN gs - 1 + 10 WHEN '-' THEN ge + 200 END AS re FROM g),
b AS (SELECT *, CASE WHEN NOT lost THEN greatest(0, rs) END AS s0, CASE WHEN NOT lost THEN least(len, re) END AS e0 FROM r)
SELECT doc_id, CASE WHEN NOT lost AND strand = '+' THEN gs WHEN NOT lost AND strand = '-' THEN ge END AS tss_1based,
       CASE WHEN strand <> '.' THEN s0 + 1 END AS window_start, CASE WHEN strand <> '.' THEN e0 END AS window_end,
       CASE WHEN strand <> '.' AND NOT lost THEN greatest(0, e0 - s0) END AS window_length, CASE WHEN strand <> '.' THEN s0 <> rs OR e0 <> re END AS truncated,
       CASE WHEN lost THEN 'CHROMOSOME_NOT_FOUND' WHEN strand = '.' THEN 'INVALID_STRAND' WHEN s0 <> rs OR e0 <> re THEN 'TRUNCATED_AT_CHROMOSOME_BOUNDARY' ELSE 'PASS' END AS window_qc,
       CASE WHEN strand = '.' OR lost THEN NULL WHEN strand = '-'
            THEN reverse(translate(substring(text, s0 + 1, greatest(0, e0 - s0)), 'ACGTRYMKBDHVNacgtrymkbdhvn', 'TGCAYRKMVHDBNtgcayrkmvhdbn'))
            ELSE substring(text, s0 + 1, greatest(0, e0 - s0)) END AS sequence
FROM b
""")
def start_windows(t: Tables) -> DataFrame:
    """Windows around a position of each text, complemented on the minus strand; unlabelled documents lack a sequence."""
    third = F.floor(F.col("n_chars") / 3)
    strand = F.when(F.col("doc_id") % 5 == 0, ".").when(F.col("doc_id") % 5 == 1, "-").otherwise("+")
    items = t.documents.select("doc_id", (third + 1).alias("gene_start"), (third + 40).alias("gene_end"), strand.alias("strand"))
    known = t.documents.join(t.labels.select("doc_id"), "doc_id", "left_semi")
    lengths = known.select("doc_id", F.length("text").cast("long").alias("length"), "text")
    windows = intervals.start_windows(items, lengths, 200, 10, ["doc_id"])
    return windows.select(
        "doc_id", "tss_1based", "window_start", "window_end", "window_length", "truncated", "window_qc",
        intervals.window_sequence("text").alias("sequence"),
    )


@query("""
SELECT doc_id, CASE WHEN length(text) >= greatest(1, n_chars // 2 - 200) THEN
  substring(text, greatest(1, n_chars // 2 - 200), length(text) - greatest(1, n_chars // 2 - 200) + 1) END AS slice FROM documents
""")
def closed_slices(t: Tables) -> DataFrame:
    """The later half of every text and some more, by coordinates that may lie outside of it."""
    first = F.floor(F.col("n_chars") / 2) - 200
    return t.documents.select("doc_id", sequences.closed_substring("text", first, F.col("n_chars") + 7).alias("slice"))


_FREE_MASS = " + ".join(f"(length(clean) - length(replace(clean, '{r}', ''))) * {m}::DOUBLE" for r, m in sequences.AMINO_ACID_MASS.items())


@query(f"""
WITH s AS (SELECT doc_id, rtrim(upper(replace(text, 'ß', 'SS')), '*') AS raw, regexp_replace(rtrim(upper(replace(text, 'ß', 'SS')), '*'), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS clean FROM documents)
SELECT doc_id, CASE WHEN clean <> '' THEN round({_FREE_MASS} - (length(clean) - 1) * 18.0153::DOUBLE, 6) END AS molecular_weight_da,
       CASE WHEN clean = '' THEN 'NO_STANDARD_RESIDUES' WHEN length(clean) <> length(raw) THEN 'NON_STANDARD_RESIDUES_REMOVED' ELSE 'PASS' END AS protein_property_qc
FROM s
""")
def sequence_mass(t: Tables) -> DataFrame:
    found = sequences.with_protein_properties(t.documents.select("doc_id", "text"), "text")
    return rounded(found.select("doc_id", "molecular_weight_da", "protein_property_qc"))


def _end_sql(end: str, by_residue: dict[str, float], other: float) -> str:
    return "CASE " + end + "".join(f" WHEN '{r}' THEN {pk}" for r, pk in by_residue.items()) + f" ELSE {other} END::DOUBLE"


def _count_sql(residue: str) -> str:
    return f"(length(clean) - length(replace(clean, '{residue}', '')))"


_CHARGE_SQL = " ".join(
    [f"+ {_count_sql(r)} / (1 + pow(10, low + half - {pk}))" for r, pk in sequences.PK_POSITIVE.items()]
    + [f"- {_count_sql(r)} / (1 + pow(10, {pk} - low - half))" for r, pk in sequences.PK_NEGATIVE.items()]
)


@query(f"""
WITH s AS (SELECT doc_id, rtrim(upper(replace(text, 'ß', 'SS')), '*') AS raw, regexp_replace(rtrim(upper(replace(text, 'ß', 'SS')), '*'), '[^ACDEFGHIKLMNPQRSTVWY]', '', 'g') AS clean FROM documents),
e AS (SELECT *, {_end_sql("clean[1]", sequences.PK_N_TERMINUS_BY_RESIDUE, sequences.PK_N_TERMINUS)} AS n_pk, {_end_sql("clean[-1]", sequences.PK_C_TERMINUS_BY_RESIDUE, sequences.PK_C_TERMINUS)} AS c_pk FROM s)
SELECT doc_id, CASE WHEN clean <> '' THEN round({_FREE_MASS} - (length(clean) - 1) * 18.0153::DOUBLE, 6) END AS molecular_weight_da,
       CASE WHEN clean <> '' THEN round({sequences.LAST_HALF}::DOUBLE + list_reduce(list_prepend(0::DOUBLE, {sequences.HALVINGS}::DOUBLE[]),
         lambda low, half: CASE WHEN 0::DOUBLE {_CHARGE_SQL} + 1 / (1 + pow(10, low + half - n_pk)) - 1 / (1 + pow(10, c_pk - low - half)) > 0 THEN low + half ELSE low END), 6) END AS theoretical_pi,
       CASE WHEN clean = '' THEN 'NO_STANDARD_RESIDUES' WHEN length(clean) <> length(raw) THEN 'NON_STANDARD_RESIDUES_REMOVED' ELSE 'PASS' END AS protein_property_qc
FROM e
""")
def sequence_properties(t: Tables) -> DataFrame:
    """With the isoelectric point."""
    found = sequences.with_protein_properties(t.documents.select("doc_id", "text"), "text")
    return rounded(found.drop("text"))


_CODON_SQL = "map([" + ", ".join(f"'{a}{b}{c}'" for a in "TCAG" for b in "TCAG" for c in "TCAG") + "], [" + ", ".join(
    f"'{r}'" for r in sequences.CODON_RESIDUES
) + "])"
_BASES = ("abcdefghijklmnopqrstuvwxyz", "acgtacgtacgtacgtacgtacgtac")


@query(f"""
WITH s AS (SELECT doc_id, upper(translate(lower(regexp_replace(text, '[^a-zA-Z]', '', 'g')), '{_BASES[0]}', '{_BASES[1]}')) AS cds FROM documents)
SELECT doc_id, CAST(length(cds) % 3 AS INTEGER) AS cds_modulo_3,
       array_to_string([coalesce({_CODON_SQL}[substring(cds, CAST(i * 3 + 1 AS BIGINT), 3)], 'X') FOR i IN range(length(cds) // 3)], '') AS protein FROM s
""")
def translated_texts(t: Tables) -> DataFrame:
    """Letters of a text mapped onto four bases and read as codons."""
    letters = F.lower(F.regexp_replace("text", "[^a-zA-Z]", ""))
    cds = F.upper(F.translate(letters, *_BASES))
    return t.documents.select("doc_id", cds.alias("cds")).select(
        "doc_id", (F.length("cds") % 3).alias("cds_modulo_3"), sequences.translate_codons("cds").alias("protein")
    )


@query("""
SELECT l_orderkey, l_linenumber, 'second' AS id, 'O' || l_orderkey AS parent, CAST(l_quantity AS BIGINT) || '=' || l_returnflag AS note, l_linestatus AS name FROM lineitem
""")
def attribute_maps(t: Tables) -> DataFrame:
    """Attribute text built from each line (both notations, a repeated key) and parsed again."""
    text = F.concat(
        F.lit(" ID=L;Parent=O"), F.col("l_orderkey").cast("string"), F.lit(",X ; ID=second;Note="),
        F.col("l_quantity").cast("long").cast("string"), F.lit("="), F.col("l_returnflag"), F.lit('; gene_name "'), F.col("l_linestatus"), F.lit('";'),
    )
    parsed = gff.with_attributes(t.lineitem.select("l_orderkey", "l_linenumber", text.alias("text")), "text", "a")
    return parsed.select(
        "l_orderkey", "l_linenumber", F.col("a")["ID"].alias("id"), gff.first_parent(F.col("a")["Parent"]).alias("parent"),
        F.col("a")["Note"].alias("note"), F.col("a")["gene_name"].alias("name"),
    )


@query("""
SELECT p_partkey, p_size + 0.5::DOUBLE AS complete_pct, p_size::DOUBLE AS single_copy_pct, 0.5::DOUBLE AS duplicated_pct, 1.25::DOUBLE AS fragmented_pct,
       2.0::DOUBLE AS missing_pct, p_partkey AS busco_n FROM part WHERE p_size <> 7
UNION ALL SELECT p_partkey, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_size = 7
""")
def completeness_lines(t: Tables) -> DataFrame:
    """Completeness notation written from part sizes and parsed; another text gives NULLs."""
    size = F.col("p_size").cast("string")
    line = F.concat(
        F.lit("\tC:"), size, F.lit(".5%[S:"), size, F.lit("%, D:0.5%],F:1.25%,M:2%,n:"), F.col("p_partkey").cast("string")
    )
    text = F.when(F.col("p_size") == 7, "no result").otherwise(line)
    parsed = hits.parse_completeness(t.part.select("p_partkey", text.alias("value")))
    return parsed.drop("value")


@query("""
WITH ids AS (SELECT CASE o_orderkey % 4 WHEN 0 THEN 'T' || o_orderkey WHEN 1 THEN 'transcript:T' || o_orderkey WHEN 2 THEN 'T' || o_orderkey ELSE 'U' || o_orderkey END AS transcript_id,
  CASE o_orderkey % 4 WHEN 0 THEN 'T' || o_orderkey WHEN 1 THEN 'T' || o_orderkey WHEN 2 THEN 'transcript:T' || o_orderkey ELSE 'U' || o_orderkey || '|x' END AS seq_id FROM orders)
SELECT * FROM ids
""")
def matched_sequence_ids(t: Tables) -> DataFrame:
    """Orders as ids and as sequence names in the four notations that are matched."""
    key, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 4
    t_name, u_name = F.concat(F.lit("T"), key), F.concat(F.lit("U"), key)
    prefixed = F.concat(F.lit("transcript:"), t_name)
    ids = t.orders.select(F.when(kind == 1, prefixed).when(kind == 3, u_name).otherwise(t_name).alias("transcript_id"))
    names = t.orders.select(
        F.when(kind == 2, prefixed).when(kind == 3, F.concat(u_name, F.lit("|x"))).otherwise(t_name).alias("seq_id")
    )
    return sequences.match_sequence_ids(ids, names)


@query("""
SELECT 'CUSTOMER' AS left_table, 'PART' AS right_table, (SELECT count(*) FROM customer) AS left_ids, (SELECT count(*) FROM part) AS right_ids,
       (SELECT count(*) FROM customer JOIN part ON c_custkey = p_partkey) AS shared_ids, 'REVIEW' AS status
UNION ALL SELECT 'CUSTOMER', 'SUPPLIER', (SELECT count(*) FROM customer), (SELECT count(*) FROM supplier), (SELECT count(*) FROM customer JOIN supplier ON c_custkey = s_suppkey), 'REVIEW'
UNION ALL SELECT 'PART', 'SUPPLIER', (SELECT count(*) FROM part), (SELECT count(*) FROM supplier), (SELECT count(*) FROM part JOIN supplier ON p_partkey = s_suppkey), 'REVIEW'
""")
def namespace_overlap(t: Tables) -> DataFrame:
    tables = {
        "CUSTOMER": t.customer.select(F.col("c_custkey").alias("id")),
        "PART": t.part.select(F.col("p_partkey").alias("id")),
        "SUPPLIER": t.supplier.select(F.col("s_suppkey").alias("id")),
    }
    return expect.namespace_overlap(tables, "id")


def _scratch(t: Tables, name: str) -> str:
    """A new folder in the shared folder of the session."""
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


def letter_tiles(t: Tables, width: int) -> DataFrame:
    """The letters of every text as a sequence file of many parts, written and read back in tiles."""
    folder = _scratch(t, "letters")
    letters = F.regexp_replace(F.upper(F.coalesce("text", F.lit(""))), "[^A-Z]", "")
    fasta.write_fasta(t.documents.select(F.concat(F.lit("d"), F.col("doc_id")).alias("seq_id"), letters.alias("sequence")), folder)
    return tiles.read_tiles(t.spark, folder, width)


_LETTERS_SQL = "s AS (SELECT doc_id, regexp_replace(upper(replace(text, 'ß', 'SS')), '[^A-Z]', '', 'g') AS q FROM documents)"


@query(f"""
WITH {_LETTERS_SQL}, w AS (SELECT doc_id, q, length(q) // 2 - 700 AS a, length(q) // 2 + 900 AS b FROM s)
SELECT doc_id, greatest(a, 1) AS first, CASE WHEN greatest(a, 1) <= least(b, length(q)) THEN substring(q, greatest(a, 1), least(b, length(q)) - greatest(a, 1) + 1) END AS piece FROM w
""")
def tiled_windows(t: Tables) -> DataFrame:
    """1,600 letters around the middle of every text, cut from tiles of a thousand that were written and read back."""
    width = 1000
    read = letter_tiles(t, width).select(F.substr("seq_id", F.lit(2)).cast("long").alias("doc_id"), "tile", "residues")
    lengths = t.documents.select("doc_id").join(tiles.tile_lengths(read, ["doc_id"], width), "doc_id", "left")
    middle = F.floor(F.coalesce("length", F.lit(0)) / 2)
    windows = lengths.select("doc_id", (middle - 700).alias("start"), (middle + 900).alias("end"))
    cut = tiles.cut_intervals(windows, read, ["doc_id"], width=width)
    return cut.select("doc_id", F.greatest("start", F.lit(1).cast("long")).alias("first"), "piece")


@query(f"""
WITH {_LETTERS_SQL}, c AS (SELECT doc_id, substring(q, 1, 90) || substring(q, 950, 151) || substring(q, 2001, 60) AS plus FROM s WHERE q <> '')
SELECT doc_id, length(plus) AS cds_length, sha256(CASE WHEN doc_id % 2 = 0 THEN plus ELSE reverse(translate(plus, 'ACGTRYMKBDHVN', 'TGCAYRKMVHDBN')) END) AS cds_sha256 FROM c
""")
def tiled_splices(t: Tables) -> DataFrame:
    """Three segments of every text's letters, one of them over a tile border, put together on their strand."""
    read = letter_tiles(t, 1000).withColumnRenamed("seq_id", "seqid")
    parts = F.array(*[F.struct(F.lit(a).cast("long").alias("start"), F.lit(b).cast("long").alias("end")) for a, b in ((2001, 2060), (1, 90), (950, 1100))])
    strand = F.when(F.col("doc_id") % 2 == 0, "+").otherwise("-")
    segments = t.documents.select(F.col("doc_id").alias("transcript_id"), F.concat(F.lit("d"), F.col("doc_id")).alias("seqid"), strand.alias("strand"), F.inline(parts))
    cds = tiles.spliced_from_tiles(segments, read, ["seqid"], width=1000)
    return cds.select(F.col("transcript_id").alias("doc_id"), F.length("cds").cast("long").alias("cds_length"), F.sha2(F.col("cds").cast("binary"), 256).alias("cds_sha256"))
