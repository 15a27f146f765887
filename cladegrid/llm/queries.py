"""Queries op1 to op13 over whole tables, the pipeline, and their SQL counterparts where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladegrid.llm import alignment, chat, decontaminate, language, licences, mixing, neardup, personal, secrets, substrings, topk, trie, urls
from cladegrid.session import apply_plan_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def register(fn: Callable[[Callable[[str], DataFrame]], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_plan_settings(spark)
            return fn(lambda table: spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet"))

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


# Escaping as the template does it, to count what it adds.
_ESCAPED = r"""regexp_replace({0}, '([<\[])(\\*)(\||s>|/s>|SYS>>|/SYS>>|INST\]|/INST\])', '\1\\\2\3', 'g')"""
_CHAT_SQL = f"""
with messages as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
select conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
  sum(12 + 10 + 11 + length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}))::bigint as formatted_chars
from messages group by conv_id
"""


@_query(_CHAT_SQL)
def op1_chat_formatting(table):
    rows = table("conversations").select("conv_id", "turn", "role", "text")
    kinds = {f.name: f.dataType for f in rows.schema}
    extra = rows.sparkSession.range(2).select(
        F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")
    )
    formatted = chat.format_trees(chat.chain(rows.unionByName(extra), "conv_id", "turn"))
    turns = chat.read_turns(F.col("formatted"))
    loss = F.array_join(chat.read_loss(F.col("formatted"), F.col("loss_spans")), "")
    read = formatted.select(F.col("tree").alias("conv_id"), turns.alias("turns"), loss.alias("loss"), F.length("formatted").cast("long").alias("formatted_chars"))
    listed = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select("conv_id", F.size("turns").cast("long").alias("n_turns"), _sha(listed).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), _sha(F.col("loss")).alias("loss_sha256"), "formatted_chars")


@_query()
def op2_secret_scans(table):
    found = secrets.find_secrets(table("documents"), keep=["doc_id"])
    base = [r.kind for r in secrets.BASE_RULES]
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        *[of(kind).alias(f"n_{kind}") for kind in base],
        _sha(listed(F.filter("spans", lambda s: s["kind"].isin(base)))).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )


_MIX_SQL = """
with sized as (select doc_id, source, md5(coalesce(text, '')) as digest, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size from documents),
sources as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (select *, [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from sources),
ranked as (select *, 3 * source_size / weight as cap, row_number() over (order by 3 * source_size / weight, source nulls last) as place from weighed),
levels as (select *, (sum(source_size) over () - 3 * coalesce(sum(source_size) over (order by place rows between unbounded preceding and 1 preceding), 0))::double
  / sum(weight) over (order by place rows between current row and unbounded following) as level from ranked),
fitting as (select level from levels where level * weight <= 3 * source_size order by cap, level limit 1),
targets as (select source, source_size, least((3 * source_size)::double, coalesce((select level from fitting) * weight, (3 * source_size)::double)) as target from levels),
rated as (select *, case when source_size > 0 then least(target / source_size, 3.0::double) else 0.0::double end as rate from targets)
select d.doc_id, d.size, r.source_size, r.target,
  d.size * (floor(rate)::bigint + case when ('0x' || substr(md5('7:' || coalesce(d.doc_id::varchar, '') || ':' || d.digest), 1, 13))::bigint / 4503599627370496.0::double < rate - floor(rate) then 1 else 0 end) as taken
from sized d join rated r on d.source is not distinct from r.source
"""


@_query(_MIX_SQL)
def op3_source_mixing(table):
    rows = mixing.repeats(table("documents"))
    return rows.select(F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@_query()
def op4_near_duplicates(table):
    found = neardup.near_duplicates(table("documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


@_query()
def op5_language_ids(table):
    docs = table("documents")
    fold = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))
    model = language.fit(docs.where(fold != 0))
    found = language.predict(docs.withColumn("held_out", fold == 0), model, keep=["doc_id", "held_out"])
    return found.select("row.*", "lang_pred", "score")


_TOP_SQL = """
with whole as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score from whole q join whole c on q.vec_id % 20 = 0 and q.vec_id <> c.vec_id),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 20
"""


@_query(_TOP_SQL)
def op6_top_k_search(table):
    vectors = topk.whole_vectors(table("embeddings"), "vec_id", "embedding")
    index = topk.build_index(vectors)
    return topk.search(index, index.rows.where(F.col("id") % 20 == 0).select("id", "vector"), 20)


_TEMPLATE_ROWS = ", ".join("({}, '{}', '{}')".format(i, name, text) for i, (name, text) in enumerate(licences.TEMPLATES))
_LICENCE_SQL = f"""
with files as (select doc_id, source || '/' || (doc_id // 64)::varchar || '/' || (doc_id // 8)::varchar as folder, text,
  coalesce(regexp_matches(text, '(?i)licen[sc]e|copyright|spdx-'), false) as marked from documents),
named as (select *, folder || '/' || case when marked then 'LICENSE' else 'text' end || '-' || doc_id::varchar as path from files),
found as (
  select distinct doc_id, path, folder, statement from (select doc_id, path, folder, unnest(regexp_split_to_array(text, '\r?\n|\r')) as statement from named where marked)
    where regexp_matches(statement, '(?i)licen[sc]e|copyright|spdx-')
  union select doc_id, path, folder, text from named where marked),
texts as (select distinct statement from found),
models(template, licence, model) as (values {_TEMPLATE_ROWS}),
own as (select statement, term, count(*) as n from (select statement, unnest(regexp_extract_all(lower(statement), '{licences.TERM}')) as term from texts) group by all),
terms as (select template, licence, term, count(*) as n from (select template, licence, unnest(regexp_extract_all(lower(model), '{licences.TERM}')) as term from models) group by all),
units as (select term, 's' || statement as unit from own union all select term, 't' || template::varchar from terms),
idf as (select term, ln((1.0 + (select count(distinct unit) from units)) / (1.0 + count(*))) + 1 as idf from units group by term),
w as (select statement, term, (1 + ln(n)) * idf as w from own join idf using (term)),
v as (select template, licence, term, (1 + ln(n)) * idf as v from terms join idf using (term)),
norms as (select statement, sqrt(sum(w * w)) as norm from w group by statement),
lengths as (select template, sqrt(sum(v * v)) as length from v group by template),
cosine as (select statement, licence, round(sum(w * v) / (any_value(norm) * any_value(length)), 6) as score
  from w join v using (term) join norms using (statement) join lengths using (template) group by statement, template, licence),
best as (select * from cosine where score >= 0.6 qualify row_number() over (partition by statement order by score desc, licence) = 1),
scored as (select f.*, licence, score from found f join best using (statement)),
own_best as (select * from scored qualify row_number() over (partition by doc_id order by score desc, licence) = 1),
licensed as (select folder, licence, score from scored qualify row_number() over (partition by folder order by score desc, licence) = 1),
ups as (select distinct folder, unnest([folder, regexp_replace(folder, '/[^/]*$', ''), regexp_replace(folder, '/[^/]*/[^/]*$', '')]) as up from named where folder is not null),
near as (select u.folder, u.up as from_folder, l.licence, l.score from ups u join licensed l on l.folder = u.up qualify row_number() over (partition by u.folder order by length(u.up) desc) = 1)
select n.doc_id, n.path, coalesce(o.licence, r.licence) as licence, coalesce(o.score, r.score) as score,
  case when o.licence is not null then 'own' when r.licence is not null then 'inherited' end as how,
  case when o.licence is null then r.from_folder end as from_folder
from named n left join own_best o on o.doc_id = n.doc_id left join near r on r.folder = n.folder
"""


@_query(_LICENCE_SQL)
def op7_licence_scans(table):
    """Documents as a tree source/doc_id div 64/doc_id div 8; those with a licence statement are their folder's licence files."""
    marked = F.when(F.col("text").rlike(licences.MARKER), "LICENSE").otherwise("text")
    path = F.concat_ws("/", F.col("source"), F.floor(F.col("doc_id") / 64).cast("string"), F.floor(F.col("doc_id") / 8).cast("string"), F.concat(marked, F.lit("-"), F.col("doc_id").cast("string")))
    path = F.when(F.col("source").isNotNull() & F.col("doc_id").isNotNull(), path)
    found = licences.scan_licences(table("documents").select("doc_id", path.alias("path"), "text"), "doc_id", "path", "text")
    return found.withColumnRenamed("key", "doc_id")


@_query()
def op8_decontamination(table):
    found = decontaminate.find_spans(table("documents"), table("benchmark"), keep=["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"])
    counted = found.select(F.col("row.doc_id").alias("doc_id"), "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), _sha(F.array_join("items", ",")).alias("items_sha256"))
    return counted.withColumn("contaminated", F.col("n_hit") > 0)


@_query()
def op9_substring_dedup(table):
    marked = substrings.mark_repeats(table("documents"), keep=["doc_id"])

    def digest(batches):
        for batch in batches:
            out = []
            for text, spans in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                kept, n = substrings.kept_words(text, spans)
                out.append((n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
            columns = list(zip(*out)) or [()] * 3
            arrays = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    chosen = marked.select(F.col("row.doc_id").alias("doc_id"), "text", "spans")
    fields = chosen.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"), F.lit("").alias("kept_sha256"))
    return chosen.mapInArrow(digest, fields.schema)


# Host, path, allow.
_RULES = (("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False))
_URL_SQL = r"""
with recursive rules(rule_host, rule_path, allow) as (values ('org', '/', true), ('example.org', '/es/', false), ('example.org', '/en/1', false), ('com', '/fr/', true), ('com', '/de/', false)),
links as (
  select url, replace(case when regexp_matches(tag, '(?is)[\s"'']rel\s*=\s*["'']?canonical\b') then regexp_extract(tag, '(?is)[\s"'']href\s*=\s*["'']?([^"''\s>]+)', 1)
    when regexp_matches(tag, '(?is)[\s"'']http-equiv\s*=\s*["'']?refresh\b') then regexp_extract(tag, '(?is)\burl\s*=\s*["'']?([^"''\s>;]+)', 1) end, '&amp;', '&') as target
  from (select url, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) as tag from pages where regexp_matches(html, '(?i)canonical|refresh'))),
based as (select url, target, regexp_extract(url, '^(.*?)://', 1) as scheme, regexp_extract(url, '://([^/?#]*)', 1) as host, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) as path from links where target <> ''),
joined as (select url, case when regexp_matches(target, '(?i)^https?://') then target when regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*:') or target like '#%' then null
  when target like '//%' then scheme || ':' || target when target like '/%' then scheme || '://' || host || target when target like '?%' then scheme || '://' || host || path || target
  else scheme || '://' || host || (case when path = '' then '/' else regexp_extract(path, '^.*/', 0) end) || target end as to_url from based),
cut as (select url, to_url, regexp_extract(to_url, '(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$', 1) as origin, regexp_extract(to_url, '(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$', 2) as path,
  regexp_extract(to_url, '(?s)^(.*?://[^/?#]*)([^?#]*)(.*)$', 3) as rest from joined where to_url is not null),
resolved as (select url, case when regexp_matches(path, '/\.\.?(/|$)') then origin || '/' || array_to_string(list_concat(
    list_reduce(list_prepend([]::varchar[], list_transform(string_split(path, '/')[2:], lambda s: [s])), lambda done, s: case s[1] when '..' then done[:greatest(len(done) - 1, 0)] when '.' then done else list_concat(done, s) end),
    case when string_split(path, '/')[-1] in ('.', '..') then [''] else [] end), '/') || rest else to_url end as to_url from cut),
urls as (select url from pages where url is not null union select to_url from resolved),
named as (select url, case when contains(url, '://') then translate(regexp_extract(url, '(?s)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
  case when contains(url, '://') then regexp_extract(url, '(?s)://[^/?#]*([^?#]*)', 1) else '' end as path,
  case when contains(url, '://') then regexp_extract(url, '(?s)://[^/?#]*[^?#]*([^#]*)', 1) else '' end as query from urls),
fitting as (select n.url, rule_host || rule_path as rule, allow, row_number() over (partition by n.url order by length(rule_host || rule_path) desc, allow, rule_host || rule_path) as at
  from named n join rules r on (n.host = r.rule_host or n.host like '%.' || r.rule_host) and starts_with(n.path, r.rule_path)),
judged as (select n.*, case when n.host <> '' then n.host || n.path || n.query end as node, f.rule, f.allow from named n left join fitting f on f.url = n.url and f.at = 1),
edges as (select a.node as a, b.node as b from resolved r join judged a on a.url = r.url join judged b on b.url = r.to_url where a.node is not null and b.node is not null),
ways as (select a, b from edges union select b, a from edges),
reached(node) as (select node from judged where not allow and node is not null union select w.b from reached r join ways w on w.a = r.node)
select p.page_id, coalesce(j.host, '') as host, coalesce(j.path, '') as path, j.rule,
  case when j.allow is not null then case when j.allow then 'allow' else 'block' end when j.node in (select node from reached) then 'block' else 'allow' end as verdict
from pages p left join judged j on j.url = p.url
"""


@_query(_URL_SQL)
def op10_url_filters(table):
    pages = table("pages")
    rules = pages.sparkSession.createDataFrame(_RULES, "host string, path string, allow boolean")
    return urls.judge_pages(pages, rules, urls.page_links(pages)).withColumnRenamed("key", "page_id")


# crc32 by one bit after the other, as DuckDB has none
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(conv_id::varchar, ''), lambda c: ascii(c)::bigint)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))))"""
_TRIE_SQL = f"""
with told as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null),
turns as (select conv_id, row_number() over (partition by conv_id order by turn nulls first, digest) - 1 as pos, digest, words
  from (select conv_id, turn, sha256(length(role)::varchar || ':' || role || text) as digest, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))::bigint as words from told)),
convs as (select conv_id, conv_id - conv_id % 20 as base, {_CRC32} % 4 as h from (select distinct conv_id from turns)),
taken as (select c.conv_id, t.pos, t.digest, t.words from convs c join turns t on t.conv_id = c.base and t.pos < c.h),
counted as (select c.conv_id, c.h, count(t.pos) as taken from convs c left join taken t on t.conv_id = c.conv_id group by all),
rebuilt as (select * from taken union all select t.conv_id, t.pos - c.h + c.taken, t.digest, t.words from turns t join counted c using (conv_id) where t.pos >= c.h),
paths as (select conv_id, pos + 1 as depth, words, string_agg(digest, '') over (partition by conv_id order by pos) as node from rebuilt union all select conv_id, 0, 0, '' from convs),
nodes as (select node, depth, any_value(words) as words, min(conv_id) as conv_id, count(*) as n_convs from paths group by node, depth),
linked as (select n.*, p.node as parent from nodes n left join paths p on p.conv_id = n.conv_id and p.depth = n.depth - 1),
children as (select parent, count(*) as n_children from linked where parent is not null group by parent),
full_nodes as (select l.*, coalesce(c.n_children, 0) as n_children from linked l left join children c on c.parent = l.node),
below as (select p.node, sum((f.n_children = 0)::int) as n_leaves, sum((f.n_convs - 1) * f.words) as saved_tokens from full_nodes f join paths p on p.conv_id = f.conv_id and p.depth <= f.depth group by p.node),
ends as (select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids from (select conv_id, arg_max(node, depth) as node from paths group by conv_id) group by node)
select f.conv_id, f.depth::bigint as depth, u.conv_id as parent_conv_id, f.n_convs::bigint as n_convs, f.n_children::bigint as n_children, b.n_leaves::bigint as n_leaves,
  b.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from full_nodes f left join nodes u on u.node = f.parent join below b on b.node = f.node left join ends e on e.node = f.node
"""


@_query(_TRIE_SQL)
def op11_prefix_trie(table):
    turns, convs = trie.share_openings(trie.number_turns(table("conversations")), 20, 4)
    return trie.prefix_trie(turns, convs)


@_query()
def op12_tokenizer_alignment(table):
    return alignment.align(table("documents"), keep=["doc_id"]).select("row.*", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@_query()
def op13_personal_data(table):
    docs = table("documents")
    found = personal.find_personal(docs, personal.fit(docs), keep=["doc_id"])
    listed = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(F.col("row.doc_id").alias("doc_id"), *[of(kind).alias(f"n_{kind}") for kind in personal.KINDS], _sha(listed(F.col("base"))).alias("base_sha256"), listed(F.col("spans")).alias("spans"))
