"""Secret scans through trigram queries: which rules can match a text at all, then exact matching of the candidates.

For each rule a Boolean query over ASCII-folded byte trigrams is derived from its regular expression: a text that the
rule matches satisfies the query. Every batch of texts gets an inverted index from the trigrams that the rules name to
the texts with them; postings are intersected and united as the query says, and only these candidates are searched by
the regular expression. A rule without mandatory trigrams scans every text. Index and search are local to a batch, so
nothing is shuffled and a lost task repeats only its own texts; whole texts are searched, without prefixes.

Defined cases: a null text is empty and has no spans; ids are carried as they are, null or repeated; matches of one
rule never overlap, those of different rules may; spans are in code points, end exclusive.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache
from re import _constants as C
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cladegrid.llm import words


class Rule(NamedTuple):
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more are secrets."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules in their order.
BASE_RULES = (
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # the runs [0-9a-f]+ of 24 characters or more
)
# Publicly documented token formats.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----[A-Za-z0-9+/=\s]*-----END (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    # these two start where a run of their characters starts, so that a long run is read once
    Rule("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("url_password", r"(?<![a-z])[a-z]++://[A-Za-z0-9._-]++:[^\s:@/]{4,}+@[A-Za-z0-9.-]+"),
)
RULES = BASE_RULES + MORE_RULES

SPANS = "array<struct<kind:string,start:long,end:long>>"

# A Boolean query: None (every text), a frozenset of byte strings (all of them), or ("or", queries), ("and", queries).
_WIDE = 8


def _fold(text: str) -> bytes:
    return text.encode().translate(_FOLD)


_FOLD = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_FOLD_TABLE = np.frombuffer(_FOLD, np.uint8)


def _conjunction(parts: list) -> object:
    parts = [p for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _trigrams(literal: bytes) -> frozenset | None:
    return frozenset(literal[i : i + 3] for i in range(len(literal) - 2)) or None


def _of_strings(strings: set[bytes]) -> object:
    """The query of texts that hold one of these strings."""
    each = [_trigrams(s) for s in sorted(strings)]
    return None if None in each or not each else each[0] if len(each) == 1 else ("or", tuple(each))


def _analyse(tokens: Sequence) -> tuple[set[bytes] | None, object]:
    """All strings that the tokens match (None: too many), and a query that every match satisfies."""
    exact: set[bytes] | None = {b""}
    run, queries = {b""}, []
    for op, value in tokens:
        strings, query = _token(op, value)
        if strings is not None and len(run) * len(strings) <= _WIDE * _WIDE:
            run = {a + b for a, b in itertools.product(run, strings)}
        else:
            queries += [_of_strings(run), query]
            run = strings if strings is not None and len(strings) <= _WIDE * _WIDE else {b""}
            exact = None
    queries.append(_of_strings(run))
    return (run if exact is not None else None), _conjunction(queries)


def _token(op: object, value: object) -> tuple[set[bytes] | None, object]:
    if op is C.LITERAL:
        return {_fold(chr(value))}, None
    if op is C.IN:
        if any(kind is not C.LITERAL for kind, _ in value):
            return None, None
        found = {_fold(chr(x)) for _, x in value}
        return (found, None) if len(found) <= _WIDE else (None, None)
    if op is C.SUBPATTERN:
        return _analyse(value[-1])
    if op is C.BRANCH:
        each = [_analyse(branch) for branch in value[1]]
        strings = set().union(*(s for s, _ in each)) if all(s is not None for s, _ in each) else None
        query = None if any(q is None for _, q in each) else ("or", tuple(q for _, q in each))
        return strings, query
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, inner = value
        strings, query = _analyse(inner)
        if strings is not None and high <= 2:
            return {b"".join(x) for n in range(low, high + 1) for x in itertools.product(strings, repeat=n)}, query if low else None
        return None, query if low else None
    return ({b""}, None) if op is C.AT else (None, None)


@lru_cache
def trigram_query(pattern: str) -> object:
    """The Boolean trigram query of a regular expression; None if it has no mandatory trigrams."""
    return _analyse(list(_parser.parse(pattern)))[1]


def _named(query: object) -> set[bytes]:
    if query is None:
        return set()
    return set(query) if isinstance(query, frozenset) else set().union(*map(_named, query[1]))


@lru_cache(2)
def _places(order: tuple[bytes, ...]) -> np.ndarray:
    """By trigram code, its place in the order from 1, or 0; one table for all batches of a worker."""
    wanted = np.zeros(1 << 24, np.uint16)
    for i, t in enumerate(order):
        wanted[t[0] << 16 | t[1] << 8 | t[2]] = i + 1
    return wanted


class TextIndex:
    """Postings (sorted rows) of the named trigrams over one batch of texts."""

    def __init__(self, column: pa.Array, named: set[bytes]) -> None:
        order = sorted(named)
        wanted = _places(tuple(order))
        found: list[list[np.ndarray]] = [[] for _ in order]
        for row, data, offsets in words.text_slices(column):
            folded = _FOLD_TABLE[data].astype(np.uint32)
            grams = wanted[folded[:-2] << 16 | folded[1:-1] << 8 | folded[2:]] if len(folded) > 2 else np.zeros(0, np.uint16)
            at = np.flatnonzero(grams)
            rows = np.searchsorted(offsets, at, "right") - 1
            inside = at + 3 <= offsets[rows + 1]
            pairs = np.unique(grams[at[inside]].astype(np.int64) << 40 | (rows[inside] + row))
            kinds = pairs >> 40
            for i in np.unique(kinds):
                found[i - 1].append(pairs[kinds == i] & (1 << 40) - 1)
        self.rows = len(column)
        self.postings = {t: np.concatenate(f) if f else np.zeros(0, np.int64) for t, f in zip(order, found)}

    def candidates(self, query: object) -> np.ndarray:
        """Rows that satisfy the query."""
        if query is None:
            return np.arange(self.rows)
        if isinstance(query, frozenset):
            out = None
            for t in sorted(query, key=lambda t: len(self.postings[t])):
                out = self.postings[t] if out is None else np.intersect1d(out, self.postings[t], assume_unique=True)
            return out
        each = [self.candidates(q) for q in query[1]]
        join = np.union1d if query[0] == "or" else np.intersect1d
        out = each[0]
        for rows in each[1:]:
            out = join(out, rows)
        return out


def find_secrets(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(row, text, spans): the columns ``keep`` (all by default) as a struct, the text, and its secrets by start, then rule."""
    rules = tuple(rules)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = [trigram_query(r.pattern) for r in rules]
        named = set().union(*map(_named, queries))
        compiled = [re.compile(r.pattern) for r in rules]
        for batch in batches:
            column = batch.column("text")
            index = TextIndex(column, named)
            spans: list[list[tuple[int, int, int]]] = [[] for _ in range(batch.num_rows)]
            for k, (rule, query) in enumerate(zip(rules, queries)):
                for row in index.candidates(query).tolist():
                    for m in compiled[k].finditer(column[row].as_py() or ""):
                        if len(m[rule.group]) >= rule.least:
                            spans[row].append((m.start(), k, m.end()))
            listed = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in sorted(s)] for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column("row"), column, pa.array(listed, _SPAN_TYPE)], names=["row", "text", "spans"])

    kept = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
    chosen = docs.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = chosen.select("row", "text", F.array().cast(SPANS).alias("spans")).schema
    return chosen.mapInArrow(scan, schema)


_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def redact(docs: DataFrame, text: str = "text", mask: str = "[secret]", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The columns of ``docs`` with every run of secret characters replaced by the mask."""
    found = find_secrets(docs, text, None, rules)

    @F.pandas_udf(StringType())
    def masked(texts, spans):
        import pandas as pd

        out = []
        for value, each in zip(texts, spans):
            if value is None:  # also rows without spans get here
                out.append(None)
                continue
            pieces, at = [], 0
            for span in each:
                if span["start"] >= at:
                    pieces += [value[at : span["start"]], mask]
                at = max(at, span["end"])
            out.append("".join([*pieces, value[at:]]))
        return pd.Series(out, dtype=object)

    cleaned = F.when(F.size("spans") > 0, masked("text", "spans")).otherwise(F.col("text"))
    return found.select(F.col("row").withField(f"`{text}`", cleaned).alias("row")).select("row.*")
