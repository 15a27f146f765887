"""Benchmark decontamination: windows of normalised words of test items, found in training texts by a broadcast set.

Words are lower-cased (A-Z) runs of ASCII letters, digits and all characters above ASCII. A window is ``width``
consecutive words of an item; an item of fewer words, but some, is one window. The set of window codes is broadcast
within a stated bound: items are dealt into as many parts as keep each part under ``most_windows`` windows, and every
part scans the corpus once. Code hits are verified word by word before they count.

Defined cases: null and empty texts have no words and no hits; items without words match nothing; repeated items and
rows are each reported; item ids are given as strings, a null id as ``null``; documents are judged row by row, whatever
their ids; other columns, of any name, are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cladegrid.llm import words
from cladegrid.session import cut_lineage

WIDTH = 10
# Windows in one broadcast part; with their words and items they take about 1 KB each in Python.
MOST_WINDOWS = 100_000

WINDOW_SCHEMA = "item string, code long, length int, window string"
SPANS = "array<struct<first:int,last:int>>"


def _joined(found: words.Words, at: int, length: int) -> str:
    """Words at .. at + length - 1, lower-cased and joined by one space."""
    pieces = [found.data[found.first[w] : found.last[w]].tobytes() for w in range(at, at + length)]
    return b" ".join(pieces).translate(_LOWER).decode("utf-8", "surrogateescape")


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def item_windows(items: DataFrame, item: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """The distinct windows (item, code, length, window) of each item."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            ids = batch.column(0).to_pylist()
            for found in words.word_slices(batch.column(1), words.LETTERS_DIGITS, lower=True):
                for i, (a, b) in enumerate(zip(found.bounds[:-1], found.bounds[1:])):
                    length = min(width, int(b - a))
                    if length:
                        codes = words.window_codes(found.codes[a:b], length).view(np.int64)
                        out += {(ids[found.row + i], int(c), length, _joined(found, int(a) + k, length)) for k, c in enumerate(codes)}
            columns = list(zip(*out)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.string()))], names=["item", "code", "length", "window"])

    chosen = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.col(text).cast("string").alias("text"))
    return chosen.mapInArrow(windows, WINDOW_SCHEMA).distinct()


class _Part:
    """One broadcast part of the windows: codes by length with a bit filter in front, words and items by code."""

    def __init__(self, rows: list[tuple[str, int, int, str]]) -> None:
        self.windows: dict[int, dict[str, list[str]]] = defaultdict(lambda: defaultdict(list))
        by_length: dict[int, list[int]] = defaultdict(list)
        for item, code, length, window in rows:
            self.windows[code & (1 << 64) - 1][window].append(item)
            by_length[length].append(code)
        self.windows = {c: dict(w) for c, w in self.windows.items()}
        self.sets = {}
        for length, codes in by_length.items():
            unique = np.unique(np.array(codes, np.int64).view(np.uint64))
            bits = max(16, int(len(unique)).bit_length() + 5)
            filled = np.zeros(1 << bits, bool)
            filled[(unique >> np.uint64(64 - bits)).astype(np.int64)] = True
            self.sets[length] = (unique, np.uint64(64 - bits), filled)

    def hits(self, found: words.Words) -> Iterator[tuple[int, int, list[str]]]:
        """(word position, length, items) of each verified occurrence."""
        for length, (unique, shift, filled) in self.sets.items():
            codes = words.window_codes(found.codes, length)
            maybe = np.flatnonzero(filled[(codes >> shift).astype(np.int64)])
            maybe = maybe[unique[np.minimum(np.searchsorted(unique, codes[maybe]), len(unique) - 1)] == codes[maybe]]
            ends = np.repeat(found.bounds[1:], np.diff(found.bounds))
            for at in maybe[maybe + length <= ends[maybe]].tolist():
                if items := self.windows[int(codes[at])].get(_joined(found, at, length)):
                    yield at, length, items


def _runs(hit: np.ndarray) -> list[dict[str, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"first": int(a), "last": int(b)} for a, b in zip(edges[::2], edges[1::2])]


def _scan(part: Broadcast):
    """Adds the part's hits to the columns n_words, spans and items."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, held = batch.column("spans").to_pylist(), batch.column("items").to_pylist()
            counts, spans, items = [0] * batch.num_rows, [[]] * batch.num_rows, [[]] * batch.num_rows
            for found in words.word_slices(batch.column("text"), words.LETTERS_DIGITS, lower=True):
                rows = len(found.bounds) - 1
                in_row = defaultdict(list)
                for at, length, ids in part.value.hits(found):
                    in_row[int(np.searchsorted(found.bounds, at, "right")) - 1].append((at, length, ids))
                for i in range(rows):
                    a, b = int(found.bounds[i]), int(found.bounds[i + 1])
                    counts[found.row + i] = b - a
                    old = before[found.row + i] or []
                    if i in in_row:
                        hit = in_row[i]
                        starts = [h[0] - a for h in hit] + [s["first"] for s in old]
                        lengths = [h[1] for h in hit] + [s["last"] - s["first"] for s in old]
                        spans[found.row + i] = _runs(words.covered(b - a, np.array(starts), np.array(lengths)))
                        items[found.row + i] = sorted({x for h in hit for x in h[2]} | set(held[found.row + i] or []))
                    else:
                        spans[found.row + i], items[found.row + i] = old, held[found.row + i] or []
            new = {"n_words": pa.array(counts, pa.int64()), "spans": pa.array(spans, _SPAN_TYPE), "items": pa.array(items, pa.list_(pa.string()))}
            yield pa.RecordBatch.from_arrays([new.get(n, batch.column(n)) for n in batch.schema.names], names=batch.schema.names)

    return scan


_SPAN_TYPE = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def _parts(windows: DataFrame, most_windows: int) -> list[Broadcast]:
    """Broadcast parts of at most about ``most_windows`` windows; there are as many as the benchmark needs."""
    windows = cut_lineage(windows)
    count = -(-windows.count() // most_windows)
    context = windows.sparkSession.sparkContext
    parts = []
    for k in range(count):
        part = windows.where(F.pmod(F.xxhash64("code", "item"), F.lit(count)) == k)
        parts.append(context.broadcast(_Part([tuple(r) for r in part.toLocalIterator()])))
    return parts


def find_spans(docs: DataFrame, items: DataFrame, text: str = "text", keep: list[str] | None = None, width: int = WIDTH, most_windows: int = MOST_WINDOWS, item: str = "item_id", item_text: str = "text") -> DataFrame:
    """(row, text, n_words, spans, items) of each row: ``row`` holds the columns ``keep`` (all by default) as a struct,
    ``spans`` the runs of hit words (last exclusive), ``items`` the sorted ids of the items with occurring windows."""
    kept = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
    fresh = {"n_words": F.lit(0).cast("long"), "spans": F.array().cast(SPANS), "items": F.array().cast("array<string>")}
    out = docs.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"), *[c.alias(n) for n, c in fresh.items()])
    parts = _parts(item_windows(items, item, item_text, width), most_windows)
    for k, part in enumerate(parts or [docs.sparkSession.sparkContext.broadcast(_Part([]))]):
        if k:
            out = cut_lineage(out)
        out = out.mapInArrow(_scan(part), out.schema)
    return out


def remove_spans(text: str | None, spans: list) -> str | None:
    """The text without the words of the spans; what stands between words goes with the word before it."""
    if text is None or not len(spans):
        return text
    data, out, at = text.encode(), [], 0
    first, _, _ = words.find_words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), words.LETTERS_DIGITS)
    for span in spans:
        out.append(data[at : first[span["first"]]])
        at = first[span["last"]] if span["last"] < len(first) else len(data)
    return b"".join([*out, data[at:]]).decode()


@F.pandas_udf(StringType())
def _without(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([remove_spans(t, s) for t, s in zip(texts, spans)], dtype=object)


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", drop: bool = False, width: int = WIDTH, most_windows: int = MOST_WINDOWS) -> DataFrame:
    """The columns of ``docs`` without the hit spans, or (``drop``) without the documents that have hits."""
    found = find_spans(docs, items, text, None, width, most_windows)
    if drop:
        return found.where(F.size("spans") == 0).select("row.*")
    cleaned = F.when(F.size("spans") > 0, _without("text", "spans")).otherwise(F.col("text"))
    return found.select(F.col("row").withField(f"`{text}`", cleaned).alias("row")).select("row.*")
