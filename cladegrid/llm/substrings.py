"""Substring dedup: removal of word windows that start at more than one place, by prefix-partitioned suffix trees.

A suffix starts at every word with at least ``width`` words to the end of its document; two of them whose common prefix
reaches ``width`` words meet in an internal node of that depth or more of the suffix tree, and the words below such nodes
are the repeats. The tree is never built whole:

* Suffixes are dealt by a short key taken from their first ``width`` words: the ``PREFIX``-word run with the least code
  among them (its anchor). Equal windows have equal anchors, and neighbours mostly share theirs, so they travel as one
  piece of text. An anchor that occurs once in the corpus leads to no repeat and is left out after a count.
* Keys have a variable length, so that a group fits a task: the suffixes of an anchor with over ``MOST`` occurrences
  are dealt by all their ``width`` words instead. Equal pieces of one batch are combined before they are sent, so even
  a passage that stands in a third of all documents sends a row per batch.
* In each task the suffixes of a group are sorted by blocks of words, which orders the leaves of its subtree;
  the common prefixes of neighbours give the depth of the internal nodes above them.

Blocks of words are compared by 64-bit codes. Defined cases: null, empty and short texts have no windows and stay as
they are; repeated rows repeat each other's windows; a null id is an id; other columns are carried, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from cladegrid.llm import words

WIDTH = 35
# Words of an anchor and of a block.
PREFIX = 8
# Occurrences of an anchor in one group.
MOST = 4096


def anchors(codes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts, the anchor position of each, and the codes of all ``PREFIX``-word runs.

    The anchor is the leftmost run with the least code among the runs inside the window.
    """
    runs = words.window_codes(codes, PREFIX)
    starts = words.window_starts(bounds, width)
    if not len(starts):
        return starts, starts, runs
    span, best, step = width - PREFIX + 1, np.arange(len(runs)), 1
    while step * 2 <= span:
        left, right = best[:-step], best[step:]
        best = np.where(runs[left] <= runs[right], left, right)
        step *= 2
    left, right = best[starts], best[starts + span - step]
    return starts, np.where(runs[left] <= runs[right], left, right), runs


def _stretches(starts: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First window index and number of windows of each run of windows with one anchor."""
    if not len(starts):
        return starts, starts
    first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]))
    return first, np.diff(np.concatenate([first, [len(starts)]]))


def _anchor_rows(width: int):
    """(id, t, anchor, n): the anchors of each text and how often each occurs in it."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found in words.word_slices(batch.column("text"), words.NON_BLANK, lower=False):
                starts, at, runs = anchors(found.codes, found.bounds, width)
                first, _ = _stretches(starts, at)
                rows = np.searchsorted(found.bounds, at[first], "right") - 1
                order = np.lexsort((runs[at[first]], rows))
                rows, codes = rows[order], runs[at[first]][order]
                fresh = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]) | (codes[1:] != codes[:-1])])) if len(rows) else rows
                n = np.diff(np.concatenate([fresh, [len(rows)]]))
                taken = pa.array(rows[fresh] + found.row)
                yield pa.RecordBatch.from_arrays([batch.column("id").take(taken), batch.column("t").take(taken), pa.array(codes[fresh].view(np.int64)), pa.array(n, pa.int64())], names=["id", "t", "anchor", "n"])

    return scan


def _pieces(width: int):
    """(id, t, key, first, n, twice, piece): the stretches of candidate windows, equal ones of a batch sent once.

    ``piece`` is the text of ``n`` windows from word ``first`` on; a null piece has an equal one in the same batch.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wanted, hot = batch.column("anchors"), batch.column("hot")
            out: list[tuple[np.ndarray, ...]] = []
            texts: list[bytes] = []
            for found in words.word_slices(batch.column("text"), words.NON_BLANK, lower=False):
                starts, at, runs = anchors(found.codes, found.bounds, width)
                whole = words.window_codes(found.codes, width)
                first, n = _stretches(starts, at)
                lead, row = starts[first], np.searchsorted(found.bounds, starts[first], "right") - 1
                code = runs[at[first]]
                keep, spread = np.zeros(len(first), bool), np.zeros(len(first), bool)
                cuts = np.searchsorted(row, np.arange(len(found.bounds)))
                for i in range(len(found.bounds) - 1):
                    a, b = cuts[i], cuts[i + 1]
                    if a < b:
                        keep[a:b] = np.isin(code[a:b].view(np.int64), wanted[found.row + i].values.to_numpy())
                        if len(hot[found.row + i]):
                            spread[a:b] = np.isin(code[a:b].view(np.int64), hot[found.row + i].values.to_numpy())
                single = np.repeat(np.flatnonzero(spread), n[spread])
                inner = np.concatenate([np.arange(k) for k in n[spread]]) if spread.any() else single
                lead = np.concatenate([lead[keep & ~spread], lead[single] + inner]).astype(np.int64)
                size = np.concatenate([n[keep & ~spread], np.ones(len(single), np.int64)]).astype(np.int64)
                key = np.concatenate([code[keep & ~spread], whole[lead[len(lead) - len(single) :]]])
                row = np.concatenate([row[keep & ~spread], row[single]]).astype(np.int64)
                # a piece has under two widths of words, so its first and its last window tell it
                content = words.mix(whole[lead] ^ words.mix(whole[lead + size - 1], 3), 1) + key if len(lead) else key
                out.append((row + found.row, key, lead - found.bounds[row], size, content))
                begin, end = found.first[lead].tolist(), found.last[lead + size + width - 2].tolist()
                data = found.data
                texts += [data[a:b].tobytes() for a, b in zip(begin, end)]
            row, key, first, size, content = (np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 5
            _, sample, inverse, times = np.unique(content, return_index=True, return_inverse=True, return_counts=True)
            sent = np.zeros(len(row), bool)
            sent[sample] = True
            key = np.where(sent, key.view(np.int64), words.mix((content + np.arange(len(content)).astype(np.uint64)).astype(np.uint64)).view(np.int64))
            taken = pa.array(row)
            pieces = pa.array([t.decode() if s else None for t, s in zip(texts, sent.tolist())], pa.string())
            arrays = [batch.column("id").take(taken), batch.column("t").take(taken), pa.array(key), pa.array(first), pa.array(size), pa.array(times[inverse] > 1), pieces]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "t", "key", "first", "n", "twice", "piece"])

    return scan


def deep_leaves(codes: np.ndarray, starts: np.ndarray, group: np.ndarray, width: int) -> np.ndarray:
    """Which suffixes lie below an internal node of at least ``width`` words in the subtree of their group.

    Sorting by group and then block by block orders the leaves; a leaf's deepest internal node has the depth of the
    longer of the common prefixes with its two neighbours.
    """
    steps = list(range(0, width, PREFIX))
    blocks = [words.window_codes(codes, min(PREFIX, width - s))[starts + s] for s in steps]
    order = np.lexsort([*blocks[::-1], group])
    depth, same = np.zeros(max(0, len(starts) - 1), np.int64), group[order][1:] == group[order][:-1]
    for s, block in zip(steps, blocks):
        ordered = block[order]
        same = same & (ordered[1:] == ordered[:-1])
        depth[same] = min(s + PREFIX, width)
    node = np.maximum(np.concatenate([[0], depth]), np.concatenate([depth, [0]])) if len(starts) else depth
    deep = np.zeros(len(starts), bool)
    deep[order] = node >= width
    return deep


def _resolve(width: int):
    """(id, t, first, last): runs of repeated words, from pieces sorted by key."""

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in words.key_runs(batches, ["key"]):
            group = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            first, n, twice = (table.column(c).to_numpy() for c in ("first", "n", "twice"))
            rows, begin, end = [], [], []
            known = np.flatnonzero(table.column("piece").combine_chunks().is_null().to_numpy(zero_copy_only=False) | twice)
            rows.append(known), begin.append(first[known]), end.append(first[known] + n[known] + width - 1)
            # pieces of one key are in one slice or compared across slices: take all words of the table together
            pieces = table.column("piece").combine_chunks()
            slices = list(words.word_slices(pieces, words.NON_BLANK, lower=False))
            codes = np.concatenate([s.codes for s in slices]) if slices else np.zeros(0, np.uint64)
            ends, base = [], 0
            for s in slices:
                ends.append(s.bounds[1:] + base)
                base += s.bounds[-1]
            cut = np.concatenate([[0], *ends]).astype(np.int64)
            starts = words.window_starts(cut, width)
            if len(starts):
                row = np.searchsorted(cut, starts, "right") - 1
                deep = deep_leaves(codes, starts, group[row], width)
                row, starts = row[deep], starts[deep]
                lead = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (starts[1:] != starts[:-1] + 1)])) if len(row) else row
                last = np.concatenate([lead[1:], [len(row)]])[: len(lead)] - 1
                rows.append(row[lead])
                begin.append(first[row[lead]] + starts[lead] - cut[row[lead]])
                end.append(first[row[lead]] + starts[last] - cut[row[lead]] + width)
            taken = pa.array(np.concatenate(rows).astype(np.int64))
            arrays = [table.column("id").combine_chunks().take(taken), table.column("t").combine_chunks().take(taken), pa.array(np.concatenate(begin).astype(np.int64)), pa.array(np.concatenate(end).astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "t", "first", "last"])

    return resolve


def _rows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """(id, t, text): ``t`` is a hash of the text, so that id and t name what a row holds."""
    return docs.select(*_columns(text, key))


def _columns(text: str, key: str) -> list[Column]:
    value = F.col(f"`{text}`").cast("string")
    return [F.col(f"`{key}`").alias("id"), F.xxhash64(F.coalesce(value, F.lit(""))).alias("t"), value.alias("text")]


def repeated_spans(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """(id, t, spans): runs of repeated words (last exclusive, unordered) of texts, named by id and text hash ``t``."""
    rows = _rows(docs, text, key)
    names = rows.select("id", "t")
    listed = rows.mapInArrow(_anchor_rows(width), names.select("id", "t", F.lit(0).cast("long").alias("anchor"), F.lit(0).cast("long").alias("n")).schema)
    repeated = listed.groupBy("anchor").agg(F.sum("n").alias("times")).where("times > 1").select("anchor", (F.col("times") > MOST).alias("many"))
    chosen = listed.select("id", "t", "anchor").join(repeated, "anchor").groupBy("id", "t").agg(F.collect_set("anchor").alias("anchors"), F.collect_set(F.when(F.col("many"), F.col("anchor"))).alias("hot"))
    chosen = chosen.select(F.col("id").alias("of"), F.col("t").alias("of_t"), "anchors", "hot")
    candidates = rows.join(chosen, F.col("id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("of_t"))).drop("of", "of_t")
    fields = names.select("id", "t", *[F.lit(0).cast("long").alias(c) for c in ("key", "first", "n")], F.lit(True).alias("twice"), F.lit("").alias("piece")).schema
    for f in fields:
        f.nullable = True
    dealt = candidates.mapInArrow(_pieces(width), fields).repartition("key").sortWithinPartitions("key")
    spans = dealt.mapInArrow(_resolve(width), names.select("id", "t", *[F.lit(0).cast("long").alias(c) for c in ("first", "last")]).schema)
    return spans.groupBy("id", "t").agg(F.collect_set(F.struct("first", "last")).alias("spans"))


def mark_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", keep: list[str] | None = None, width: int = WIDTH) -> DataFrame:
    """(row, text, spans): the columns ``keep`` (all by default) as a struct, the text, and its runs of repeated words."""
    spans = repeated_spans(docs, text, key, width).select(F.col("id").alias("of"), F.col("t").alias("of_t"), "spans")
    rows, kept = _rows(docs, text, key), F.struct(F.col("id").alias(key))
    if keep != [key]:
        more = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
        rows, kept = docs.select(more.alias("row"), *_columns(text, key)), F.col("row")
    # with the id alone these are the same rows, dealt by the same keys, as the search for spans reads: one exchange
    joined = rows.join(spans, F.col("id").eqNullSafe(F.col("of")) & (F.col("t") == F.col("of_t")), "left")
    return joined.select(kept.alias("row"), "text", "spans")


def kept_words(text: str | None, spans: np.ndarray | None) -> tuple[list[bytes], int]:
    """The words outside the spans, and the number of all words."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    first, last, _ = words.find_words(data, np.array([0, len(data)]), words.NON_BLANK)
    if spans is not None and len(spans):
        a = np.array([(s["first"], s["last"]) for s in spans])
        keep = ~words.covered(len(first), a[:, 0], a[:, 1] - a[:, 0])
        n, first, last = len(first), first[keep], last[keep]
    else:
        n = len(first)
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(first.tolist(), last.tolist())], n


@F.pandas_udf(StringType())
def _kept_text(texts: pd.Series, spans: pd.Series) -> pd.Series:
    return pd.Series([b" ".join(kept_words(t, s)[0]).decode() for t, s in zip(texts, spans)], dtype=object)


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """The columns of ``docs``; texts with repeated words keep their other words, joined by one space."""
    marked = mark_repeats(docs, text, key, None, width)
    cleaned = F.when(F.size("spans") > 0, _kept_text("text", "spans")).otherwise(F.col("text"))
    return marked.select(F.col("row").withField(f"`{text}`", cleaned).alias("row")).select("row.*")
