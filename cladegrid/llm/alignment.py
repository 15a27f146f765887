"""Alignment of two tokenizers: groups of tokens between shared byte offsets, linked pairs, and their corpus-wide counts.

Both tokenizations of a text cover the same bytes. Offsets at which tokens of both end cut them into groups: starting
from whole texts, a common end near the middle of an interval is located by bisecting the other side's ends, and both
halves are cut again; an interval without a common end is a leaf group. All A-B pairs of tokens of a group are linked.

How many documents hold a pair is counted without a row per document and pair. A task takes its documents in chunks of
about ``chunk_bytes`` of text and keeps, for a chunk, the different pairs with their number of documents once, and each
document's pairs as places in that list. Only the lists are counted together; totals return to a chunk by its key and
are summed up per document there. Nothing grows with the corpus in a task: lists are as long as a chunk allows, and the
pairs of one A token are at most as many as B has tokens. Tokenizer files are broadcast, as their size is fixed.

Defined cases: a null or empty text, or one whose tokens do not spell it (for instance U+2581, which B reads as a
space), has no tokens, zeros everywhere and an empty digest; every row is a document of its own, with or without an id.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage

TOKENIZERS = "/opt/tokenizers"
A_FILE, B_FILE = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
CHUNK_BYTES = 16 << 20
# Texts of a chunk are aligned in slices of about so many bytes, one text at least.
SLICE_BYTES = 1 << 20
# Probes next to the middle that are made for all intervals at once before the rest are looked at one by one.
PROBES = 16
# Groups with more pairs than this are linked through their different ids and how often these occur.
WIDE_GROUP = 4096
# Fixed value: the split into pieces of byte-level BPE files.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class _Table:
    """Byte strings by index, spelled out for whole index arrays at once."""

    def __init__(self, strings: list[bytes]) -> None:
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def spell(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the strings in order, and the end of each."""
        lengths = self.lengths[index]
        ends = np.cumsum(lengths)
        shift = self.starts[index] - (ends - lengths)
        return self.data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(shift, lengths)], ends


class ByteTokenizer:
    """Byte-level BPE from a tokenizer file: space and text to ids, without special tokens."""

    def __init__(self, file: bytes) -> None:
        import tiktoken
        from tokenizers import Tokenizer

        described = json.loads(file)
        back = _byte_characters()
        vocabulary = {bytes(back[c] for c in token): i for token, i in described["model"]["vocab"].items()}
        size = max(vocabulary.values()) + 1
        strings = [b""] * size
        for token, i in vocabulary.items():
            strings[i] = token
        self.size, self.table = size, _Table(strings)
        # where ids follow the merges, ranks give the same tokens in a fraction of the time
        merges = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        ranked = all(len(strings[i]) == 1 for i in range(256)) and [vocabulary.get(bytes(back[c] for c in a + b)) for a, b in merges] == list(range(256, 256 + len(merges)))
        plain = described["normalizer"] is None and described["pre_tokenizer"] == {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
        if ranked and plain:
            ranks = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=vocabulary, special_tokens={})
            self._ids = lambda texts: [ranks.encode_ordinary(t) for t in texts]
        else:
            whole = Tokenizer.from_str(file.decode())
            whole.encode_special_tokens = True
            self._ids = lambda texts: [e.ids for e in whole.encode_batch(texts, add_special_tokens=False)]

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self._ids([" " + t for t in texts])]


class PieceTokenizer:
    """Sentence pieces with byte fallback: text to ids; the model puts a space before it."""

    def __init__(self, file: bytes) -> None:
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_proto=file)
        self.size = self._model.vocab_size()
        self.table = _Table([self._bytes(i) for i in range(self.size)])

    def _bytes(self, i: int) -> bytes:
        piece = self._model.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self._model.is_byte(i) else piece.replace("▁", " ").encode()

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int64) for x in self._model.encode(texts, num_threads=1)] if texts else []


@lru_cache(2)
def _tokenizers(a: bytes, b: bytes) -> tuple[ByteTokenizer, PieceTokenizer, _Table]:
    first, second = ByteTokenizer(a), PieceTokenizer(b)
    # decimal ids followed by a comma, and by what ends their side of a group
    marked = [b"%d%c" % (i, mark) for size, marks in ((first.size, b",|"), (second.size, b",;")) for mark in marks for i in range(size)]
    return first, second, _Table(marked)


def common_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` (ascending) that also are in ``ends_b``; the last ends of both are equal."""

    def shared(at: np.ndarray) -> np.ndarray:
        return ends_b[np.searchsorted(ends_b, ends_a[at])] == ends_a[at]

    cuts = [np.array([len(ends_a) - 1])]
    low, high = np.zeros(1, np.int64), np.array([len(ends_a) - 1])  # places low to high - 1 may be cuts
    while True:
        open_ = high > low
        low, high = low[open_], high[open_]
        if not len(low):
            return np.sort(np.concatenate(cuts))
        middle = (low + high - 1) // 2
        found = np.full(len(low), -1)
        left = np.arange(len(low))
        for step in range(2 * PROBES):
            place = middle[left] + ((step + 1) // 2 if step % 2 else -(step // 2))
            inside = (place >= low[left]) & (place < high[left])
            hit = np.zeros(len(left), bool)
            hit[inside] = shared(place[inside])
            found[left[hit]] = place[hit]
            left = left[~hit]
            reach = (step + 1) // 2
            left = left[(middle[left] + reach < high[left]) | (middle[left] - reach >= low[left])]
            if not len(left):
                break
        for i in left.tolist():
            found[i] = _nearest(shared, int(low[i]), int(high[i]), int(middle[i]))
        cut = found >= 0
        cuts.append(found[cut])
        low, high = np.stack([low[cut], found[cut] + 1], 1).ravel(), np.stack([found[cut], high[cut]], 1).ravel()


def _nearest(shared, low: int, high: int, middle: int) -> int:
    """The shared place nearest to the middle, or -1; the window that is looked at doubles."""
    width = PROBES
    while True:
        at = np.arange(max(low, middle - width), min(high, middle + width + 1))
        hits = at[shared(at)]
        if len(hits):
            return int(hits[np.argmin(np.abs(hits - middle))])
        if middle - width <= low and middle + width + 1 >= high:
            return -1
        width *= 2


class _Aligned:
    """Alignment of the texts of a slice: per text the sizes and the digest, and its different links with their number."""

    def __init__(self, texts: list[str | None], a: ByteTokenizer, b: PieceTokenizer, marked: _Table) -> None:
        n = len(texts)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, np.int64) for _ in range(4))
        self.digests = [""] * n
        self.sizes = np.zeros(n, np.int64)
        self.codes, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        given = [i for i, t in enumerate(texts) if t]
        chosen = [texts[i] for i in given]
        pairs = zip(given, a(chosen), b(chosen))
        whole = [(i, x, y) for i, x, y in pairs if self._spells(a, x, texts[i]) and self._spells(b, y, texts[i])]
        if whole:
            self._align(whole, a, b, marked)

    @staticmethod
    def _spells(tokenizer, ids: np.ndarray, text: str) -> bool:
        return tokenizer.table.spell(ids)[0].tobytes() == (" " + text).encode()

    def _align(self, whole: list, a: ByteTokenizer, b: PieceTokenizer, marked: _Table) -> None:
        rows = np.array([i for i, _, _ in whole])
        ids_a, ids_b = (np.concatenate([w[k] for w in whole]) for k in (1, 2))
        until_a, until_b = (np.cumsum([len(w[k]) for w in whole]) for k in (1, 2))
        ends_a, ends_b = np.cumsum(a.table.lengths[ids_a]), np.cumsum(b.table.lengths[ids_b])
        cuts = common_cuts(ends_a, ends_b)
        # groups: tokens from_a to to_a - 1 and from_b to to_b - 1
        to_a, to_b = cuts + 1, np.searchsorted(ends_b, ends_a[cuts]) + 1
        from_a, from_b = np.concatenate([[0], to_a[:-1]]), np.concatenate([[0], to_b[:-1]])
        of_a, of_b = to_a - from_a, to_b - from_b
        doc = np.searchsorted(until_a, from_a, "right")
        self.n_a[rows], self.n_b[rows] = np.diff(until_a, prepend=0), np.diff(until_b, prepend=0)
        self.n_groups[rows] = np.bincount(doc, minlength=len(rows))

        group_a, group_b = np.repeat(np.arange(len(cuts)), of_a), np.repeat(np.arange(len(cuts)), of_b)
        written = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_a, last_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
        last_a[to_a - 1] = last_b[to_b - 1] = 1
        written[np.arange(len(ids_a)) + from_b[group_a]] = ids_a + last_a * a.size
        written[np.arange(len(ids_b)) + to_a[group_b]] = ids_b + last_b * b.size + 2 * a.size
        spelled, ends = marked.spell(written)
        until = ends[until_a + until_b - 1]
        for k, (begin, end) in enumerate(zip(np.concatenate([[0], until[:-1]]), until)):
            self.digests[rows[k]] = hashlib.sha256(spelled[begin : end - 1]).hexdigest()

        pairs = a.size * b.size
        wide = of_a * of_b > WIDE_GROUP
        narrow = ~wide[group_a]
        times_b = of_b[group_a[narrow]]
        first = np.repeat(from_b[group_a[narrow]] - (np.cumsum(times_b) - times_b), times_b)
        partner = ids_b[np.arange(len(first)) + first]
        keys = np.repeat(doc[group_a[narrow]] * pairs + ids_a[narrow] * b.size, times_b) + partner
        keys, times = _counts(keys)
        for g in np.flatnonzero(wide).tolist():
            some, n_some = _counts(ids_a[from_a[g] : to_a[g]])
            others, n_others = _counts(ids_b[from_b[g] : to_b[g]])
            keys = np.concatenate([keys, (doc[g] * pairs + some[:, None] * b.size + others[None, :]).ravel()])
            times = np.concatenate([times, (n_some[:, None] * n_others[None, :]).ravel()])
        if wide.any():
            keys, at = np.unique(keys, return_inverse=True)
            summed = np.zeros(len(keys), np.int64)
            np.add.at(summed, at, times)
            times = summed
        owner = keys // pairs
        self.sizes[rows] = np.bincount(owner, minlength=len(rows))
        np.add.at(self.n_links, rows[owner], times)
        self.codes, self.times = keys - owner * pairs, times


def _counts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(values, return_counts=True)


class _Chunk:
    """Aligned texts of a chunk with the row they belong to."""

    def __init__(self) -> None:
        self.rows: list[pa.Array] = []
        self.slices: list[_Aligned] = []
        self.bytes = 0

    def add(self, rows: pa.Array, aligned: _Aligned, size: int) -> None:
        self.rows.append(rows)
        self.slices.append(aligned)
        self.bytes += size

    def batch(self, key: int) -> pa.RecordBatch:
        """One row: the chunk's documents, its different pairs with their documents, and the places of each document's pairs."""
        joined = {f: np.concatenate([getattr(s, f) for s in self.slices]) for f in ("n_a", "n_b", "n_groups", "n_links", "sizes", "codes", "times")}
        codes, at, n_docs = np.unique(joined["codes"], return_inverse=True, return_counts=True)
        steps = np.diff(at, prepend=0).astype(np.int32)
        packed = [pa.compress(x.astype(np.int32 if x.max(initial=0) < 1 << 31 else np.int64).tobytes(), "zstd", asbytes=True) for x in (steps, joined["times"])]
        digests = pa.array([d for s in self.slices for d in s.digests], pa.string())
        fields = {"row": pa.concat_arrays(self.rows)} | {f: pa.array(joined[f]) for f in ("n_a", "n_b", "n_groups", "n_links", "sizes")} | {"groups_sha256": digests}
        docs = pa.StructArray.from_arrays(list(fields.values()), list(fields))
        listed = lambda values: pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)
        columns = {
            "chunk": pa.array([key]), "docs": listed(docs), "codes": listed(pa.array(codes)), "n_docs": listed(pa.array(n_docs)),
            "steps": pa.array([packed[0]], pa.binary()), "times": pa.array([packed[1]], pa.binary()), "wide": pa.array([bool(joined["times"].max(initial=0) >= 1 << 31)]),
        }
        return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def align(docs: DataFrame, text: str = "text", keep: Sequence[str] | None = None, a_file: str = A_FILE, b_file: str = B_FILE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(row, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256): the columns ``keep`` (all by default) as a struct with the alignment.

    A pair's count is the number of documents that hold it linked; ``n_best`` are the links whose count is the highest of
    their A token, ``count_sum`` sums the counts of all links.
    """
    context = docs.sparkSession.sparkContext
    files = []
    for name in (a_file, b_file):
        with open(name, "rb") as f:
            files.append(f.read())
    shared = context.broadcast(tuple(files))
    size_b = PieceTokenizer(files[1]).size

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tools = _tokenizers(*shared.value)
        first = TaskContext.get().partitionId() << 32
        held, done = _Chunk(), 0
        for batch in batches:
            texts = batch.column("text").to_pylist()
            begin = size = 0
            for i, t in enumerate(texts):
                size += len(t or "")
                if size >= SLICE_BYTES or i + 1 == len(texts):
                    held.add(batch.column("row").slice(begin, i + 1 - begin), _Aligned(texts[begin : i + 1], *tools), size)
                    begin, size = i + 1, 0
                    if held.bytes >= chunk_bytes:
                        yield held.batch(first + done)
                        held, done = _Chunk(), done + 1
        if held.rows:
            yield held.batch(first + done)

    kept = F.struct("*") if keep is None else F.struct(*[f"`{c}`" for c in keep])
    chosen = docs.select(kept.alias("row"), F.col(f"`{text}`").cast("string").alias("text"))
    per_doc = chosen.select(F.struct("row", *[F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "sizes")], F.lit("").alias("groups_sha256")).alias("docs"))
    # chunks are kept: what follows must see one and the same division of the documents
    table = cut_lineage(chosen.mapInArrow(chunks, f"chunk long, docs array<{per_doc.schema['docs'].dataType.simpleString()}>, codes array<long>, n_docs array<long>, steps binary, times binary, wide boolean"))

    held = table.select("chunk", F.posexplode(F.arrays_zip("codes", "n_docs")).alias("place", "pair")).select("chunk", "place", "pair.codes", "pair.n_docs")
    total = held.groupBy("codes").agg(F.sum("n_docs").alias("n"))
    of_token = W.partitionBy(F.expr(f"codes div {size_b}"))  # at most as many rows as B has tokens
    total = total.select("codes", (F.col("n") * 2 + (F.col("n") == F.max("n").over(of_token)).cast("long")).alias("count"))
    back = held.select("chunk", "place", "codes").join(total, "codes").groupBy("chunk").agg(F.array_sort(F.collect_list(F.struct("place", "count")))["count"].alias("counts"))
    joined = table.select("chunk", "docs", "steps", "times", "wide").join(back, "chunk", "left")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                found = batch.column("docs").slice(k, 1).flatten()
                fields = {f: found.field(f) for f in ("row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")}
                sizes = found.field("sizes").to_numpy()
                n = int(sizes.sum())
                listed = [_unpack(batch.column(c)[k], n, np.int64 if c == "times" and batch.column("wide")[k].as_py() else np.int32) for c in ("steps", "times")]
                counts = batch.column("counts").slice(k, 1).flatten().to_numpy()[np.cumsum(listed[0])] if n else np.zeros(0, np.int64)
                times = listed[1].astype(np.int64)
                owner = np.repeat(np.arange(len(sizes)), sizes)
                best, summed = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                np.add.at(best, owner, times * (counts & 1))
                np.add.at(summed, owner, times * (counts >> 1))
                fields |= {"n_best": pa.array(best), "count_sum": pa.array(summed)}
                yield pa.RecordBatch.from_arrays([fields[f] for f in _RESULT], names=_RESULT)

    schema = per_doc.select("docs.*").select("row", "n_a", "n_b", "n_groups", "n_links", F.col("n_a").alias("n_best"), F.col("n_a").alias("count_sum"), "groups_sha256").schema
    return joined.mapInArrow(score, schema)


_RESULT = ["row", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _unpack(packed: pa.Scalar, n: int, kind: type) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(packed.as_buffer(), size, "zstd"), kind) if n else np.zeros(0, kind)
