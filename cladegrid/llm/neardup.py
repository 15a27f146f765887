"""Near-duplicate documents by SetSketch registers: banded candidates, joint likelihood estimates, exact checks.

A document's set holds the codes of its distinct shingles of ``WIDTH`` words. A register keeps an exponentially spaced,
truncated minimum: floor(1 - log_b h) for the least exponential value h over the set. Registers of a union are the
larger of two, and equal registers tell of similar sets.

1. Sketch every text; documents with equal sets form a class and only classes go on, so copies are never paired.
2. Classes with equal registers in a band share a bucket. A bucket is judged in pieces of bounded size; the joint
   likelihood of the registers of two classes, whose set sizes are known, drops pairs that cannot reach the threshold
   except with negligible probability. Of the others a spanning forest is emitted.
3. Components of these forests are families. All pairs inside a family, again in pieces, are confirmed on full sets; a
   spanning forest of the confirmed links is emitted, and its components are the result.

Neither step emits the pairs of a group. A pair at the threshold shares no bucket with probability
(1 - 0.85 ** 5) ** 30 = 2e-8, at similarity 0.8 7e-6. Shingles are compared by 64-bit codes.

Defined cases: texts without words have an empty set and are linked with nothing; a text of fewer than ``WIDTH`` words
is one shingle; repeated rows have equal sets; a null id takes no part (component null); other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladegrid.llm import words
from cladegrid.llm.components import components
from cladegrid.session import cut_lineage

WIDTH = 5
BANDS, BAND = 30, 5
REGISTERS = BANDS * BAND
# Base and rate of the sketch; registers then fit a byte for sets of one to over 10 ** 9 elements.
BASE, RATE, TOP = 1.12, 20.0, 254
# Pieces of buckets and families: rows, and shingles of families.
PIECE_ROWS, PIECE_SHINGLES = 256, 1_000_000
# Up to so many digests of 16 bytes are sent to all tasks to take rows out; beyond, rows and digests are joined by shuffle.
SENT_DIGESTS = 200_000
# A pair is dropped if its likelihood at the threshold is e ** -DOUBT of the best one.
DOUBT = 20.0

_DRAWS = np.random.Generator(np.random.PCG64(77)).integers(0, 1 << 32, (2, REGISTERS), dtype=np.uint64)
_SCALE, _SHIFT = (_DRAWS[0] | 1).astype(np.uint32), _DRAWS[1].astype(np.uint32)


def shingle_sets(found: words.Words, width: int = WIDTH) -> Iterator[np.ndarray]:
    """The sorted distinct shingle codes of each row."""
    codes = words.window_codes(found.codes, width)
    for a, b in zip(found.bounds[:-1].tolist(), found.bounds[1:].tolist()):
        if b - a >= width:
            yield np.unique(codes[a : b - width + 1])
        else:
            yield words.window_codes(found.codes[a:b], b - a) if b > a else codes[:0]


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """One row of byte registers for each non-empty set."""
    starts = np.cumsum([0, *map(len, sets)])[:-1]
    elements = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    least = np.empty((len(sets), REGISTERS), np.uint32)
    for i in range(REGISTERS):
        drawn = elements * _SCALE[i] + _SHIFT[i]
        drawn ^= drawn >> np.uint32(15)
        least[:, i] = np.minimum.reduceat(drawn, starts)
    exponential = -np.log1p(-(least + 0.5) / 2.0**32) / RATE
    return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, TOP + 1).astype(np.uint8)


def _digest(codes: np.ndarray) -> int:
    """A 64-bit code of a set, as a signed number."""
    return int(words.mix(np.array([np.add.reduce(words.mix(codes, 99)) if len(codes) else 0], np.uint64), len(codes)).view(np.int64)[0])


def sketch(docs: DataFrame, text: str = "text", key: str = "doc_id", width: int = WIDTH) -> DataFrame:
    """(id, n, code, registers, bands) of every text: set size, set code, registers and band keys (null if empty)."""
    bands = np.arange(BANDS, dtype=np.uint64)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, codes, regs, keys = [], [], [], []
            for found in words.word_slices(batch.column("text"), words.NON_BLANK, lower=True):
                sets = list(shingle_sets(found, width))
                full = [s for s in sets if len(s)]
                rows = registers(full) if full else np.zeros((0, REGISTERS), np.uint8)
                banded = np.zeros((len(rows), BANDS, 8), np.uint8)
                banded[:, :, :BAND] = rows.reshape(len(rows), BANDS, BAND)
                banded = words.mix(words.mix(banded.view(np.uint64)[:, :, 0]) + bands, 5).view(np.int64)
                at = iter(range(len(full)))
                for s in sets:
                    i = next(at) if len(s) else None
                    n.append(len(s))
                    codes.append(_digest(s))
                    regs.append(None if i is None else rows[i].tobytes())
                    keys.append(None if i is None else banded[i])
            arrays = [batch.column("id"), pa.array(n, pa.int64()), pa.array(codes, pa.int64()), pa.array(regs, pa.binary()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "code", "registers", "bands"])
        words.give_back()

    chosen = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    fields = chosen.select("id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("code"), *[F.lit(None).cast(t).alias(c) for c, t in (("registers", "binary"), ("bands", "array<long>"))])
    return chosen.mapInArrow(scan, fields.schema)


_GRID = np.concatenate([np.linspace(0.02, 0.78, 39), np.linspace(0.8, 1.0, 41)])


def plausible(equal: np.ndarray, above: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    """Whether sets of sizes n and m with so many equal and larger registers can have a similarity of ``least``.

    The likelihood of a similarity j has the chances p(u - v j) and p(v - u j) of a larger and of a smaller register,
    for u = n / (n + m), v = m / (n + m) and p(x) = -log_b(1 - x (b - 1) / b).
    """
    below = REGISTERS - equal - above
    u = (n / (n + m))[:, None]
    v = 1 - u
    j = np.minimum(_GRID[None, :], np.minimum(u / v, v / u))
    chance = lambda x: -np.log1p(-np.clip(x, 1e-9, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, fewer = chance(u - v * j), chance(v - u * j)
    same = np.clip(1 - more - fewer, 1e-9, 1)
    likely = above[:, None] * np.log(more) + below[:, None] * np.log(fewer) + equal[:, None] * np.log(same)
    allowed = np.where(_GRID[None, :] >= least - 1e-9, likely, -np.inf).max(1)
    return (np.minimum(n, m) >= least * np.maximum(n, m) - 1e-9) & (allowed >= likely.max(1) - DOUBT)


class _Forest:
    """Groups of linked rows; ``stars`` hangs each on its row with the least node, which bands of one family share."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def root(self, a: int) -> int:
        while self.up[a] != a:
            self.up[a] = a = self.up[self.up[a]]
        return a

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.root(a), self.root(b)
            self.up[max(x, y)] = min(x, y)

    def stars(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(node, least node of its group) of every row that is not the least itself."""
        roots = np.array([self.root(a) for a in range(len(self.up))], int)
        least = np.full(len(self.up), np.iinfo(np.int64).max)
        np.minimum.at(least, roots, nodes)
        hung = nodes != least[roots]
        return nodes[hung], least[roots[hung]]


def _in_pieces(rows: DataFrame, group: str, node: str, pieces: str) -> DataFrame:
    """Rows with the keys (group, i, j) of all pairs of a group's ``pieces`` that the row's own piece belongs to."""
    own = F.pmod(F.xxhash64(node), F.col(pieces)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(pieces).cast("int") - 1))
    rows = rows.withColumn("piece", own).withColumn("other", other)
    return rows.withColumn("i", F.least("piece", "other")).withColumn("j", F.greatest("piece", "other")).drop("other")


def _pairs(piece: np.ndarray, i: int, j: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the two sides of a piece pair; equal for a piece with itself."""
    return np.flatnonzero(piece == i), np.flatnonzero(piece == j)


def _edges(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a = np.concatenate([f[0] for f in found]) if found else np.zeros(0, np.int64)
    b = np.concatenate([f[1] for f in found]) if found else np.zeros(0, np.int64)
    return pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def _judge_buckets(least: float):
    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in words.key_runs(batches, ["band", "i", "j"]):
            nodes, n = table.column("code").to_numpy(), table.column("n").to_numpy().astype(float)
            rows = np.frombuffer(b"".join(table.column("registers").to_pylist()), np.uint8).reshape(-1, REGISTERS)
            piece, i, j = (table.column(c).to_numpy() for c in ("piece", "i", "j"))
            sizes, found = np.diff(bounds), []
            for size in np.unique(sizes[sizes <= 4]).tolist():  # many small buckets at once
                at = bounds[:-1][sizes == size]
                for x in range(size):
                    for y in range(x):
                        a, b = at + x, at + y
                        ok = (i[a] == j[a]) | (piece[a] != piece[b])
                        a, b = a[ok], b[ok]
                        ok = _close(rows[a], rows[b], n[a], n[b], least)
                        found.append((nodes[a[ok]], nodes[b[ok]]))
            for start, end in zip(bounds[:-1][sizes > 4], bounds[1:][sizes > 4]):
                left, right = _pairs(piece[start:end], i[start], j[start])
                forest = _Forest(end - start)
                for k in left.tolist():
                    others = right[right < k] if i[start] == j[start] else right
                    # in a spanning forest a pair that is joined already needs no estimate
                    others = np.array([o for o in others.tolist() if forest.root(o) != forest.root(k)], int)
                    if len(others):
                        a = np.full(len(others), k)
                        ok = _close(rows[start + a], rows[start + others], n[start + a], n[start + others], least)
                        forest.add(np.column_stack([a[ok], others[ok]]))
                found.append(forest.stars(nodes[start:end]))
            yield _edges(found)

    return judge


def _close(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: float) -> np.ndarray:
    out = np.zeros(len(x), bool)
    equal = (x == y).sum(1)
    worth = np.flatnonzero((equal >= REGISTERS * (least - 0.32)) & (np.minimum(n, m) >= least * np.maximum(n, m) - 1e-9))
    if len(worth):
        out[worth] = plausible(equal[worth], (x[worth] > y[worth]).sum(1), n[worth], m[worth], least)
    return out


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set on the left with every set on the right."""
    out = np.zeros((len(left), len(right)), np.float32)
    codes, inverse = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    rows = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    cut = sum(map(len, left))
    shared = (np.bincount(inverse[:cut], minlength=len(codes)) > 0) & (np.bincount(inverse[cut:], minlength=len(codes)) > 0)
    number = np.cumsum(shared) - 1
    keep = shared[inverse]
    rows, columns = rows[keep], number[inverse[keep]]
    width = 4096
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    for start in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(columns, [start, start + width])
        dense = np.zeros((len(left) + len(right), min(width, int(shared.sum()) - start)), np.float32)
        dense[rows[a:b], columns[a:b] - start] = 1
        out += dense[: len(left)] @ dense[len(left) :].T
    return out


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in words.key_runs(batches, ["family", "i", "j"]):
            nodes = table.column("code").to_numpy()
            piece, i, j = (table.column(c).to_numpy() for c in ("piece", "i", "j"))
            raw = table.column("codes")
            found = []
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                if end - start < 2:
                    continue
                sets = [np.frombuffer(raw[k].as_py(), np.uint64) for k in range(start, end)]
                left, right = _pairs(piece[start:end], i[start], j[start])
                if not len(left) or not len(right):
                    continue
                inter = _overlaps([sets[k] for k in left], [sets[k] for k in right]).astype(np.int64)
                sizes = np.array([len(s) for s in sets])
                union = sizes[left][:, None] + sizes[right][None, :] - inter
                a, b = np.nonzero(100 * inter >= percent * union)
                linked = np.column_stack([left[a], right[b]])
                forest = _Forest(end - start)
                forest.add(linked[linked[:, 0] != linked[:, 1]])
                found.append(forest.stars(nodes[start:end]))
            yield _edges(found)
        words.give_back()

    return confirm


def _full_sets(docs: DataFrame, members: DataFrame, text: str, key: str, width: int) -> DataFrame:
    """(family, code, pieces, codes): the full shingle set of one document of each class in ``members``."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [s for found in words.word_slices(batch.column("text"), words.NON_BLANK, lower=True) for s in shingle_sets(found, width)]
            right = np.array([_digest(s) for s in codes], np.int64) == batch.column("code").to_numpy()
            arrays = [batch.column("family"), batch.column("code"), batch.column("pieces"), pa.array([s.tobytes() for s in codes], pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["family", "code", "pieces", "codes"]).filter(pa.array(right))
        words.give_back()

    chosen = docs.select(F.col(f"`{key}`").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    joined = members.join(chosen, members["least_id"] == chosen["id"]).select("family", "code", "pieces", "text")
    return joined.mapInArrow(sets, "family long, code long, pieces long, codes binary")


def near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 85, width: int = WIDTH) -> DataFrame:
    """(id, n_shingles, component_id) per row: the smallest id reachable over links of ``percent`` similarity."""
    sketches = cut_lineage(sketch(docs, text, key, width))
    classes = cut_lineage(sketches.where("n > 0 and id is not null").groupBy("code").agg(F.min("id").alias("least_id"), F.first("n").alias("n"), F.first("registers").alias("registers"), F.first("bands").alias("bands")))

    banded = classes.select("code", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("size")).where("size > 1")
    shared = shared.withColumn("pieces", F.ceil(F.col("size") / PIECE_ROWS))
    bucketed = banded.join(shared, "band").join(classes.select("code", "n", "registers"), "code")
    bucketed = _in_pieces(bucketed, "band", "code", "pieces").select("band", "i", "j", "piece", "code", "n", "registers")
    judged = bucketed.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j").mapInArrow(_judge_buckets(percent / 100), "a long, b long")
    families = components(judged)

    members = classes.select("code", "least_id", "n").join(families.select(F.col("node").alias("code"), F.col("root").alias("family")), "code")
    stats = members.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / PIECE_ROWS), F.ceil(F.sum("n") / PIECE_SHINGLES)).alias("pieces"))
    members = cut_lineage(members.join(stats, "family"))
    full = _in_pieces(_full_sets(docs, members, text, key, width), "family", "code", "pieces").select("family", "i", "j", "piece", "code", "codes")
    confirmed = full.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(_confirm(percent), "a long, b long")
    linked = components(confirmed)

    roots = classes.select("code", "least_id").join(linked.select(F.col("node").alias("code"), "root"), "code")
    least = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = classes.select("code", "least_id").join(roots.join(least, "root").select("code", "component_id"), "code", "left")
    of_class = of_class.select("code", F.coalesce("component_id", "least_id").alias("component_id"))
    named = sketches.select("id", "n", "code").join(of_class, "code", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id"))
    return named.select("id", F.col("n").alias("n_shingles"), F.when(F.col("id").isNotNull(), component).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id", percent: int = 80, width: int = WIDTH) -> DataFrame:
    """The columns of ``docs``; of each component one row: that with the smallest id, null last.

    Rows are told apart by a digest of id and text, so ids may repeat or be null; of equal rows one stays. Rows without
    words are linked with nothing and all stay.
    """
    own, content = F.col(f"`{key}`"), F.col(f"`{text}`").cast("string")
    digest = F.unhex(F.md5(F.concat(F.coalesce(own.cast("string"), F.lit("null")), F.lit(":"), content).cast("binary")))
    worded = content.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.select(F.struct("*").alias("row"), own.alias("own"), content.alias("content"), digest.alias("digest")).where(worded)
    found = near_duplicates(rows.select("digest", "content"), "content", "digest", percent, width)
    # one row per digest, however often it occurs
    of_digest = found.groupBy(F.col("id").alias("digest")).agg(F.min("component_id").alias("component"))
    named = of_digest.join(rows.groupBy("digest").agg(F.min("own").alias("own"), F.count("*").alias("n")), "digest")
    first = named.groupBy("component").agg(F.min(F.struct(F.col("own").isNull(), "own", "digest"))["digest"].alias("stays"))
    # most rows stay and occur once: only the others are looked up, and only repeated ones compared
    others = named.join(first, named["digest"] == first["stays"], "left").where("stays is null or n > 1")
    others = cut_lineage(others.select("digest", F.col("stays").isNotNull().alias("repeated")))
    sent = F.broadcast if others.count() <= SENT_DIGESTS else (lambda df: df)
    texts = rows.select("row", "digest")
    once = texts.join(sent(others.select("digest")), "digest", "left_anti")
    repeated = texts.join(sent(others.where("repeated").select("digest")), "digest", "left_semi").dropDuplicates(["digest"])
    kept = once.unionByName(repeated).select("row.*")
    return kept.unionByName(docs.where(~F.coalesce(worded, F.lit(False))))
