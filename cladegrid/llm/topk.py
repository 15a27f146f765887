"""Exact top-k inner products by a pivot-distance index.

Vectors of integers x get one more component, sqrt(M - |x|^2) with M the largest square; queries get 0. A larger inner
product then is a smaller distance, and triangle inequalities hold. The index keys every vector by its nearest pivot
and its distance to it, cut into rings. Rings of one pivot with few vectors are joined to an annulus, annuli with many
are cut into pieces by a hash. A query first takes the annulus with the least lower bound that holds more than k
vectors; its k-th score there bounds the rest: vectors whose lower bound lies beyond it are never scored.

Queries that start in the same annuli make a block, and neighbouring pieces a bundle, each of at most 8 MB of
vectors. A block or piece is one row of packed vectors. Blocks are sent to the bundles, and pieces to the blocks, that
open each other, a few copies by each task, so a task holds one block and one bundle whatever the size of the tables, and no query is repeated for
an annulus. Inside, bounds are those of 2,048 vectors next in distance, and only the k best of a query are kept.

Pivots are a bounded sample (``PIVOTS`` vectors, by hash) and rings per pivot are at most ``RINGS``, so the bounds that
are collected and sent have a fixed size; every vector is indexed. All pruning is exact, so the recall is 1. Of equal
vectors, those of the k + 1 least ids can be results, and k rows of an id; others are not packed.

Defined cases: null vectors, or with null or non-finite components, or null ids take no part; shorter vectors are
filled with zeros; a query leaves out the rows of its own id; repeated rows are repeated candidates, and one query (the least vector of its id); queries with fewer
candidates return them all; an empty table gives an empty one. Scores are summed in the narrowest type that holds them
exactly; where they may not fit a long, the search fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cladegrid.session import cut_lineage

PIVOTS, RINGS = 64, 32
MOST_TASKS = 8192
# Copies of a block that one task writes.
COPIES = 8
# Distances are floating-point; bounds are widened by this share of the lengths.
SLACK = 1e-5

# No score, and an id after all others.
NONE, LAST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
TYPES = {"tinyint": np.int8, "smallint": np.int16, "int": np.int32, "bigint": np.int64}


class Index(NamedTuple):
    rows: DataFrame | None  # id, vector, pivot, ring, distance; not sent to tasks
    pivots: np.ndarray
    rings: pd.DataFrame  # pivot, ring, n, least, most
    square: float
    size: int


class Sizes(NamedTuple):
    """How much a task holds."""

    ring: int = 2048  # vectors with bounds of their own inside a piece
    strip: int = 512  # queries that are scored at once
    piece: tuple[int, int] = (2048, 131072)  # fewest vectors to aim at, and most
    block: tuple[int, int] = (1024, 65536)  # of queries, likewise
    first: int = 8192  # queries that meet the annulus where they start at once
    bundles: int = 64  # copies of the queries, and of the vectors, to aim at while both are few: their product are the tasks
    blocks: int = 4
    blob: int = 8 << 20  # bytes of the vectors of a piece or block
    waiting: int = 1 << 20  # scored rows that wait until the best are chosen among them


class Annuli(NamedTuple):
    """Neighbouring rings of a pivot; those with many vectors have several pieces, each in a bundle of its own."""

    pivot: np.ndarray
    n: np.ndarray
    least: np.ndarray
    most: np.ndarray
    piece: np.ndarray
    parts: np.ndarray
    bundle: np.ndarray


def whole_vectors(rows: DataFrame, key: str, vector: str, scaled: float = 64.0) -> DataFrame:
    """(id, vector): components floor(scaled * x) as longs, of vectors without null or non-finite components."""
    chosen = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return chosen.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).select("id", F.transform("vector", lambda x: F.floor(x * scaled).cast("long")).alias("vector"))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    """Vectors as rows of integers, filled up with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == size).all():
        return flat.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size), flat.dtype)
    at = np.concatenate([[0], np.cumsum(lengths)])
    for i in range(len(lengths)):
        own = flat[at[i] : at[i + 1]][:size]
        out[i, : len(own)] = own
    return out


def _squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def _raised(x: np.ndarray, square: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(square - _squares(x), 0))])


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Of rows, raised or with one component less (queries), to raised pivots."""
    return np.sqrt(np.maximum(_squares(x)[:, None] + _squares(pivots)[None, :] - 2 * (x @ pivots[:, : x.shape[1]].T), 0))


def _strips(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _narrowed(vectors: DataFrame, bound: int) -> DataFrame:
    """Components in the shortest type for -bound - 1 to bound."""
    kind = next(t for t, n in TYPES.items() if bound <= np.iinfo(n).max)
    return vectors.select("id", F.col("vector").cast(f"array<{kind}>").alias("vector"))


def _element(rows: DataFrame) -> str:
    return rows.schema["vector"].dataType.elementType.simpleString()


def build_index(vectors: DataFrame, pivots: int = PIVOTS, rings: int = RINGS) -> Index:
    """Index every row of vectors (id, vector)."""
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    bound = F.aggregate("vector", F.lit(0).cast("long"), lambda s, x: F.greatest(s, x, F.bitwise_not(x)))
    size, most, largest = vectors.agg(F.max(F.size("vector")), F.max(square), F.max(bound)).first()
    size, most = size or 0, most or 0.0
    vectors = _narrowed(vectors, largest or 0)
    sample = vectors.select("vector", F.xxhash64("vector").alias("h")).distinct().orderBy("h").limit(pivots).collect()
    chosen = np.zeros((len(sample), size))
    for i, r in enumerate(sample):
        chosen[i, : len(r["vector"])] = r["vector"]
    chosen = _raised(chosen, most)
    width = 2 * np.sqrt(most) / rings + 1e-9

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _strips(batches, Sizes().ring):
            d = _distances(_raised(_matrix(batch.column("vector"), size).astype(float), most), chosen)
            pivot = d.argmin(1)
            near = d[np.arange(len(d)), pivot]
            ring = np.minimum(near // width, rings - 1).astype(np.int32)
            arrays = [batch.column("id"), batch.column("vector"), pa.array(pivot.astype(np.int32)), pa.array(ring), pa.array(near)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "vector", "pivot", "ring", "distance"])

    if not sample:
        empty = vectors.select("id", "vector", F.lit(0).alias("pivot"), F.lit(0).alias("ring"), F.lit(0.0).alias("distance"))
        return Index(empty, chosen, pd.DataFrame({"pivot": [], "ring": [], "n": [], "least": [], "most": []}), most, size)
    rows = cut_lineage(vectors.mapInArrow(assign, f"id long, vector array<{_element(vectors)}>, pivot int, ring int, distance double"))
    found = rows.groupBy("pivot", "ring").agg(F.count("*").alias("n"), F.min("distance").alias("least"), F.max("distance").alias("most")).collect()
    return Index(rows, chosen, pd.DataFrame([r.asDict() for r in sorted(found)]), most, size)


def _laid(counts: list[int], most: int, starts: frozenset[int] = frozenset()) -> list[tuple[int, int]]:
    """(number, parts) for consecutive counts: small neighbours share a number, large ones take several. starts: no sharing with the one before."""
    out: list[tuple[int, int]] = []
    number, following, filled = 0, 0, 0
    for i, n in enumerate(counts):
        if not out or i in starts or filled + n > most:
            number, filled = following, 0
            following += max(1, -(-n // most))
        filled += n
        out.append((number, following - number))
    return out


def _within(count: int, copies: int, bounds: tuple[int, int], blob: int, size: int, element: str) -> int:
    """Vectors of a piece or block."""
    wanted = min(max(-(-count // copies), bounds[0]), bounds[1])
    return max(1, min(wanted, blob // (max(size, 1) * np.dtype(TYPES[element]).itemsize)))


def _annuli(index: Index, rows: int) -> tuple[Annuli, list[tuple[int, int, int, int]]]:
    """Annuli for pieces of so many rows, and (pivot, ring, piece, parts) of each ring."""
    rings = list(index.rings.itertuples(index=False))
    starts = frozenset(i for i, r in enumerate(rings) if i and r.pivot != rings[i - 1].pivot)
    laid = _laid([int(r.n) for r in rings], rows, starts)
    joined = index.rings.assign(piece=[p for p, _ in laid], parts=[n for _, n in laid]).groupby("piece", sort=True)
    joined = joined.agg(pivot=("pivot", "first"), n=("n", "sum"), least=("least", "min"), most=("most", "max"), parts=("parts", "first")).reset_index()
    bundle = np.array([b for b, _ in _laid(joined["n"].tolist(), rows)])
    columns = [joined[c].to_numpy() for c in ("pivot", "n", "least", "most", "piece", "parts")]
    return Annuli(*columns, bundle), [(int(r.pivot), int(r.ring), p, n) for r, (p, n) in zip(rings, laid)]


def _lower(to: np.ndarray, least: float | np.ndarray, most: float | np.ndarray) -> np.ndarray:
    """Least distance of queries, at these distances from a pivot, to vectors between two distances from it."""
    return np.maximum(np.maximum(to - most, least - to), 0)


def _reach(squares: np.ndarray, floor: np.ndarray, square: float) -> np.ndarray:
    """The largest distance at which a vector reaches the score floor."""
    return np.sqrt(np.maximum(squares + square - 2 * floor.astype(float), 0)) + SLACK * np.sqrt(squares + square)


def _candidates(rows: DataFrame, k: int) -> DataFrame:
    """Without copies of a vector that can be no result, as k others with smaller ids are taken first by any query."""
    rows = rows.withColumn("at", F.dense_rank().over(W.partitionBy("vector").orderBy("id"))).where(F.col("at") <= k + 1)
    return rows.withColumn("at", F.row_number().over(W.partitionBy("vector", "id").orderBy("distance"))).where(F.col("at") <= k).drop("at")


def _pack_pieces(annuli: Annuli, size: int, ring: int):
    """A piece's vectors, nearest to the pivot first, with the distances of each ring of them."""

    def pack(rows: pa.Table) -> pa.Table:
        piece = rows.column("piece")[0].as_py()
        at = int(np.searchsorted(annuli.piece, piece, "right")) - 1
        distance = rows.column("distance").to_numpy()
        order = np.argsort(distance, kind="stable")
        ids, vectors, distance = rows.column("id").to_numpy()[order], _matrix(rows.column("vector"), size)[order], distance[order]
        first = np.arange(0, len(order), ring)
        last = np.minimum(first + ring, len(order)) - 1
        bundle = int(annuli.bundle[at]) + piece - int(annuli.piece[at])
        return pa.table(
            {
                "piece": pa.array([piece], pa.int32()),
                "bundle": pa.array([bundle], pa.int32()),
                "pivot": pa.array([int(annuli.pivot[at])], pa.int32()),
                "least": pa.array([distance[first].tolist()], pa.list_(pa.float64())),
                "most": pa.array([distance[last].tolist()], pa.list_(pa.float64())),
                "piece_ids": pa.array([ids.astype(np.int64).tobytes()], pa.binary()),
                "piece_vectors": pa.array([vectors.tobytes()], pa.binary()),
            }
        )

    return pack, "piece int, bundle int, pivot int, least array<double>, most array<double>, piece_ids binary, piece_vectors binary"


def _first(index: Index, annuli: Annuli, k: int, strip: int):
    """The annulus at which each query starts (-1: none holds more than k vectors), and its square."""
    many = np.flatnonzero(annuli.n > k)
    pivot, least, most = annuli.pivot[many], annuli.least[many], annuli.most[many]
    pivots, size = index.pivots, index.size

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _strips(batches, strip):
            x = _matrix(batch.column("vector"), size).astype(float)
            first = np.full(len(x), -1, np.int32)
            if len(many):
                to = _distances(x, pivots)[:, pivot]
                low = _lower(to, least, most)
                first = many[np.where(low <= low.min(1)[:, None], to, np.inf).argmin(1)].astype(np.int32)
            arrays = [batch.column("id"), batch.column("vector"), pa.array(first), pa.array(_squares(x))]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "vector", "first", "square"])

    return choose


class _Search:
    """The k best rows of some queries; floor and tie are the score and id of a k-th row that each has already."""

    def __init__(self, index: Index, sizes: Sizes, kind: type, k: int, q: np.ndarray, ids: np.ndarray, floor: np.ndarray, tie: np.ndarray):
        self.pivots, self.square, self.sizes = index.pivots, index.square, sizes
        self.kind, self.k, self.q, self.ids = kind, k, q, ids
        self.lowest = kind(-np.inf) if issubclass(kind, np.floating) else np.iinfo(kind).min
        self.floor = np.where(floor == NONE, self.lowest, floor.astype(kind))
        self.tie = tie.copy()
        self.exact = q.astype(float)
        self.squares = _squares(self.exact)
        self.found = [(np.zeros(0, np.int64),) * 3]
        self.waiting = 0

    def choose(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Query, row id and score of the best rows so far; only they are kept."""
        row, ids, score = (np.concatenate(c) for c in zip(*self.found))
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        last = rank == self.k - 1
        self.floor[row[last]], self.tie[row[last]] = score[last].astype(self.kind), ids[last]
        kept = rank < self.k
        self.found, self.waiting = [(row[kept], ids[kept], score[kept])], 0
        return self.found[0]

    def scan(self, pivot: int, least: list[float], most: list[float], ids: np.ndarray, x: np.ndarray) -> None:
        """Score a piece, except where its vectors lie beyond a query's floor."""
        to = _distances(self.exact, self.pivots[[pivot]])[:, 0]
        for i, (near, far) in enumerate(zip(least, most)):
            part = slice(i * self.sizes.ring, (i + 1) * self.sizes.ring)
            order = np.argsort(ids[part], kind="stable")
            own, rows = ids[part][order], x[part][order].astype(self.kind)
            opened = np.flatnonzero(_lower(to, near, far) <= _reach(self.squares, self.floor, self.square))
            for start in range(0, len(opened), self.sizes.strip):
                self._score(opened[start : start + self.sizes.strip], own, rows)

    def _score(self, taken: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """ids in order."""
        k, m = self.k, len(ids)
        dots = self.q[taken].astype(self.kind) @ rows.T
        asked = self.ids[taken]
        for i in np.flatnonzero(ids[np.minimum(np.searchsorted(ids, asked), m - 1)] == asked):
            dots[i, ids == asked[i]] = self.lowest
        open_ended = np.flatnonzero(self.floor[taken] == self.lowest)
        if len(open_ended) and m >= k:
            self.floor[taken[open_ended]] = np.partition(dots[open_ended], m - k, axis=1)[:, m - k]
        floor = self.floor[taken]
        i, j = np.divmod(np.flatnonzero(dots >= floor[:, None]), m)
        n = np.bincount(i, minlength=len(taken))
        if (n > 4 * k).any():  # of many equal scores, those of the least ids
            few = [(i[n[i] <= 4 * k], j[n[i] <= 4 * k])]
            for r in np.flatnonzero(n > 4 * k):
                kth = np.partition(dots[r], m - k)[m - k]
                over = np.flatnonzero(dots[r] > kth)
                best = np.concatenate([over, np.flatnonzero(dots[r] == kth)[: k - len(over)]])
                few.append((np.full(len(best), r), best))
            i, j = (np.concatenate(c) for c in zip(*few))
        score = dots[i, j]
        kept = (score > self.lowest) & ((score > floor[i]) | (ids[j] <= self.tie[taken[i]]))
        if kept.any():
            self.found.append((taken[i[kept]], ids[j[kept]], score[kept].astype(np.int64)))
            self.waiting += int(kept.sum())
            if self.waiting > self.sizes.waiting:
                self.choose()


def _pieces_of(rows: pa.Table, element: str, size: int) -> Iterator[tuple]:
    """What scan takes, piece by piece."""
    for r in range(rows.num_rows):
        pivot, least, most, ids, vectors = (rows.column(c)[r] for c in ("pivot", "least", "most", "piece_ids", "piece_vectors"))
        ids = np.frombuffer(ids.as_buffer(), np.int64)
        yield pivot.as_py(), least.as_py(), most.as_py(), ids, np.frombuffer(vectors.as_buffer(), TYPES[element]).reshape(len(ids), size)


def _bound(index: Index, sizes: Sizes, kind: type, k: int, element: str):
    """Queries with the score and id of their k-th row in the annulus at which they start."""

    def bound(queries: pa.Table, rows: pa.Table) -> pa.Table:
        n = queries.num_rows
        floor, tie = np.full(n, NONE), np.full(n, LAST)
        if n:
            search = _Search(index, sizes, kind, k, _matrix(queries.column("vector"), index.size), queries.column("id").to_numpy(), floor, tie)
            for piece in _pieces_of(rows, element, index.size):
                search.scan(*piece)
            row, ids, score = search.choose()
            last = np.flatnonzero(np.bincount(row, minlength=n) >= k)
            at = np.searchsorted(row, last) + k - 1
            floor[last], tie[last] = score[at], ids[at]
        return pa.table({"id": queries.column("id"), "vector": queries.column("vector"), "block": queries.column("block"), "floor": pa.array(floor), "tie": pa.array(tie)})

    return bound


def _pack_blocks(index: Index, annuli: Annuli):
    """A block's queries, with the pieces and bundles that any of them opens; bundles in lists of COPIES."""

    def pack(rows: pa.Table) -> pa.Table:
        x = _matrix(rows.column("vector"), index.size)
        exact, floor = x.astype(float), rows.column("floor").to_numpy()
        reach = _reach(_squares(exact), np.where(floor == NONE, -np.inf, floor.astype(float)), index.square)
        pieces, bundles = [], set()
        to, at = None, None
        for a in range(len(annuli.pivot)):
            if at != annuli.pivot[a]:
                at = annuli.pivot[a]
                to = _distances(exact, index.pivots[[at]])[:, 0]
            if (_lower(to, annuli.least[a], annuli.most[a]) <= reach).any():
                own = range(int(annuli.parts[a]))
                pieces += [int(annuli.piece[a]) + p for p in own]
                bundles |= {int(annuli.bundle[a]) + p for p in own}
        packed = {n: pa.array([rows.column(n).to_numpy().astype(np.int64).tobytes()], pa.binary()) for n in ("id", "floor", "tie")}
        listed = sorted(bundles)
        ints = pa.list_(pa.int32())
        lists = {"pieces": pa.array([pieces], ints), "bundles": pa.array([[listed[i : i + COPIES] for i in range(0, len(listed), COPIES)]], pa.list_(ints))}
        return pa.table({"block": pa.array([rows.column("block")[0].as_py()], pa.int32()), **packed, "vectors": pa.array([x.tobytes()], pa.binary()), **lists})

    return pack, "block int, id binary, floor binary, tie binary, vectors binary, pieces array<int>, bundles array<array<int>>"


def _score(index: Index, sizes: Sizes, kind: type, k: int, element: str, asked: str):
    """The k best rows of a bundle for each query of a block."""

    def score(block: pa.Table, rows: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * 3
        if block.num_rows and rows.num_rows:
            ids, floor, tie = (np.frombuffer(block.column(c)[0].as_buffer(), np.int64) for c in ("id", "floor", "tie"))
            q = np.frombuffer(block.column("vectors")[0].as_buffer(), TYPES[asked]).reshape(len(ids), index.size)
            search = _Search(index, sizes, kind, k, q, ids, floor, tie)
            for piece in _pieces_of(rows, element, index.size):
                search.scan(*piece)
            row, vec, value = search.choose()
            found = ids[row], vec, value
        return pa.table({n: pa.array(c) for n, c in zip(("query_id", "vec_id", "score"), found)})

    return score


def _summing_type(most: float) -> type:
    """The fastest type in which sums up to this are exact."""
    for kind, bits in ((np.float32, 24), (np.float64, 53), (np.int64, 63)):
        if most * (1 + SLACK) < 2.0**bits:
            return kind
    raise ValueError("inner products of these vectors may not fit a long")


def search(index: Index, queries: DataFrame, k: int = 20, sizes: Sizes = Sizes()) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows for each query (id, vector)."""
    if not len(index.rings):
        return queries.select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"), F.col("id").alias("score")).limit(0)
    spark, element, asked_as = queries.sparkSession, _element(index.rows), _element(queries)
    sent = index._replace(rows=None)
    annuli, rings = _annuli(index, _within(int(index.rings["n"].sum()), sizes.bundles, sizes.piece, sizes.blob, index.size, element))
    of_ring = spark.createDataFrame(rings, "pivot int, ring int, piece int, parts int")
    piece = F.col("piece") + F.pmod(F.xxhash64("id", "vector"), F.col("parts")).cast("int")
    rows = _candidates(index.rows, k).join(F.broadcast(of_ring), ["pivot", "ring"]).select("id", "vector", "distance", piece.alias("piece"))
    pieces = cut_lineage(rows.groupBy("piece").applyInArrow(*_pack_pieces(annuli, index.size, sizes.ring)))

    queries = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    asked = cut_lineage(queries.mapInArrow(_first(index, annuli, k, sizes.strip), f"id long, vector array<{asked_as}>, first int, square double"))
    starts = sorted(asked.groupBy("first").agg(F.count("*").alias("n"), F.max("square").alias("square")).collect())
    kind = _summing_type(np.sqrt(max([0.0, *(r["square"] for r in starts)])) * np.sqrt(index.square))
    blocks = _laid([r["n"] for r in starts], _within(sum(r["n"] for r in starts), sizes.blocks, sizes.block, sizes.blob, index.size, asked_as))
    slices = [-(-r["n"] // sizes.first) for r in starts]
    places = [(r["first"], int(annuli.piece[r["first"]]) if r["first"] >= 0 else -1, *laid, n) for r, laid, n in zip(starts, blocks, slices)]
    places = spark.createDataFrame(places, "first int, piece int, block int, parts int, slices int")
    dealt = lambda n, seed: F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
    start = asked.join(F.broadcast(places), "first").select("id", "vector", "piece", (F.col("block") + dealt("parts", 0)).alias("block"), dealt("slices", 1).alias("slice"))
    met = pieces.join(F.broadcast(places.select("piece", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice"))), "piece")
    bounded = start.groupBy("piece", "slice").cogroup(met.groupBy("piece", "slice")).applyInArrow(_bound(sent, sizes, kind, k, element), f"id long, vector array<{asked_as}>, block int, floor long, tie long")
    packed = cut_lineage(bounded.groupBy("block").applyInArrow(*_pack_blocks(sent, annuli)))

    n_blocks, n_bundles = sum(n for _, n in set(blocks)), int((annuli.bundle + annuli.parts).max())
    tasks = lambda bundles: min(max(1, n_blocks * bundles), MOST_TASKS)
    keys = ["block", "bundle"]
    copied = packed.select(F.col("block").alias("block"), "id", "floor", "tie", "vectors", F.explode("bundles").alias("bundles"))
    copied = copied.repartition(tasks(-(-n_bundles // COPIES)), "block", F.col("bundles")[0])
    left = copied.withColumn("bundle", F.explode("bundles")).drop("bundles").repartition(tasks(n_bundles), *keys)
    right = pieces.join(packed.select(F.col("block").alias("opened_by"), F.explode("pieces").alias("piece")), "piece")
    right = right.withColumnRenamed("opened_by", "block").repartition(tasks(n_bundles), *keys)
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_score(sent, sizes, kind, k, element, asked_as), "query_id long, vec_id long, score long")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
