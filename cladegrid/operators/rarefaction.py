"""Rarefaction: how many groups are seen in any / in all units of a subset, per subset size.

Groups are reduced to presence bit masks and counted per distinct mask before any subset is looked
at, so the work is subsets x distinct masks and does not grow with the number of groups. Subsets
are numbered: those of a size are all the ranks 0 .. C(n, k) - 1, or the first places of a seeded
permutation of them, and a rank names its subset. Their number follows from the parameters alone,
so they are sent to the masks in parts of a fixed size, and each task adds up its own masks.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WORD = 60  # units per 64-bit mask word
PART_BYTES = 64 << 20  # subsets that are sent to the tasks at once
ROUNDS = 4  # of the permutation


def _words(n: int) -> list[str]:
    return [f"w{i}" for i in range(math.ceil(n / WORD))]


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.cast("int"))


def group_masks(membership: DataFrame, group: str, unit: str, units: Sequence[str]) -> DataFrame:
    """Distinct presence masks with the number of groups that have them."""
    index = F.create_map(*[F.lit(x) for pair in ((u, i) for i, u in enumerate(units)) for x in pair])
    present = membership.where(F.col(unit).isin(*units)).select(group, index[F.col(unit)].alias("_i"))
    words = _words(len(units))

    def word(number: int) -> Column:
        bit = F.when(
            F.floor(F.col("_i") / F.lit(WORD)) == number,
            _bit(F.pmod(F.col("_i"), F.lit(WORD))),
        ).otherwise(F.lit(0).cast("long"))
        return F.bit_or(bit)

    masks = present.groupBy(group).agg(*[word(i).alias(w) for i, w in enumerate(words)])
    return masks.groupBy(*words).agg(F.count("*").alias("n_groups"))


def permuted(place: int, size: int, seed: int, subset_size: int) -> int:
    """The rank at a place of the seeded permutation of 0 .. size - 1.

    The ranks are pairs of digits to the least base whose square is not below the size; each round
    moves one digit by a hash of the other. Pairs above the size are permuted on until they fit.
    """
    base = math.isqrt(size - 1) + 1
    high, low = divmod(place, base)
    while True:
        for number in range(ROUNDS):
            digest = hashlib.md5(f"{seed}:{subset_size}:{number}:{low}".encode()).hexdigest()
            high, low = low, (high + int(digest[:13], 16) % base) % base
        if high * base + low < size:
            return high * base + low


def subset_of_rank(rank: int, n: int, subset_size: int) -> list[int]:
    """The subset of 0 .. n - 1 at a rank in the order of index combinations."""
    members = []
    for i in range(n):
        if len(members) == subset_size:
            break
        starting = math.comb(n - i - 1, subset_size - len(members) - 1)
        if rank < starting:
            members.append(i)
        else:
            rank -= starting
    return members


def _numbered(spark: SparkSession, n: int, counts: dict[int, int], seed: int) -> DataFrame:
    """(id, subset_size, members, words): the first ``counts[k]`` subsets of every size k."""
    sizes = sorted(counts)
    ends = list(itertools.accumulate(counts[k] for k in sizes))
    words = _words(n)

    def subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            found = []
            for number in ids:
                at = bisect.bisect_right(ends, number)
                k, place = sizes[at], number - (ends[at - 1] if at else 0)
                every = math.comb(n, k)
                found.append(subset_of_rank(place if counts[k] == every else permuted(place, every, seed, k), n, k))
            masks = [[sum(1 << i - w * WORD for i in m if w * WORD <= i < (w + 1) * WORD) for m in found] for w in range(len(words))]
            columns = [pa.array(ids), pa.array([len(m) for m in found], pa.int32()), pa.array(found, pa.list_(pa.int32())), *(pa.array(m, pa.int64()) for m in masks)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "subset_size", "_members", *words])

    fields = ", ".join(["id long, subset_size int, _members array<int>", *(f"{w} long" for w in words)])
    return spark.range(ends[-1] if ends else 0).mapInArrow(subsets, fields)


def unit_subsets(
    spark: SparkSession, units: Sequence[str], max_exact: int, iterations: int, seed: int
) -> DataFrame:
    """Subsets per size: all of them when there are at most ``max_exact``, else up to ``iterations``.

    Drawn subsets are different ones and always as many as wanted; they differ from those of a
    random generator, listed ones do not. Iterations count listed subsets in the order of index
    combinations and drawn ones by their labels.
    """
    n = len(units)
    every = {k: math.comb(n, k) for k in range(1, n + 1)}
    exact = [k for k, c in every.items() if c <= max_exact]
    subsets = _numbered(spark, n, {k: c if c <= max_exact else min(c, iterations) for k, c in every.items()}, seed)
    names = F.array(*[F.lit(u) for u in units])
    labels = F.transform(F.col("_members"), lambda i: F.get(names, i))
    is_exact = F.col("subset_size").isin(*exact) if exact else F.lit(False)
    rank = Window.partitionBy("subset_size").orderBy(F.when(is_exact, F.col("_members")), "_labels")
    return (
        subsets.withColumn("sampling", F.when(is_exact, "exact").otherwise("random_unique"))
        .withColumn("_labels", F.when(is_exact, labels).otherwise(F.array_sort(labels)))
        .withColumn("iteration", F.row_number().over(rank).cast("long"))
        .withColumn("subset", F.array_join("_labels", ","))
        .select("id", "subset_size", "iteration", "sampling", "subset", *_words(n))
    )


def _bits(words: list[np.ndarray], n: int) -> np.ndarray:
    """0 and 1 of every unit, one row per mask."""
    return np.stack([(words[i // WORD] >> (i % WORD)) & 1 for i in range(n)], 1).astype(np.float32)


def _seen(masks: DataFrame, subsets: pa.Table, words: Sequence[str], n: int) -> DataFrame:
    """(id, pan_count, core_count) of the given subsets, added up per task and then over tasks."""
    shared = masks.sparkSession.sparkContext.broadcast((subsets.column("id").to_numpy(), [subsets.column(w).to_numpy() for w in words]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packed = shared.value
        pan, core, some = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64), False
        for batch in batches:
            weights = batch.column("n_groups").to_numpy()
            held = [batch.column(w).to_numpy() for w in words]
            some |= len(weights) > 0
            for a, b in itertools.product(range(0, len(weights), 1024), range(0, len(ids), 4096)):
                mine, theirs = _bits([w[a : a + 1024] for w in held], n), _bits([w[b : b + 4096] for w in packed], n)
                common = mine @ theirs.T
                pan[b : b + 4096] += weights[a : a + 1024] @ (common > 0)
                core[b : b + 4096] += weights[a : a + 1024] @ (common == theirs.sum(1))
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids, pan, core)], names=["id", "pan_count", "core_count"])

    counted = masks.mapInArrow(count, "id long, pan_count long, core_count long")
    return counted.groupBy("id").agg(F.sum("pan_count").alias("pan_count"), F.sum("core_count").alias("core_count"))


def rarefaction(
    membership: DataFrame,
    group: str,
    unit: str,
    units: Sequence[str],
    max_exact: int = 1000,
    iterations: int = 5000,
    seed: int = 1,
) -> DataFrame:
    """Per subset of units: groups present in any (``pan_count``) and in all (``core_count``) of them."""
    n, words = len(units), _words(len(units))
    masks = group_masks(membership, group, unit, units)
    subsets = unit_subsets(membership.sparkSession, units, max_exact, iterations, seed)
    every = {k: math.comb(n, k) for k in range(1, n + 1)}
    total = sum(c if c <= max_exact else min(c, iterations) for c in every.values())
    step = max(1, PART_BYTES // (8 * (len(words) + 1)))
    packed = [subsets.where((F.col("id") >= a) & (F.col("id") < a + step)).select("id", *words).toArrow() for a in range(0, total, step)]
    counted = reduce(DataFrame.unionByName, [_seen(masks, part, words, n) for part in packed])
    named = subsets.select("id", "subset_size", "iteration", "sampling", "subset").join(counted, "id", "left")
    return named.select(
        "subset_size", "iteration", "sampling", "subset",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("pan_count", "core_count")],
    )


def rarefaction_summary(iterations: DataFrame) -> DataFrame:
    """Mean, median and 2.5 / 97.5 % quantiles of both counts per subset size.

    A size has at most as many subsets as the parameters allow, so its exact percentiles fit one task.
    """
    wanted = {"median": 0.5, "q025": 0.025, "q975": 0.975}
    columns = []
    for kind in ("pan", "core"):
        count = F.col(f"{kind}_count")
        columns.append(F.avg(count).alias(f"{kind}_mean"))
        columns += [F.percentile(count, F.lit(p)).alias(f"{kind}_{name}") for name, p in wanted.items()]
    return iterations.groupBy("subset_size").agg(*columns)
