"""Tail probabilities as vectorised column functions; they run on result rows, never on data rows."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TAIL_TERMS, TAIL_FAR = 80, 2.5  # terms of the normal tail, and where its fraction takes over from its series
EXACT_SIDE = 8  # a rank-sum p-value is exact when one side has at most this many values and no ties


def chi_square_tail(x: float, df: int) -> float:
    """P(X >= x) for integer degrees of freedom, in closed form."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if df % 2 == 0:
        steps = np.arange(df // 2)
        logs = steps * math.log(half) - np.array([math.lgamma(k + 1) for k in steps])
        tail = 0.0
    else:
        steps = np.arange(1, df // 2 + 1)
        logs = (steps - 0.5) * math.log(half) - np.array([math.lgamma(k + 0.5) for k in steps])
        tail = math.erfc(math.sqrt(half))
    return min(1.0, tail + float(np.exp(logs - half).sum()))


def rank_sum_counts(m: int, n: int) -> np.ndarray:
    """Number of arrangements per value of U: coefficients of the Gaussian binomial (m+n choose m), as exact integers."""
    m, n = min(m, n), max(m, n)
    size = m * n + 1
    counts = np.zeros(size, dtype=object)
    counts[0] = 1
    for i in range(1, m + 1):
        shift = n + i
        if shift < size:
            counts[shift:] = counts[shift:] - counts[:-shift].copy()
        for offset in range(i):
            counts[offset::i] = np.cumsum(counts[offset::i])
    return counts


def rank_sum_tail(m: int, n: int) -> np.ndarray:
    """Two-sided exact p-value by U, from the middle up; below it the table is the mirror image."""
    above = np.cumsum(rank_sum_counts(m, n)[::-1])[::-1]
    every = math.comb(m + n, m)
    return np.array([min(1.0, 2 * int(c) / every) for c in above])


def rank_sum_exact(u: float, m: int, n: int) -> float:
    return float(rank_sum_tail(m, n)[int(max(u, m * n - u))])


def normal_tail(z: Column) -> Column:
    """Two-sided tail of the normal distribution, 1 where z is not above 0, by two fixed series."""
    x = z / F.lit(math.sqrt(2.0))
    square = F.exp(-x * x)
    steps = F.sequence(F.lit(0), F.lit(TAIL_TERMS - 1))

    def term(state: Column, k: Column) -> Column:
        following = state["term"] * F.lit(2.0) * state["x"] * state["x"] / (F.lit(2.0) * k + F.lit(3.0))
        return F.struct((state["sum"] + state["term"]).alias("sum"), following.alias("term"), state["x"].alias("x"))

    start = F.struct(F.lit(0.0).alias("sum"), x.alias("term"), x.alias("x"))
    near = F.lit(1.0) - F.aggregate(steps, start, term, lambda s: s["sum"]) * square * F.lit(2.0 / math.sqrt(math.pi))
    fraction = F.aggregate(
        F.reverse(steps), F.struct(x.alias("f"), x.alias("x")),
        lambda s, k: F.struct((s["x"] + (k + F.lit(1.0)) / F.lit(2.0) / s["f"]).alias("f"), s["x"].alias("x")),
        lambda s: s["f"],
    )
    far = square / (F.lit(math.sqrt(math.pi)) * fraction)
    return F.when(x <= 0, F.lit(1.0)).when(x < TAIL_FAR, near).otherwise(far)


def rank_sum_normal(u: Column, m: Column, n: Column, ties: Column) -> Column:
    """Two-sided normal approximation with tie and continuity corrections; 1 where all values are equal."""
    m, n = m.cast("double"), n.cast("double")
    total = m + n
    variance = m * n / F.lit(12.0) * ((total + 1) - F.try_divide(ties, total * (total - 1)))
    z = (F.greatest(u, m * n - u) - m * n / F.lit(2.0) - F.lit(0.5)) / F.sqrt(F.greatest(variance, F.lit(0.0)))
    return F.when(variance > 0, normal_tail(z)).otherwise(F.lit(1.0))


def rank_sum_tails(sizes: DataFrame) -> DataFrame:
    """(m, n, u, p): exact two-sided p-values of every U from the middle up, for distinct sizes m <= n."""

    def tails(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for m, n in zip(batch.column("m").to_pylist(), batch.column("n").to_pylist()):
                found = rank_sum_tail(m, n)
                u = np.arange(m * n // 2, m * n + 1)
                columns = [np.full(len(u), m), np.full(len(u), n), u, found[u]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["m", "n", "u", "p"])

    return sizes.select("m", "n").mapInArrow(tails, "m long, n long, u long, p double")


@F.pandas_udf(T.DoubleType())
def chi_square_p(x: pd.Series, df: pd.Series) -> pd.Series:
    pairs = zip(x, df, strict=True)
    return pd.Series([None if pd.isna(a) or pd.isna(k) else chi_square_tail(a, int(k)) for a, k in pairs], dtype=float)
