"""Closed intervals on sequences: gaps, overlaps, windows around a start, structure metrics.

A sequence (or any other key) may hold a large part of all intervals, so everything that depends on
order is computed in bins of the coordinate and carried from bin to bin through one row per bin.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladegrid.functions.scalars import closed_length, midpoint
from cladegrid.functions.sequences import reverse_complement
from cladegrid.operators.cumulative import running_before, width_bucket_of
from cladegrid.operators.joins import keyed_join

BIN_WIDTH = 100_000


def with_previous_end(
    intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", width: int = BIN_WIDTH
) -> DataFrame:
    """Distinct intervals per key with their multiplicity ``n`` and the end of the one before.

    Order is (start, end). The end of the last interval of the nearest earlier non-empty bin is
    carried into the first interval of a bin.
    """
    distinct = intervals.groupBy(*keys, start, end).agg(F.count("*").alias("n"))
    binned = distinct.withColumn("_bin", width_bucket_of(width)(F.col(start)))
    bins = binned.groupBy(*keys, "_bin").agg(F.max(F.struct(start, end)).alias("_last"))
    before = Window.partitionBy(*keys).orderBy("_bin")
    carried = bins.select(*keys, "_bin", F.lag(F.col("_last")[end]).over(before).alias("_carried"))
    inside = Window.partitionBy(*keys, "_bin").orderBy(start, end)
    joined = keyed_join(binned, carried, [*keys, "_bin"], "inner")
    return joined.withColumn("previous_end", F.coalesce(F.lag(end).over(inside), F.col("_carried"))).drop(
        "_bin", "_carried"
    )


def gaps(
    intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", width: int = BIN_WIDTH
) -> DataFrame:
    """Gap before each distinct interval, never negative, NULL for the first of a key.

    Repeats of an interval have a gap of 0; ``n`` tells how many rows it stands for.
    """
    previous = with_previous_end(intervals, keys, start, end, width)
    gap = F.greatest(F.lit(0).cast("long"), (F.col(start) - F.col("previous_end") - 1).cast("long"))
    return previous.withColumn("gap", F.when(F.col("previous_end").isNotNull(), gap))


def overlapping_neighbours(
    intervals: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end", width: int = BIN_WIDTH
) -> DataFrame:
    """Violations: intervals of a key that start at or before the end of the one before, or repeat."""
    previous = with_previous_end(intervals, keys, start, end, width)
    return previous.where((F.col(start) <= F.col("previous_end")) | (F.col("n") > 1))


def overlap_counts(
    windows: DataFrame, features: DataFrame, seqid: str, window_id: str, self_id: str,
    width: int = BIN_WIDTH, w: tuple[str, str] = ("start", "end"), f: tuple[str, str] = ("start", "end"),
) -> DataFrame:
    """Number of features overlapping each window, without those that carry the window's ``self_id``.

    Overlaps are starts up to the window end minus ends before the window start: no pair is formed.
    """
    starts = features.select(seqid, F.col(f[0]).alias("_pos"), F.lit(1).alias("_s"), F.lit(0).alias("_e"))
    ends = features.select(seqid, F.col(f[1]).alias("_pos"), F.lit(0).alias("_s"), F.lit(1).alias("_e"))
    asked = windows.select(
        seqid, F.explode(F.array(w[0], F.col(w[1]) + 1)).alias("_pos"), F.lit(0).alias("_s"), F.lit(0).alias("_e")
    )
    points = starts.unionByName(ends).unionByName(asked).groupBy(seqid, "_pos").agg(
        F.sum("_s").alias("_s"), F.sum("_e").alias("_e")
    )
    running = running_before(points, [seqid], "_pos", {"_s": "_started", "_e": "_ended"}, width_bucket_of(width))
    at_end = running.select(seqid, (F.col("_pos") - 1).alias(w[1]), "_started")
    at_start = running.select(seqid, F.col("_pos").alias(w[0]), "_ended")
    own = features.select(seqid, self_id, F.col(f[0]).alias("_fs"), F.col(f[1]).alias("_fe"))
    mine = (
        windows.select(seqid, window_id, self_id, *w)
        .join(own, [seqid, self_id])
        .where((F.col("_fs") <= F.col(w[1])) & (F.col("_fe") >= F.col(w[0])))
        .groupBy(window_id)
        .agg(F.count("*").alias("_own"))
    )
    counted = windows.join(at_end, [seqid, w[1]]).join(at_start, [seqid, w[0]]).join(mine, window_id, "left")
    number = F.col("_started") - F.col("_ended") - F.coalesce(F.col("_own"), F.lit(0))
    return counted.select(*windows.columns, number.alias("overlap_count"))


# Coordinates are told apart to this many positions when pairs are looked for; only speed depends on it.
PAIR_WIDTH = 1024


def _down(value: Column, level: Column) -> Column:
    """Cell of a block number at a level: cells of level k hold 4 ** k blocks."""
    return F.call_function("shiftright", value, F.lit(2).cast("int") * level)


def _range_levels(first: Column, after: Column) -> Column:
    """Levels at which a cell can lie inside the blocks first .. after - 1."""
    return F.sequence(F.lit(0), F.floor((F.length(F.bin(after - first)) - 1) / 2).cast("int"))


def _range_cells(first: Column, after: Column) -> Column:
    """The fewest cells (level, cell) that together hold the blocks first .. after - 1 and no other."""

    def run(start: Column, stop: Column) -> Column:
        return F.when(start < stop, F.sequence(start, stop - 1)).otherwise(F.array().cast("array<bigint>"))

    def at(level: Column) -> Column:
        start, stop = -_down(-first, level), _down(after, level)
        above_start, above_stop = -_down(-first, level + 1) * 4, _down(after, level + 1) * 4
        edges = F.concat(run(start, above_start), run(above_stop, stop))
        cells = F.when(above_start < above_stop, edges).otherwise(run(start, stop))
        return F.transform(cells, lambda cell: F.struct(level.alias("level"), cell.alias("cell")))

    return F.flatten(F.transform(_range_levels(first, after), at))


def points_in_ranges(ranges: DataFrame, points: DataFrame, seqid: str, first: str, last: str, point: str, width: int = PAIR_WIDTH) -> DataFrame:
    """(range row, point row) pairs on one sequence with first <= point <= last, by an equi-join.

    A range is cut into the few cells of sizes width * 4 ** k that hold exactly its blocks of ``width`` positions, at most
    six of a size, and a point is in one cell of each size that some range uses. So a pair meets once, a long range
    costs the logarithm of its length, and only the two blocks at its ends can hold points outside it: with ``width``
    1 there are none. The columns of the two tables must differ but for ``seqid``; empty ranges and nulls meet nothing.
    """
    block = width_bucket_of(width)
    usable = ranges.where(F.col(first) <= F.col(last))
    cut = usable.withColumn("_at", F.explode(_range_cells(block(F.col(first)), block(F.col(last)) + 1)))
    highest = usable.agg(F.max(F.size(_range_levels(block(F.col(first)), block(F.col(last)) + 1)))).scalar()
    placed = points.where(F.col(point).isNotNull()).withColumns({"_block": block(F.col(point)), "_levels": highest})
    spread = placed.withColumn(
        "_at",
        F.explode(F.transform(F.sequence(F.lit(0), F.col("_levels") - 1), lambda k: F.struct(k.alias("level"), _down(F.col("_block"), k).alias("cell")))),
    ).drop("_block", "_levels")
    inside = (F.col(first) <= F.col(point)) & (F.col(point) <= F.col(last))
    return cut.join(spread, [seqid, "_at"]).where(inside).drop("_at")


def overlap_pairs(
    windows: DataFrame, features: DataFrame, seqid: str, window_id: str, self_id: str,
    width: int = PAIR_WIDTH, w: tuple[str, str] = ("start", "end"), f: tuple[str, str] = ("start", "end"),
) -> DataFrame:
    """(window, overlapping other feature) rows; as many as the id lists of the result have entries.

    Of two overlapping intervals either the feature starts inside the window or the window starts inside the
    feature after its start: two searches of points in ranges, which share no pair. Intervals have start <= end.
    """
    left = windows.select(seqid, window_id, F.col(self_id).alias("_self"), F.col(w[0]).cast("long").alias("_ws"), F.col(w[1]).cast("long").alias("_we"))
    right = features.select(seqid, F.col(self_id).alias("feature_id"), F.col(f[0]).cast("long").alias("_fs"), F.col(f[1]).cast("long").alias("_fe"))
    left, right = left.where("_ws <= _we"), right.where("_fs <= _fe")
    begun = points_in_ranges(left, right, seqid, "_ws", "_we", "_fs", width)
    running = points_in_ranges(right.withColumn("_after", F.col("_fs") + 1), left, seqid, "_after", "_fe", "_ws", width)
    met = begun.select(window_id, "_self", "feature_id").unionByName(running.select(window_id, "_self", "feature_id"))
    return met.where(F.col("feature_id") != F.col("_self")).select(window_id, "feature_id")


def overlap_lists(windows: DataFrame, features: DataFrame, seqid: str, window_id: str, self_id: str, **options) -> DataFrame:
    """Windows with the count and the packed sorted ids of overlapping features, NULL for none."""
    pairs = overlap_pairs(windows, features, seqid, window_id, self_id, **options)
    packed = pairs.groupBy(window_id).agg(
        F.count("*").alias("overlap_count"),
        F.array_join(F.array_sort(F.collect_list("feature_id")), ";").alias("overlap_ids"),
    )
    joined = windows.join(packed, window_id, "left")
    return joined.withColumn("overlap_count", F.coalesce(F.col("overlap_count"), F.lit(0)))


def start_windows(
    items: DataFrame, lengths: DataFrame, upstream: int, downstream: int, on: Sequence[str],
    start: str = "gene_start", end: str = "gene_end", strand: str = "strand", length: str = "length",
) -> DataFrame:
    """Window around the strand-aware start of each item, clamped to its sequence, with a quality label.

    ``lengths`` gives the length (and whatever else) of each sequence; items whose sequence is unknown
    or whose strand is neither + nor - keep their row without coordinates.
    """
    joined = items.join(lengths, list(on), "left")
    forward, backward = F.col(strand) == "+", F.col(strand) == "-"
    first = F.col(start).cast("long") - 1
    last = F.col(end).cast("long")
    raw_start = F.when(forward, first - F.lit(upstream)).when(backward, last - F.lit(downstream))
    raw_end = F.when(forward, first + F.lit(downstream)).when(backward, last + F.lit(upstream))
    found = F.col(length).isNotNull()
    usable = found & (forward | backward)
    start0 = F.greatest(F.lit(0).cast("long"), F.col("_raw_start"))
    end0 = F.least(F.col(length).cast("long"), F.col("_raw_end"))
    truncated = (F.col("_start0") != F.col("_raw_start")) | (F.col("_end0") != F.col("_raw_end"))
    label = (
        F.when(~found, F.lit("CHROMOSOME_NOT_FOUND"))
        .when(~(forward | backward) | F.col(strand).isNull(), F.lit("INVALID_STRAND"))
        .when(truncated, F.lit("TRUNCATED_AT_CHROMOSOME_BOUNDARY"))
        .otherwise(F.lit("PASS"))
    )
    anchor = F.when(usable & forward, F.col(start)).when(usable & backward, F.col(end)).cast("long")
    return (
        joined.withColumns({"_raw_start": F.when(usable, raw_start), "_raw_end": F.when(usable, raw_end)})
        .withColumns({"_start0": F.when(usable, start0), "_end0": F.when(usable, end0)})
        .withColumns(
            {
                "tss_1based": anchor,
                "window_start": F.col("_start0") + 1,
                "window_end": F.col("_end0"),
                "window_length": F.when(usable, F.greatest(F.lit(0).cast("long"), F.col("_end0") - F.col("_start0"))),
                "truncated": truncated,
                "window_qc": label,
            }
        )
        .drop("_raw_start", "_raw_end", "_start0", "_end0")
    )


def window_sequence(sequence: str, strand: str = "strand") -> Column:
    """Sequence of a window made by :func:`start_windows`, complemented on the minus strand."""
    piece = F.substr(F.col(sequence), F.col("window_start").cast("int"), F.col("window_length").cast("int"))
    return F.when(F.col(strand) == "-", reverse_complement(piece)).otherwise(piece)


def positions_on_sequences(
    items: DataFrame, lengths: DataFrame, on: Sequence[str], start: str, end: str, length: str = "chromosome_length"
) -> DataFrame:
    """Midpoint and relative position of items; items without coordinates or sequence are labelled."""
    joined = items.join(lengths, list(on), "left")
    usable = F.col(start).isNotNull() & F.col(end).isNotNull() & F.col(length).isNotNull()
    mid = F.when(usable, midpoint(start, end))
    return joined.withColumns(
        {
            "midpoint": mid,
            "relative_position": F.try_divide(mid, F.col(length).cast("double")),
            "coordinate_qc": F.when(usable, F.lit("PASS")).otherwise(F.lit("MISSING_COORDINATE_OR_CHROMOSOME")),
        }
    )


def density_per_sequence(
    positions: DataFrame, keys: Sequence[str], item: str, length: str = "chromosome_length", per: float = 1_000_000.0
) -> DataFrame:
    """Distinct items per sequence and per ``per`` positions; unusable rows and NULL keys are dropped."""
    usable = positions.where("coordinate_qc = 'PASS'").dropna(subset=[*keys, length])
    counts = usable.groupBy(*keys, length).agg(F.countDistinct(item).alias("item_count"))
    return counts.withColumn("density", F.col("item_count") / (F.col(length) / F.lit(per)))


# Feature types whose lengths are summed into the three UTR columns, lower case.
UTR_FEATURES = {
    "five_prime_utr_length": ("five_prime_utr", "5utr"),
    "three_prime_utr_length": ("three_prime_utr", "3utr"),
    "generic_utr_length": ("utr",),
}


def structure_metrics(parts: DataFrame, key: str, kind: str = "feature", width: int = BIN_WIDTH) -> DataFrame:
    """Exon, intron, coding and UTR counts and lengths per key from its part features."""
    lower = F.lower(F.col(kind))
    length = closed_length("start", "end")

    def total(*names: str) -> Column:
        return F.coalesce(F.sum(F.when(lower.isin(*names), length)), F.lit(0)).cast("long")

    sums = parts.groupBy(key).agg(
        total("cds").alias("cds_length"),
        F.count_if(lower == "exon").alias("exon_count"),
        total("exon").alias("total_exon_length"),
        *[total(*names).alias(column) for column, names in UTR_FEATURES.items()],
        F.count_if(lower == "cds").alias("_cds"),
    )
    exon_gaps = gaps(parts.where(lower == "exon"), [key], width=width)
    introns = exon_gaps.groupBy(key).agg(F.sum(F.coalesce(F.col("gap"), F.lit(0))).alias("_introns"))
    n = F.col("exon_count")
    joined = keyed_join(sums, introns, [key], "left")
    intron_count = F.greatest(n - 1, F.lit(0))
    intron_total = F.coalesce(F.col("_introns"), F.lit(0)).cast("long")
    return joined.select(
        key,
        "cds_length",
        "exon_count",
        "total_exon_length",
        F.try_divide(F.col("total_exon_length"), n).alias("mean_exon_length"),
        intron_count.alias("intron_count"),
        intron_total.alias("total_intron_length"),
        F.coalesce(F.try_divide(intron_total, intron_count), F.lit(0.0)).alias("mean_intron_length"),
        *UTR_FEATURES,
        F.when((n > 0) & (F.col("_cds") > 0), "PASS").otherwise("MISSING_EXON_OR_CDS").alias("structure_qc"),
    )


def coding_lengths(cds: DataFrame, transcript: str) -> DataFrame:
    return cds.groupBy(transcript).agg(F.sum(closed_length("start", "end")).alias("cds_length"))
