"""Sequences as tiles of bounded length, and intervals cut out of them.

A tile is ``(keys.., tile, residues)``: residues ``tile * width`` to ``(tile + 1) * width - 1`` of a sequence, counted
from 0. Intervals meet the tiles they touch through an equi-join, so no row holds a whole chromosome and no chromosome
is a single join key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladegrid.functions.sequences import reverse_complement, translate_codons
from cladegrid.sources import ranges

WIDTH = 1 << 16


def read_tiles(spark: SparkSession, path: str | Sequence[str], width: int = WIDTH, range_bytes: int = ranges.RANGE_BYTES) -> DataFrame:
    """``file, seq_id, tile, residues`` of sequence files, read by byte ranges; blanks are no residues.

    A range does not know the record it starts in; the last header of the ranges before it and the residues since are
    carried to it. A record without residues has no tile, and so has text before the first header.
    """
    ranges.register(spark)
    paths = [path] if isinstance(path, str) else list(path)
    options = {"paths": "\n".join(paths), "rangeBytes": str(range_bytes), "pieceLength": str(width)}
    pieces = spark.read.format("fasta_pieces").options(**options).load()
    end = F.col("start") + F.length("residues")
    last = pieces.groupBy("file", "range").agg(F.max(F.struct("piece", "record", "seq_id", end.alias("end"))).alias("last"))
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    header = F.when(F.col("last.record") > 0, F.struct(F.col("range").alias("home"), F.col("last.record").alias("record"), F.col("last.seq_id").alias("seq_id")))
    # residues of the open record: all since the range of its header, whose own count starts at the header
    sums = last.select("file", "range", header.alias("header"), F.col("last.end").alias("end")).withColumn("sum", F.coalesce(F.sum("end").over(before), F.lit(0)))
    carried = sums.select(
        "file", "range", F.last("header", ignorenulls=True).over(before).alias("carried"),
        (F.col("sum") - F.coalesce(F.last(F.when(F.col("header").isNotNull(), F.col("sum")), ignorenulls=True).over(before), F.lit(0))).alias("since"),
    )
    # one row per byte range, sent to all tasks, so that the residues stay where they were read
    joined = pieces.where("residues <> ''").join(F.broadcast(carried), ["file", "range"])
    own = F.col("record") > 0
    placed = joined.select(
        "file", F.when(own, F.struct(F.col("range").alias("home"), "record", "seq_id")).otherwise(F.col("carried")).alias("header"),
        F.when(own, F.col("start")).otherwise(F.col("start") + F.col("since")).alias("start"), "residues",
    ).where("header is not null")
    return _tiled(placed, ["file", "header"], width).select("file", "header.seq_id", "tile", "residues")


def tile_sequences(sequences: DataFrame, keys: Sequence[str], sequence: str = "sequence", width: int = WIDTH) -> DataFrame:
    """Tiles of sequences that are whole strings."""
    tiles = F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(sequence) - 1) / width)).cast("int"))
    return sequences.select(*keys, sequence, F.explode(tiles).alias("tile")).select(
        *keys, F.col("tile").cast("long").alias("tile"), F.substr(sequence, (F.col("tile") * width + 1).cast("int"), F.lit(width)).alias("residues")
    )


def _tiled(pieces: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Tiles of pieces (keys, start, residues) that are at most a tile long and so touch two tiles at most."""
    first, last = F.floor(F.col("start") / width), F.floor((F.col("start") + F.length("residues") - 1) / width)
    each = pieces.select(*keys, "start", "residues", F.explode(F.sequence(first, last)).alias("tile"))
    low = F.greatest(F.lit(0), F.col("tile") * width - F.col("start"))
    high = F.least(F.length("residues").cast("long"), (F.col("tile") + 1) * width - F.col("start"))
    cut = each.select(*keys, "tile", (F.col("start") + low).alias("at"), F.substr("residues", (low + 1).cast("int"), (high - low).cast("int")).alias("part"))
    parts = F.array_sort(F.collect_list(F.struct("at", "part")))
    return cut.groupBy(*keys, "tile").agg(F.array_join(F.transform(parts, lambda p: p["part"]), "").alias("residues"))


def tile_lengths(tiles: DataFrame, keys: Sequence[str], width: int = WIDTH, name: str = "length") -> DataFrame:
    """Length of every sequence."""
    return tiles.groupBy(*keys).agg(F.max(F.col("tile") * width + F.length("residues")).cast("long").alias(name))


def cut_intervals(
    intervals: DataFrame, tiles: DataFrame, keys: Sequence[str], start: str = "start", end: str = "end",
    width: int = WIDTH, name: str = "piece",
) -> DataFrame:
    """Add the residues of 1-based closed intervals, clamped to their sequence; NULL where nothing is left.

    Pieces of an interval over several tiles are put together in order. A row of ``intervals`` is identified by all
    its columns; equal rows are kept as often as they occur.
    """
    columns = intervals.columns
    counted = intervals.groupBy(*columns).agg(F.count("*").alias("_times"))
    first = F.greatest(F.lit(1).cast("long"), F.col(start).cast("long"))
    wanted = counted.where(F.col(end) >= first).withColumn("tile", F.explode(F.sequence(F.floor((first - 1) / width), F.floor((F.col(end).cast("long") - 1) / width))))
    met = wanted.join(tiles.select(*keys, "tile", "residues"), [*keys, "tile"])
    low = F.greatest(first, F.col("tile") * width + 1) - F.col("tile") * width
    high = F.least(F.col(end).cast("long"), (F.col("tile") + 1) * width) - F.col("tile") * width
    part = met.select(*columns, "tile", F.substr("residues", low.cast("int"), (high - low + 1).cast("int")).alias("_part"))
    parts = F.array_sort(F.collect_list(F.struct("tile", "_part")))
    joined = part.groupBy(*columns).agg(F.nullif(F.array_join(F.transform(parts, lambda p: p["_part"]), ""), F.lit("")).alias(name))
    renamed = joined.select(*[F.col(c).alias(f"_r_{c}") for c in columns], name)
    same = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in columns]
    found = counted.join(renamed, same, "left")
    return found.select(*columns, name, F.explode(F.sequence(F.lit(1), F.col("_times").cast("int"))).alias("_copy")).drop("_copy")


def spliced_from_tiles(segments: DataFrame, tiles: DataFrame, keys: Sequence[str], transcript: str = "transcript_id", width: int = WIDTH) -> DataFrame:
    """Coding sequence and protein per transcript from segments (keys, strand, start, end, transcript) and tiles."""
    cut = cut_intervals(segments.select(transcript, *keys, "strand", "start", "end"), tiles, keys, width=width)
    ordered = F.array_sort(F.collect_list(F.struct("start", "piece")))
    joined = cut.where("piece is not null").groupBy(transcript, "strand").agg(F.array_join(F.transform(ordered, lambda s: s["piece"]), "").alias("_plus"))
    cds = F.when(F.col("strand") == "-", reverse_complement("_plus")).otherwise(F.col("_plus"))
    return joined.select(transcript, cds.alias("cds")).withColumn("protein", translate_codons("cds"))
