"""Interval joins and interval sequences.

Range joins become equi-joins: both sides are exploded into time buckets, the exact predicate filters, and only the pair's
first common bucket counts, so that no pair comes twice. A bucket as wide as the usual interval keeps the copies to about
two a row; a hot key spreads over its buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.functions.exprs import overlap


def _buckets(start: Column, stop: Column, width: float) -> Column:
    return F.explode(F.sequence(F.floor(start / width).cast("long"), F.floor(stop / width).cast("long")))


def containment_join(points: DataFrame, spans: DataFrame, t: str, start: str, stop: str, width: float, on: list[str] = (), how: str = "inner") -> DataFrame:
    """points with t in [start, stop] of a span, both ends included; equal in the columns ``on``.

    ``how``: inner, or left to keep points without a span. Bounds and times are numbers in one unit. Spans with a null or
    inverted bound match nothing.
    """
    good = spans.where(F.col(start) <= F.col(stop)).withColumn("__b", _buckets(F.col(start), F.col(stop), width))
    keyed = points.withColumn("__b", F.floor(F.col(t) / width).cast("long"))
    hit = (keyed["__b"] == good["__b"]) & (keyed[t] >= good[start]) & (keyed[t] <= good[stop])
    for c in on:
        hit = hit & (keyed[c] == good[c])
    out = keyed.join(good, hit, how)
    for c in on:
        out = out.drop(good[c])
    return out.drop(keyed["__b"]).drop(good["__b"])


def overlap_join(left: DataFrame, right: DataFrame, a: tuple[str, str], b: tuple[str, str], width: float, on: list[str] = (), strict: bool = False) -> DataFrame:
    """Pairs of intervals that overlap: touching ends count unless ``strict``. Column names of the sides must differ, ``on`` apart."""
    (a0, a1), (b0, b1) = a, b
    lo = left.where(F.col(a0) <= F.col(a1)).withColumn("__b", _buckets(F.col(a0), F.col(a1), width))
    hi = right.where(F.col(b0) <= F.col(b1)).withColumn("__b", _buckets(F.col(b0), F.col(b1), width))
    meet = (lo[a0] < hi[b1]) & (lo[a1] > hi[b0]) if strict else (lo[a0] <= hi[b1]) & (lo[a1] >= hi[b0])
    first = lo["__b"] == F.greatest(F.floor(lo[a0] / width), F.floor(hi[b0] / width)).cast("long")
    hit = (lo["__b"] == hi["__b"]) & meet & first
    for c in on:
        hit = hit & (lo[c] == hi[c])
    out = lo.join(hi, hit)
    for c in on:
        out = out.drop(hi[c])
    return out.drop(lo["__b"]).drop(hi["__b"])


def apportion(pairs: DataFrame, segment: list[str], label: str, a: tuple[str, str], b: tuple[str, str], least: float = 0.05) -> DataFrame:
    """Overlapping pairs -> (segment.., label, seconds, share, dominant): labels' shares of a segment's whole overlap.

    Shares under ``least`` are dropped after dividing; the dominant label is the longest, ties to the smaller.
    """
    by = Window.partitionBy(*segment)
    seconds = overlap(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1]))
    sums = pairs.groupBy(*segment, label).agg(F.sum(seconds).alias("seconds")).where("seconds > 0")
    return (
        sums.withColumn("share", F.col("seconds") / F.sum("seconds").over(by))
        .withColumn("dominant", F.row_number().over(by.orderBy(F.col("seconds").desc(), label)) == 1)
        .where(F.col("share") >= least)
    )


def best_overlap(left: DataFrame, pairs: DataFrame, key: list[str], label: str, a: tuple[str, str], b: tuple[str, str], default: str = "UNKNOWN") -> DataFrame:
    """Every left row with the partner that overlaps it longest in sum (ties to the smaller label), else ``default``."""
    seconds = overlap(F.col(a[0]), F.col(a[1]), F.col(b[0]), F.col(b[1]))
    sums = pairs.groupBy(*key, label).agg(F.sum(seconds).alias("__s")).where("__s > 0")
    best = sums.groupBy(*key).agg(F.min(F.struct((-F.col("__s")).alias("s"), F.col(label).alias("l"))).alias("__best"))
    return left.join(best, key, "left").withColumn(label, F.coalesce(F.col("__best.l"), F.lit(default))).drop("__best")


def gap_sessions(df: DataFrame, by: list[str], start: str, stop: str, gap: float, order: list[str] = (), out: str = "session") -> DataFrame:
    """A new session when a row starts more than ``gap`` after the row before it ended (that row, not the latest end)."""
    w = Window.partitionBy(*by).orderBy(start, *order)
    new = F.when(F.col(start) - F.lag(stop).over(w) > gap, 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def merged_sessions(df: DataFrame, by: list[str], start: str, stop: str, gap: float, order: list[str] = (), out: str = "session") -> DataFrame:
    """A new session when a row starts more than ``gap`` after the latest end so far: intervals that merge stay together."""
    w = Window.partitionBy(*by).orderBy(start, *order)
    new = F.when(F.col(start) - F.max(stop).over(w.rowsBetween(Window.unboundedPreceding, -1)) > gap, 1).otherwise(0)
    return df.withColumn("__new", new).withColumn(out, F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__new")


def dead_air(df: DataFrame, by: list[str], start: str, stop: str) -> DataFrame:
    """The longest hole between intervals of a group; 0 without one."""
    w = Window.partitionBy(*by).orderBy(start, stop).rowsBetween(Window.unboundedPreceding, -1)
    hole = F.greatest(F.lit(0.0), F.col(start) - F.max(stop).over(w))
    return df.withColumn("__hole", hole).groupBy(*by).agg(F.coalesce(F.max("__hole"), F.lit(0.0)).alias("dead_air"))


def out_of_order(df: DataFrame, by: list[str], order: str, start: str, stop: str) -> DataFrame:
    """Rows of a group that start before the latest end of the rows before them, in the given order."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("__late", F.col(start) < F.max(stop).over(w)).groupBy(*by).agg(F.count_if(F.col("__late")).alias("out_of_order"))


def chunk_plan(df: DataFrame, duration: str, length: float = 63.0, stride: float = 60.0) -> DataFrame:
    """A row for each chunk of a recording: (chunk, chunk_start, chunk_stop), overlapping by length - stride."""
    at = F.posexplode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.col(duration) / stride).cast("int") - 1)))
    rows = df.select("*", at.alias("chunk", "__k"))
    begin = F.col("__k") * F.lit(float(stride))
    return rows.withColumn("chunk_start", begin).withColumn("chunk_stop", F.least(F.col(duration).cast("double"), begin + length)).drop("__k")


def merge_chunks(segments: DataFrame, chunk: str, start: str, stop: str, length: float = 63.0, stride: float = 60.0) -> DataFrame:
    """Segments timed within their chunk to the recording's time; those that end inside a later chunk's overlap are dropped."""
    shared = length - stride
    kept = segments.where((F.col(chunk) == 0) | (F.col(stop) > shared))
    shift = F.col(chunk) * F.lit(float(stride))
    return kept.withColumn(start, F.col(start) + shift).withColumn(stop, F.col(stop) + shift)


def clip_to_window(df: DataFrame, start: str, stop: str, lo: Column | float, hi: Column | float) -> DataFrame:
    """Rows that overlap the window, shifted to it and held inside; empty ones go."""
    lo, hi = (x if isinstance(x, Column) else F.lit(x) for x in (lo, hi))
    a, b = F.greatest(F.col(start), lo) - lo, F.least(F.col(stop), hi) - lo
    return df.where((F.col(start) < hi) & (F.col(stop) > lo)).withColumn("__a", a).withColumn("__b", b).where("__b > __a").drop(start, stop).withColumnsRenamed({"__a": start, "__b": stop})


def clean_segments(df: DataFrame, start: str, stop: str) -> DataFrame:
    """Segments with finite bounds, ends not before starts; flags tell what was mended. Empty texts stay."""
    finite = ~F.isnan(start) & ~F.isnan(stop) & F.col(start).isNotNull() & F.col(stop).isNotNull() & (F.abs(F.col(start)) < float("inf")) & (F.abs(F.col(stop)) < float("inf"))
    return df.where(finite).withColumn("neg_dur", F.col(stop) < F.col(start)).withColumn(stop, F.greatest(F.col(stop), F.col(start)))


def words_with_timing(df: DataFrame, text: str, start: str, stop: str) -> DataFrame:
    """A row for each word: the interval split in proportion to the words' lengths."""
    words = F.filter(F.split(F.col(text), r"\s+"), lambda w: w != "")
    total = F.aggregate(F.col("__w"), F.lit(0), lambda acc, w: acc + F.length(w))
    before = F.aggregate(F.slice("__w", 1, F.col("pos")), F.lit(0), lambda acc, w: acc + F.length(w))
    span = F.col(stop) - F.col(start)
    return (
        df.withColumn("__w", words).withColumn("__n", total).select("*", F.posexplode("__w").alias("pos", "word"))
        .withColumn("word_start", F.col(start) + span * before / F.col("__n"))
        .withColumn("word_stop", F.col(start) + span * (before + F.length("word")) / F.col("__n"))
        .drop("__w", "__n")
    )
