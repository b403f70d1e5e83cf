"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight schedule over training time 0 to 1, linear between knots. A schedule's integral is the source's
weight; weights share out all words, and no source is repeated more than ``cap`` times (water filling: the excess goes to
the others by weight). A source's documents follow a fixed pseudo-random order; their taken words are a share of the
cumulative demand, whose inverse gives each document its training position.

Prefix sums run in two levels: (source, first hex digits of the order key), then inside those, so that a hot source is
spread over thousands of windows. The order, and with it the result, doesn't depend on that split.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import WORD, checkpointed, fresh, table


@dataclass(frozen=True)
class Mix:
    """schedules: by the sources' order, repeating; knots (time, weight) from time 0 to 1, weights not negative.

    The defaults integrate to 1, 2 and 3: the first fade out, the third come late.
    """

    schedules: tuple = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 2.0), (1.0, 2.0)), ((0.0, 1.5), (0.5, 3.0), (1.0, 4.5)))
    cap: int = 3
    digits: int = 3

    def weights(self) -> list[float]:
        return [sum((t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(s, s[1:])) for s in self.schedules]


DEFAULT = Mix()


def position_sql(mix: Mix, kind: str, share: str) -> str:
    """SQL for the time at which a schedule's cumulative demand reaches ``share`` of its whole.

    In a segment from (t0, w0) to (t1, w1) the demand is a quadratic of the time; its root is 2c / (w0 + sqrt(..)).
    """
    cases = []
    for k, knots in enumerate(mix.schedules):
        whole, done = mix.weights()[k], 0.0
        segments = []
        for (t0, w0), (t1, w1) in zip(knots, knots[1:]):
            area = (t1 - t0) * (w0 + w1) / 2
            left = f"({share} * {whole!r}e0 - {done!r}e0)"
            slope = (w1 - w0) / (t1 - t0)
            time = f"{t0!r}e0 + 2e0 * {left} / nullif({w0!r}e0 + sqrt(greatest(0e0, {w0 * w0!r}e0 + {2 * slope!r}e0 * {left})), 0e0)"
            done += area
            segments.append(f"WHEN {share} * {whole!r}e0 <= {done!r}e0 THEN {time}")
        cases.append(f"WHEN {kind} = {k} THEN CASE {' '.join(segments)} ELSE 1e0 END")
    return f"CASE {' '.join(cases)} END"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, text, source, ...) -> (doc_id, source, size, key): words of the whole text, and the order key."""
    return docs.select(
        F.col("doc_id").cast("long"),
        F.col("source").cast("string"),
        F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")).alias("key"),
    )


def targets(rows: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """(source, size) -> a row a source: source_key, source_size, kind (of schedule), target (words), rate (repeats)."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, mix.weights())), (F.col("kind") + 1).cast("int"))
    full = Window.orderBy(F.col("most") / F.col("weight"), F.col("place"))
    whole = Window.partitionBy()
    capped_before = F.coalesce(F.sum("most").over(full.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(full.rowsBetween(0, Window.unboundedFollowing))
    return (
        rows.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("kind", F.col("place") % len(mix.schedules))
        .withColumn("weight", weight)
        .withColumn("most", F.col("source_size") * mix.cap)
        .withColumn("level", (F.sum("source_size").over(whole) - capped_before) / weight_left)
        .withColumn("level", F.max("level").over(whole))
        .withColumn("target", F.least(F.col("most").cast("double"), F.col("weight") * F.col("level")))
        .select("source", "source_size", "kind", "target", F.coalesce(F.expr("target / nullif(source_size, 0)"), F.lit(0.0)).alias("rate"))
    )


def mixed(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """(doc_id, text, source, ...) -> (doc_id, source, size, source_size, target, taken, position), every row.

    taken: words, repeats counted, at most ``cap`` times the size; a source's sum is its target rounded down. position:
    0 to 1, null where nothing is taken; the rows are range-sorted by it. A null text has size 0; null sources are one
    source, the last. Rows equal in source, id and size stand for each other: they are counted, not sorted, so that a row
    or a null id that repeats without end does not fill a window. An empty table gives no rows.
    """
    kinds = sized(docs).groupBy("source", "doc_id", "size", "key").agg(F.count("*").alias("copies"))
    rows = checkpointed(kinds.withColumn("bucket", F.substring("key", 1, mix.digits)))
    sources = checkpointed(targets(rows.withColumn("size", F.col("size") * F.col("copies")), mix))
    sums = rows.groupBy("source", "bucket").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rows.withColumn("inside", F.sum(F.col("size") * F.col("copies")).over(inside) - F.col("size") * F.col("copies"))
        .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
        .join(sources.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .withColumn("upto", F.col("start") + F.col("inside") + F.col("nth") * F.col("size"))
        .withColumn("first", F.floor((F.col("upto") - F.col("size")) * F.col("rate")))
        .withColumn("last", F.floor(F.col("upto") * F.col("rate")))
        .withColumn("taken", F.least(F.col("last") - F.col("first"), F.col("size") * mix.cap))
        .withColumn("share", F.expr("(first + last) / 2 / nullif(target, 0)"))
        .withColumn("position", F.expr(f"CASE WHEN taken > 0 THEN {position_sql(mix, 'kind', 'share')} END"))
        .select("doc_id", "source", "size", "source_size", "target", "taken", "position")
    )
    return placed.repartitionByRange("position", "doc_id").sortWithinPartitions("position", "doc_id")


def mixed_documents(docs: DataFrame, mix: Mix = DEFAULT) -> DataFrame:
    """The documents as the mix repeats them, whole, with their own columns, range-sorted by training position.

    A source's rate is split into whole copies and a last one, drawn by a hash of the id (of the text, where the id is null):
    the expected words are the target. Columns may have any names; null texts have size 0, null sources are one source.
    """
    rows = checkpointed(docs.select(F.col("source").cast("string"), F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long").alias("size")).groupBy("source").agg(F.sum("size").alias("size")))
    of, kind, rate, copies, copy, share, position = (fresh(docs, n) for n in ("of", "kind", "rate", "copies", "copy", "share", "position"))
    sources = checkpointed(targets(rows, mix)).select(F.col("source").alias(of), F.col("kind").alias(kind), F.col("rate").alias(rate))
    key = F.md5(F.concat_ws("|", F.col("doc_id").cast("string"), F.when(F.col("doc_id").isNull(), F.md5(F.col("text").cast("string").cast("binary")))).cast("binary"))
    unit = lambda at: F.conv(F.substring(key, at, 8), 16, 10).cast("double") / 2.0**32
    names = [F.col(f"`{n}`") for n in docs.columns]
    return (
        docs.join(sources, docs["source"].cast("string").eqNullSafe(F.col(of)))
        .withColumn(copies, F.floor(F.col(rate) + unit(1)).cast("int"))
        .where(F.col(copies) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
        .withColumn(share, (unit(9) + F.col(copy)) / F.col(copies))
        .withColumn(position, F.expr(position_sql(mix, f"`{kind}`", f"`{share}`")))
        .repartitionByRange(F.col(position), F.col("doc_id"))
        .sortWithinPartitions(F.col(position), F.col("doc_id"))
        .select(*names)
    )


def op9_mixing(spark, sf_dir: str) -> DataFrame:
    """All documents in the mix, as ``mixed`` states it for nulls, empty texts, ties and repeats; other columns are ignored."""
    return mixed(table(spark, sf_dir, "documents")).drop("source")


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS key
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CAST(row_number() OVER (ORDER BY source NULLS LAST) - 1 AS BIGINT) % 3 AS kind,
         row_number() OVER (ORDER BY source NULLS LAST) AS place
  FROM sized GROUP BY source),
levels AS (
  SELECT source, source_size, kind, kind + 1e0 AS weight,
         (CAST(sum(source_size) OVER () AS DOUBLE) - CAST(coalesce(sum(source_size * 3) OVER (
            ORDER BY source_size * 3 / (kind + 1e0), place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / sum(kind + 1e0) OVER (ORDER BY source_size * 3 / (kind + 1e0), place
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources),
targets AS (
  SELECT source, source_size, kind,
         least(CAST(source_size * 3 AS DOUBLE), weight * (SELECT max(level) FROM levels)) AS target
  FROM levels),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.kind, coalesce(t.target / nullif(t.source_size, 0), 0) AS rate,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.doc_id, d.size
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS upto
  FROM sized d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
cut AS (
  SELECT *, CAST(floor((upto - size) * rate) AS BIGINT) AS first, CAST(floor(upto * rate) AS BIGINT) AS last FROM placed),
shares AS (SELECT *, least(last - first, size * 3) AS taken, (first + last) / 2e0 / target AS share FROM cut)
SELECT doc_id, size, source_size, target, CAST(taken AS BIGINT) AS taken,
       CASE WHEN taken > 0 THEN {position_sql(DEFAULT, "kind", "share")} END AS position
FROM shares
"""
