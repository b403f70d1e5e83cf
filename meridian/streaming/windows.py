"""Watermarked windows, idempotent ingest and replayable sinks over streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.operators.upsert import latest, upsert
from meridian.sources.writers import exists


def tumbling(events: DataFrame, ts: str, width: str, late: str, by: list[str] = (), slide: str | None = None) -> DataFrame:
    """(by.., start, stop, n, total) of tumbling or sliding windows; rows later than the watermark are dropped by a stream."""
    w = F.window(ts, width, slide) if slide else F.window(ts, width)
    sums = events.withWatermark(ts, late).groupBy(w, *by).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return sums.select(*by, F.col("window.start").alias("start"), F.col("window.end").alias("stop"), "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, late: str, by: list[str]) -> DataFrame:
    sums = events.withWatermark(ts, late).groupBy(F.session_window(ts, gap).alias("window"), *by).agg(F.count("*").alias("n"))
    return sums.select(*by, F.col("window.start").alias("start"), F.col("window.end").alias("stop"), "n")


def deduplicated(messages: DataFrame, keys: list[str], ts: str, late: str) -> DataFrame:
    """Each key once within the watermark: an idempotent ingest."""
    return messages.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


def read_messages(spark: SparkSession, path: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """JSON lines as a stream; the query's checkpoint takes the place of a cursor file."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def upsert_sink(spark: SparkSession, target: str, keys: list[str], order: str, buckets: int = 64):
    """A writer function for foreachBatch that merges each batch by key into a Parquet table.

    The table is partitioned by a hash of the keys; a batch rewrites the buckets it touches and no others. A key's last row
    by ``order`` counts, and rows older than the stored one are left out. Merging a batch again gives the same table, so a
    replay after a lost executor or driver does no harm.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = latest(batch, keys, [F.col(order).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in batch.columns if c not in (order, *keys)]])
        new = rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).persist()
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        if touched and exists(spark, target):
            base = spark.read.schema(new.schema).parquet(target).where(F.col("bucket").isin(touched))
            held = base.select(*[F.col(k).alias(f"__{k}") for k in keys], F.col(order).alias("__order"))
            same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            late = new.join(held, reduce(lambda a, b: a & b, same) & (F.col(order) < F.col("__order")), "left_anti")
            merged = upsert(base, late, [*keys, "bucket"]).select(*new.columns)
        else:
            merged = new
        merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)
        new.unpersist()

    return merge


def run_available(stream: DataFrame, merge, checkpoint: str) -> None:
    """All that is there, then stop: a catch-up run that resumes from its checkpoint."""
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def sweep(stream: DataFrame, merge, checkpoint: str, every: str = "900 seconds"):
    """A query that runs over what has come, every so often, until it is stopped."""
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
