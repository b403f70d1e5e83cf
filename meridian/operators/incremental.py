"""Incremental work: change detection, leases, queues, health snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridian.functions.exprs import text_hash


def changed(items: DataFrame, state: DataFrame, key: str, text: str, stored: str = "content_hash") -> DataFrame:
    """items + (hash, change): rows that are new or whose text differs from the stored hash."""
    have = state.select(F.col(key), F.col(stored).alias("__h"))
    rows = items.withColumn("hash", text_hash(F.coalesce(F.col(text), F.lit("")))).join(have, key, "left")
    return rows.where(F.col("__h").isNull() | (F.col("__h") != F.col("hash"))).withColumn("change", F.when(F.col("__h").isNull(), "new").otherwise("changed")).drop("__h")


def not_done(items: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return items.join(done.select(*key).distinct(), key, "left_anti")


def needs_ingest(status: DataFrame) -> Column:
    """Missing sources, no start time, no segments, or more than half of them without vectors."""
    n = F.coalesce(F.col("segments"), F.lit(0))
    return F.col("source").isNull() | F.col("started_at").isNull() | (n == 0) | (F.coalesce(F.col("without_vectors"), F.lit(0)) * 2 > n)


def claimable(jobs: DataFrame, now_ms: int, ttl_ms: int) -> Column:
    """No owner, or a lease that ran out; jobs without an owner and a time count as free."""
    return (F.coalesce(F.col("owner"), F.lit("")) == "") | (F.coalesce(F.col("claimed_at"), F.lit(0)) + ttl_ms < now_ms)


def claimed(jobs: DataFrame, wanted: DataFrame, owner: str, now_ms: int, ttl_ms: int) -> DataFrame:
    """The table after one owner asks for the keys in ``wanted``: free or expired ones become its own."""
    hit = jobs.join(wanted.select("key").distinct().withColumn("__w", F.lit(True)), "key", "left")
    take = F.coalesce(F.col("__w"), F.lit(False)) & claimable(jobs, now_ms, ttl_ms)
    return hit.withColumn("__t", take).withColumn("owner", F.when(F.col("__t"), F.lit(owner)).otherwise(F.col("owner"))).withColumn("claimed_at", F.when(F.col("__t"), F.lit(now_ms)).otherwise(F.col("claimed_at"))).withColumn("status", F.when(F.col("__t"), "running").otherwise(F.col("status"))).drop("__w", "__t")


def released(jobs: DataFrame, key: str, owner: str, status: str = "done") -> DataFrame:
    """Only the owner's release takes effect."""
    own = (F.col("key") == key) & (F.col("owner") == owner)
    return jobs.withColumn("__o", F.coalesce(own, F.lit(False))).withColumn("owner", F.when(F.col("__o"), "").otherwise(F.col("owner"))).withColumn("status", F.when(F.col("__o"), status).otherwise(F.col("status"))).drop("__o")


def live_claims(jobs: DataFrame, now_ms: int, ttl_ms: int) -> DataFrame:
    return jobs.where(~claimable(jobs, now_ms, ttl_ms))


def _first(rows: DataFrame, wanted: DataFrame, key: str, order: list[Column], most: int, out: str) -> DataFrame:
    """rows with ``out`` true for the first ``most`` of the wanted ones, by key, which must be unique; false for others."""
    few = wanted.orderBy(*order).limit(most).select(F.col(key).alias("__k"))
    return rows.join(few, F.col(key) == F.col("__k"), "left").withColumn(out, F.col("__k").isNotNull()).drop("__k")


def reaped(jobs: DataFrame, now_ms: int, ttl_ms: int, most: int | None = None) -> DataFrame:
    """The table with expired leases freed, the oldest ``most`` of them."""
    gone = (F.coalesce(F.col("owner"), F.lit("")) != "") & claimable(jobs, now_ms, ttl_ms)
    rows = jobs.withColumn("__g", gone)
    if most is not None:
        rows = _first(rows, rows.where("__g"), "key", [F.col("claimed_at").asc_nulls_first(), F.col("key")], most, "__g")
    return rows.withColumn("owner", F.when(F.col("__g"), "").otherwise(F.col("owner"))).withColumn("status", F.when(F.col("__g"), "pending").otherwise(F.col("status"))).drop("__g")


def stage_done(jobs: DataFrame, key: str, stage: str, last: str) -> DataFrame:
    """The stage set in the job's map; the last stage ends the job."""
    mine = F.col("key") == key
    stages = F.map_concat(F.map_filter("stages", lambda k, v: k != stage), F.create_map(F.lit(stage), F.lit(True)))
    status = F.lit("done") if stage == last else F.col("status")
    return jobs.withColumn("stages", F.when(mine, stages).otherwise(F.col("stages"))).withColumn("status", F.when(mine, status).otherwise(F.col("status")))


def queue_step(tasks: DataFrame, frm: str, to: str, most: int | None = None) -> DataFrame:
    """Tasks of one state, best priority first, move to the next state."""
    rows = tasks.withColumn("__m", F.col("status") == frm)
    if most is not None:
        rows = _first(rows, rows.where("__m"), "id", [F.col("priority").desc(), F.col("id")], most, "__m")
    return rows.withColumn("status", F.when(F.col("__m"), to).otherwise(F.col("status"))).drop("__m")


def valid_step(order: list[str], frm: Column, to: Column, forced: Column) -> Column:
    """Only the next state is allowed, unless forced."""
    states = F.array(*[F.lit(s) for s in order])
    return forced | (F.array_position(states, to) == F.array_position(states, frm) + 1)


def stalled(now: DataFrame, before: DataFrame, key: str, value: str) -> DataFrame:
    """(key, value, before, stalled): whether a count stands where it stood in the snapshot before."""
    return now.join(before.select(key, F.col(value).alias("before")), key, "left").withColumn("stalled", F.coalesce(F.col(value) <= F.col("before"), F.lit(False)))


def since(df: DataFrame, day: str, first_day: str) -> DataFrame:
    """Rows of the trailing window to compute again; their partitions are then overwritten."""
    return df.where(F.col(day) >= F.lit(first_day))
