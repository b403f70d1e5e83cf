"""Stand-in views of the engine's entities over the test tables, with the same definition in SQL.

Located events take coordinates from their keys by one rule; times are seconds as DOUBLE.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meridian.sources.readers import read_table


def seconds(ts: Column | str) -> Column:
    """Seconds since 1970 of a TIMESTAMP_NTZ, without a session time zone."""
    name = ts if isinstance(ts, str) else "ts"
    return F.expr(f"timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', {name})") / F.lit(1e6)


def load(name: str):
    return lambda spark, d: read_table(spark, d, name)


def events(spark: SparkSession, d: str) -> DataFrame:
    e = read_table(spark, d, "events")
    return e.withColumn("t", seconds("ts")).withColumn("lat", -60 + (F.col("user_id") * 37 % 1200) / F.lit(10.0) + (F.col("event_id") % 100) / F.lit(1000.0)).withColumn("lon", -180 + (F.col("user_id") * 53 % 3600) / F.lit(10.0) + (F.col("event_id") % 97) / F.lit(1000.0))


EVENTS = "(SELECT *, epoch_us(ts) / 1e6 AS t, -60 + (user_id * 37 % 1200) / 10e0 + (event_id % 100) / 1000e0 AS lat, -180 + (user_id * 53 % 3600) / 10e0 + (event_id % 97) / 1000e0 AS lon FROM events)"


def places(spark: SparkSession, d: str) -> DataFrame:
    """One place a customer of a small number of segments: (place, lat, lon, role)."""
    c = read_table(spark, d, "customer")
    k = F.col("c_custkey")
    return c.select(k.alias("place"), (-60 + (k * 37 % 1200) / F.lit(10.0) + (k % 7) / F.lit(100.0)).alias("lat"), (-180 + (k * 53 % 3600) / F.lit(10.0) + (k % 5) / F.lit(100.0)).alias("lon"), F.col("c_mktsegment").alias("role"), F.col("c_nationkey").alias("nation"))


PLACES = "(SELECT c_custkey AS place, -60 + (c_custkey * 37 % 1200) / 10e0 + (c_custkey % 7) / 100e0 AS lat, -180 + (c_custkey * 53 % 3600) / 10e0 + (c_custkey % 5) / 100e0 AS lon, c_mktsegment AS role, c_nationkey AS nation FROM customer)"


def spans(spark: SparkSession, d: str, kind: str = "view") -> DataFrame:
    """Intervals of one event type: (span_id, user_id, start, stop), up to six hours long."""
    e = events(spark, d).where(F.col("event_type") == kind)
    return e.select(F.col("event_id").alias("span_id"), "user_id", F.col("t").alias("start"), (F.col("t") + F.col("event_id") % 7 * 3600.0).alias("stop"))


def spans_sql(kind: str = "view") -> str:
    return f"(SELECT event_id AS span_id, user_id, t AS start, t + event_id % 7 * 3600e0 AS stop FROM {EVENTS} e WHERE event_type = '{kind}')"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str, radius: float = 6371000.0) -> str:
    return (
        f"{2 * radius!r}e0 * asin(sqrt(least(1e0, sin(radians({lat2} - ({lat1})) / 2) * sin(radians({lat2} - ({lat1})) / 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * sin(radians({lon2} - ({lon1})) / 2) * sin(radians({lon2} - ({lon1})) / 2))))"
    )


def norm_sql(a: str) -> str:
    return f"sqrt(list_sum(list_transform({a}, lambda z: CAST(z AS DOUBLE) * CAST(z AS DOUBLE))))"


def cosine_sql(a: str, b: str) -> str:
    return f"(list_sum(list_transform(list_zip({a}, {b}), lambda z: CAST(z[1] AS DOUBLE) * CAST(z[2] AS DOUBLE))) / ({norm_sql(a)} * {norm_sql(b)}))"
