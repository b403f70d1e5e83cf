"""Nearest-in-time, nearest-place and interval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import intervals, nearest
from meridian.plans.base import EVENTS, PLACES, events, haversine_sql, places, spans, spans_sql
from meridian.plans.registry import register

HOUR = 3600.0
VIEWS = f"(SELECT event_id, user_id, t FROM {EVENTS} e WHERE event_type = 'view')"
BUYS = f"(SELECT event_id AS buy_id, user_id, t FROM {EVENTS} e WHERE event_type = 'purchase')"


def _of(s, d, kind):
    return events(s, d).where(F.col("event_type") == kind)


@register("nearest_time_join", f"""WITH c AS (SELECT v.event_id, b.buy_id, abs(v.t - b.t) AS d FROM {VIEWS} v JOIN {BUYS} b ON v.user_id = b.user_id AND abs(v.t - b.t) <= {6 * HOUR}),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, buy_id) AS n FROM c)
 SELECT v.event_id, r.buy_id AS match_id, round(r.d, 3) AS delta FROM {VIEWS} v LEFT JOIN r ON r.event_id = v.event_id AND r.n = 1""")
def nearest_time_join(s, d):
    left = _of(s, d, "view").select("event_id", "user_id", "t")
    right = _of(s, d, "purchase").select(F.col("event_id").alias("buy_id"), "user_id", "t")
    return nearest.nearest_time(left, right, "event_id", "buy_id", "t", "t", 6 * HOUR, ["user_id"]).select("event_id", "match_id", F.round("delta", 3).alias("delta"))


@register("nearest_time_offsets", f"""WITH o(x) AS (VALUES (0e0), (3600e0), (-3600e0)), c AS (SELECT v.event_id, b.buy_id, abs(v.t + x - b.t) AS d FROM {VIEWS} v, o, {BUYS} b WHERE v.user_id = b.user_id AND abs(v.t + x - b.t) <= {2 * HOUR}),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, buy_id) AS n FROM c)
 SELECT event_id, buy_id AS match_id, round(d, 3) AS delta FROM r WHERE n = 1""")
def nearest_time_offsets(s, d):
    left = _of(s, d, "view").select("event_id", "user_id", "t")
    right = _of(s, d, "purchase").select(F.col("event_id").alias("buy_id"), "user_id", "t")
    got = nearest.nearest_time(left, right, "event_id", "buy_id", "t", "t", 2 * HOUR, ["user_id"], (0.0, 3600.0, -3600.0), keep_all=False)
    return got.select("event_id", "match_id", F.round("delta", 3).alias("delta"))


@register("confidence_tiers", f"""WITH c AS (SELECT v.event_id, abs(v.t - b.t) AS d FROM {VIEWS} v JOIN {BUYS} b ON v.user_id = b.user_id AND abs(v.t - b.t) <= {6 * HOUR}),
 r AS (SELECT event_id, min(d) AS d FROM c GROUP BY event_id)
 SELECT CASE WHEN d IS NULL THEN NULL WHEN d <= 3600 THEN 1e0 WHEN d <= 7200 THEN 0.8e0 WHEN d <= 14400 THEN 0.6e0 ELSE 0.4e0 END AS confidence, count(*) AS n
 FROM {VIEWS} v LEFT JOIN r ON r.event_id = v.event_id GROUP BY 1""")
def confidence_tiers(s, d):
    left = _of(s, d, "view").select("event_id", "user_id", "t")
    right = _of(s, d, "purchase").select(F.col("event_id").alias("buy_id"), "user_id", "t")
    got = nearest.nearest_time(left, right, "event_id", "buy_id", "t", "t", 6 * HOUR, ["user_id"])
    return got.groupBy(nearest.confidence(F.col("delta")).alias("confidence")).agg(F.count("*").alias("n"))


@register("hour_bucket_nearest", f"""WITH h AS (SELECT user_id, CAST(floor(t / 3600) AS BIGINT) AS hour, min(event_id) AS first_buy FROM {EVENTS} e WHERE event_type = 'purchase' GROUP BY 1, 2),
 c AS (SELECT v.event_id, h.hour - CAST(floor(v.t / 3600) AS BIGINT) AS o, first_buy FROM {VIEWS} v JOIN h ON h.user_id = v.user_id AND abs(h.hour - CAST(floor(v.t / 3600) AS BIGINT)) <= 6),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY abs(o), o) AS n FROM c)
 SELECT v.event_id, CAST(r.o AS INTEGER) AS bucket_offset, r.first_buy FROM {VIEWS} v LEFT JOIN r ON r.event_id = v.event_id AND r.n = 1""")
def hour_bucket_nearest(s, d):
    left = _of(s, d, "view").select("event_id", "user_id", "t")
    hours = _of(s, d, "purchase").groupBy("user_id", F.floor(F.col("t") / HOUR).cast("long").alias("hour")).agg(F.min("event_id").alias("first_buy"))
    return nearest.nearest_bucket(left, hours, "event_id", "t", "hour", HOUR, 6, ["first_buy"], ["user_id"]).select("event_id", "bucket_offset", "first_buy")


@register("nearest_frame_tiers", f"""WITH a AS (SELECT event_id, user_id, event_id AS frame FROM {EVENTS} e WHERE event_type = 'click'), b AS (SELECT user_id, event_id AS frame FROM {EVENTS} e WHERE event_type = 'error'),
 c AS (SELECT a.event_id, b.frame, abs(a.frame - b.frame) AS d FROM a JOIN b ON a.user_id = b.user_id AND abs(a.frame - b.frame) <= 300),
 r AS (SELECT *, CASE WHEN d <= 10 THEN 0 WHEN d <= 30 THEN 1 ELSE 2 END AS tier, row_number() OVER (PARTITION BY event_id ORDER BY CASE WHEN d <= 10 THEN 0 WHEN d <= 30 THEN 1 ELSE 2 END, d, frame) AS n FROM c)
 SELECT a.event_id, r.frame AS match_frame, r.tier FROM a LEFT JOIN r ON r.event_id = a.event_id AND r.n = 1""")
def nearest_frame_tiers(s, d):
    a = _of(s, d, "click").select("event_id", "user_id", F.col("event_id").alias("frame"))
    b = _of(s, d, "error").select("user_id", F.col("event_id").alias("frame"))
    return nearest.nearest_frame(a, b, "event_id", "user_id", "frame", 10).select("event_id", "match_frame", "tier")


_NEAR = f"(SELECT e.event_id, p.place, {haversine_sql('e.lat', 'e.lon', 'p.lat', 'p.lon')} AS m FROM (SELECT event_id, lat, lon FROM {EVENTS} x WHERE event_type = 'view') e JOIN {PLACES} p ON abs(e.lat - p.lat) <= 0.2)"


@register("nearest_place", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY m, place) AS n FROM {_NEAR} x WHERE m <= 8000)
 SELECT event_id, place, round(m, 1) AS metres FROM r WHERE n = 1""")
def nearest_place(s, d):
    got = nearest.nearest_place(_of(s, d, "view"), places(s, d), "event_id", "place", 8000.0)
    return got.select("event_id", "place", F.round("metres", 1).alias("metres"))


@register("within_radius_capped", f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY m, place) AS n FROM {_NEAR} x WHERE m <= 12000)
 SELECT event_id, place, round(m, 1) AS metres, CAST(n AS INTEGER) AS nth FROM r WHERE n <= 5""")
def within_radius_capped(s, d):
    return nearest.within_radius_capped(_of(s, d, "view"), places(s, d), "event_id", "place", 12000.0).withColumn("metres", F.round("metres", 1))


@register("nearest_of_few", f"""WITH n AS (SELECT nation AS region_id, avg(lat) AS lat, avg(lon) AS lon FROM {PLACES} p GROUP BY nation),
 c AS (SELECT e.event_id, n.region_id, {haversine_sql('e.lat', 'e.lon', 'n.lat', 'n.lon', 3959.0)} AS d FROM {EVENTS} e, n WHERE e.event_type = 'click'),
 r AS (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY d, region_id) AS k FROM c WHERE d <= 2500)
 SELECT event_id, region_id, round(d, 3) AS distance FROM r WHERE k = 1""")
def nearest_of_few(s, d):
    few = places(s, d).groupBy(F.col("nation").alias("region_id")).agg(F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    got = nearest.nearest_of_few(_of(s, d, "click"), few, "event_id", "region_id", 2500.0, X.EARTH_MILES)
    return got.select("event_id", "region_id", F.round("distance", 3).alias("distance"))


_HALF = X.half_extent(2_000_000.0, -40.0)
_BOX = (-40.0 - _HALF[0], -40.0 + _HALF[0], 20.0 - _HALF[1], 20.0 + _HALF[1])
_BOX_SQL = f"lat BETWEEN {_BOX[0]!r} AND {_BOX[1]!r} AND lon BETWEEN {_BOX[2]!r} AND {_BOX[3]!r}"


@register("geo_radius", f"""SELECT event_id, user_id, round(m, 1) AS metres FROM (SELECT event_id, user_id, value, {haversine_sql('lat', 'lon', '-40e0', '20e0')} AS m FROM {EVENTS} e WHERE {_BOX_SQL} AND value >= 5) x
 WHERE m <= 2000000 ORDER BY m, event_id LIMIT 50""")
def geo_radius(s, d):
    e = events(s, d).where(X.in_box(F.col("lat"), F.col("lon"), _BOX) & (F.col("value") >= 5))
    m = X.haversine(F.col("lat"), F.col("lon"), -40.0, 20.0)
    return e.withColumn("m", m).where("m <= 2000000").orderBy("m", "event_id").limit(50).select("event_id", "user_id", F.round("m", 1).alias("metres"))


@register("interval_contains", f"""SELECT c.event_id, s.span_id FROM {EVENTS} c JOIN {spans_sql('view')} s ON c.user_id = s.user_id AND c.t BETWEEN s.start AND s.stop WHERE c.event_type = 'click'""")
def interval_contains(s, d):
    points = _of(s, d, "click").select("event_id", "user_id", "t")
    return intervals.containment_join(points, spans(s, d), "t", "start", "stop", 6 * HOUR, ["user_id"]).select("event_id", "span_id")


def _two_spans(s, d):
    a = spans(s, d, "view").select(F.col("span_id").alias("a_id"), "user_id", F.col("start").alias("a0"), F.col("stop").alias("a1"))
    b = spans(s, d, "purchase").select(F.col("span_id").alias("b_id"), "user_id", F.concat(F.lit("k"), (F.col("span_id") % 5).cast("string")).alias("label"), F.col("start").alias("b0"), F.col("stop").alias("b1"))
    return a, b


_PAIRS = f"""(SELECT a.span_id AS a_id, b.span_id AS b_id, 'k' || (b.span_id % 5) AS label, a.start AS a0, a.stop AS a1, b.start AS b0, b.stop AS b1
  FROM {spans_sql('view')} a JOIN {spans_sql('purchase')} b ON a.user_id = b.user_id AND a.start <= b.stop AND a.stop >= b.start)"""


@register("interval_overlap", f"SELECT a_id, b_id FROM {_PAIRS} p")
def interval_overlap(s, d):
    a, b = _two_spans(s, d)
    return intervals.overlap_join(a, b, ("a0", "a1"), ("b0", "b1"), 6 * HOUR, ["user_id"]).select("a_id", "b_id")


@register("interval_overlap_strict", f"SELECT a_id, b_id FROM {_PAIRS} p WHERE a0 < b1 AND a1 > b0")
def interval_overlap_strict(s, d):
    a, b = _two_spans(s, d)
    return intervals.overlap_join(a, b, ("a0", "a1"), ("b0", "b1"), 6 * HOUR, ["user_id"], strict=True).select("a_id", "b_id")


@register("overlap_apportion", f"""WITH o AS (SELECT a_id, label, sum(greatest(0, least(a1, b1) - greatest(a0, b0))) AS seconds FROM {_PAIRS} p GROUP BY 1, 2),
 s AS (SELECT *, seconds / sum(seconds) OVER (PARTITION BY a_id) AS share, row_number() OVER (PARTITION BY a_id ORDER BY seconds DESC, label) = 1 AS dominant FROM o WHERE seconds > 0)
 SELECT a_id, label, round(seconds, 3) AS seconds, round(share, 6) AS share, dominant FROM s WHERE share >= 0.05""")
def overlap_apportion(s, d):
    a, b = _two_spans(s, d)
    pairs = intervals.overlap_join(a, b, ("a0", "a1"), ("b0", "b1"), 6 * HOUR, ["user_id"])
    out = intervals.apportion(pairs, ["a_id"], "label", ("a0", "a1"), ("b0", "b1"))
    return out.select("a_id", "label", F.round("seconds", 3).alias("seconds"), F.round("share", 6).alias("share"), "dominant")


@register("max_overlap", f"""WITH o AS (SELECT a_id, label, sum(greatest(0, least(a1, b1) - greatest(a0, b0))) AS seconds FROM {_PAIRS} p GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY seconds DESC, label) AS n FROM o WHERE seconds > 0)
 SELECT a.span_id AS a_id, coalesce(r.label, 'UNKNOWN') AS label FROM {spans_sql('view')} a LEFT JOIN r ON r.a_id = a.span_id AND r.n = 1""")
def max_overlap(s, d):
    a, b = _two_spans(s, d)
    pairs = intervals.overlap_join(a, b, ("a0", "a1"), ("b0", "b1"), 6 * HOUR, ["user_id"])
    return intervals.best_overlap(a, pairs, ["a_id"], "label", ("a0", "a1"), ("b0", "b1")).select("a_id", "label")


@register("midpoint_assign", f"""SELECT s.span_id, string_agg(CAST(c.event_id AS VARCHAR), ' ' ORDER BY c.t, c.event_id) AS text
 FROM {spans_sql('view')} s JOIN {EVENTS} c ON c.user_id = s.user_id AND c.t + 30 BETWEEN s.start AND s.stop WHERE c.event_type = 'click' GROUP BY s.span_id""")
def midpoint_assign(s, d):
    words = _of(s, d, "click").select("event_id", "user_id", F.col("t").alias("w0"), (F.col("t") + 30).alias("mid"))
    hits = intervals.containment_join(words, spans(s, d), "mid", "start", "stop", 6 * HOUR, ["user_id"])
    ordered = F.sort_array(F.collect_list(F.struct("w0", "event_id")))
    return hits.groupBy("span_id").agg(F.array_join(F.transform(ordered, lambda x: x["event_id"].cast("string")), " ").alias("text"))


@register("clip_to_window", f"""WITH b AS (SELECT min(t) + 864000e0 AS lo FROM {EVENTS} e) SELECT span_id, round(greatest(start, lo) - lo, 3) AS start, round(least(stop, lo + 86400) - lo, 3) AS stop
 FROM {spans_sql('view')} s, b WHERE start < lo + 86400 AND stop > lo AND least(stop, lo + 86400) > greatest(start, lo)""")
def clip_to_window(s, d):
    lo = (events(s, d).agg(F.min("t").alias("m")).first().m or 0.0) + 864000.0
    out = intervals.clip_to_window(spans(s, d).select("span_id", "start", "stop"), "start", "stop", lo, lo + 86400)
    return out.select("span_id", F.round("start", 3).alias("start"), F.round("stop", 3).alias("stop"))
