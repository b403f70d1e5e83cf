"""Sessions, chains, fills and other ordered sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import intervals, sequence
from meridian.plans.base import EVENTS, cosine_sql, events, haversine_sql, load, spans, spans_sql
from meridian.plans.registry import register
from meridian.streaming import detection

DAY = 86400.0
LI = load("lineitem")


def _sessions_sql(flag: str) -> str:
    return f"""WITH f AS (SELECT span_id, user_id, start, {flag} AS new FROM {spans_sql('view')} s)
 SELECT span_id, user_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY start, span_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS session FROM f"""


@register("gap_sessions", _sessions_sql("CASE WHEN start - lag(stop) OVER (PARTITION BY user_id ORDER BY start, span_id) > 43200 THEN 1 ELSE 0 END"))
def gap_sessions(s, d):
    return intervals.gap_sessions(spans(s, d), ["user_id"], "start", "stop", DAY / 2, ["span_id"]).select("span_id", "user_id", "session")


@register("merge_sessions", _sessions_sql("CASE WHEN start - max(stop) OVER (PARTITION BY user_id ORDER BY start, span_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 43200 THEN 1 ELSE 0 END"))
def merge_sessions(s, d):
    return intervals.merged_sessions(spans(s, d), ["user_id"], "start", "stop", DAY / 2, ["span_id"]).select("span_id", "user_id", "session")


@register("anchored_sessions", f"""WITH RECURSIVE o AS (SELECT span_id, user_id, start, row_number() OVER (PARTITION BY user_id ORDER BY start, span_id) AS n FROM {spans_sql('view')} s),
 w AS (SELECT span_id, user_id, start, n, start AS anchor, 0 AS session FROM o WHERE n = 1
   UNION ALL SELECT o.span_id, o.user_id, o.start, o.n, CASE WHEN o.start - w.anchor > {3 * DAY} THEN o.start ELSE w.anchor END, CASE WHEN o.start - w.anchor > {3 * DAY} THEN w.session + 1 ELSE w.session END
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1)
 SELECT span_id, user_id, session FROM w""")
def anchored_sessions(s, d):
    return sequence.anchored_sessions(spans(s, d), ["user_id"], "start", 3 * DAY, ["span_id"]).select("span_id", "user_id", "session")


@register("next_chain", f"""SELECT * FROM (SELECT user_id, event_id AS src, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS dst FROM events) x WHERE dst IS NOT NULL""")
def next_chain(s, d):
    return sequence.next_chain(events(s, d), ["user_id"], ["ts", "event_id"], "event_id")


@register("daily_chain", "SELECT * FROM (SELECT day AS src, lead(day) OVER (ORDER BY day) AS dst FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events) y) x WHERE dst IS NOT NULL")
def daily_chain(s, d):
    days = events(s, d).select(F.to_date("ts").cast("string").alias("day")).distinct()
    return sequence.next_chain(days, [], ["day"], "day")


@register("row_delta_check", f"""WITH e AS (SELECT event_id, user_id, ts, value, event_id % 50 AS v2, lag(value) OVER w AS pv, lag(event_id % 50) OVER w AS p2 FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
 SELECT event_id, concat_ws(',', CASE WHEN abs(value - pv) > 10 THEN 'lat jump' END, CASE WHEN abs(v2 - p2) > 10 THEN 'lon jump' END) AS problems FROM e""")
def row_delta_check(s, d):
    e = events(s, d).select("event_id", "user_id", "ts", F.col("value").cast("string").alias("a"), (F.col("event_id") % 50).cast("string").alias("b"))
    return sequence.row_checks(e, ["user_id"], ["ts", "event_id"], "a", "b", 10.0).select("event_id", F.array_join("problems", ",").alias("problems"))


@register("forward_fill", """SELECT event_id, coalesce(last_value(CASE WHEN event_id % 3 <> 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING), value) AS value FROM events""")
def forward_fill(s, d):
    e = events(s, d)
    return sequence.forward_fill(e, ["user_id"], ["ts", "event_id"], ["value"], lambda v: F.col("event_id") % 3 != 0).select("event_id", "value")


@register("interpolate_runs", """WITH r AS (SELECT event_id, user_id, row_number() OVER w AS n, CASE WHEN event_id % 3 = 0 THEN CAST(round(value) AS DOUBLE) END AS v FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 k AS (SELECT *, last_value(v IGNORE NULLS) OVER b AS pv, last_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER b AS pn, first_value(v IGNORE NULLS) OVER a AS nv, first_value(CASE WHEN v IS NOT NULL THEN n END IGNORE NULLS) OVER a AS nn FROM r
   WINDOW b AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), a AS (PARTITION BY user_id ORDER BY n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 x AS (SELECT *, CASE WHEN pn IS NOT NULL AND nn IS NOT NULL AND nn <> pn THEN pv + (nv - pv) * (n - pn) / (nn - pn) END AS y FROM k)
 SELECT event_id, CASE WHEN v IS NOT NULL THEN v WHEN y IS NOT NULL THEN round_even(y, 0) ELSE coalesce(pv, nv, 0) END AS filled FROM x""")
def interpolate_runs(s, d):
    e = events(s, d).withColumn("v", F.when(F.col("event_id") % 3 == 0, F.round("value")))
    return sequence.interpolate(e, ["user_id"], ["ts", "event_id"], "v").select("event_id", "filled")


@register("every_nth", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS n FROM events) x WHERE n % 5 = 0")
def every_nth(s, d):
    return sequence.every_nth(events(s, d), ["user_id"], ["ts", "event_id"], 5).select("event_id")


@register("dead_air", f"""SELECT user_id, round(coalesce(max(greatest(0, start - m)), 0), 3) AS dead_air FROM (
  SELECT user_id, start, max(stop) OVER (PARTITION BY user_id ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {spans_sql('view')} s) x GROUP BY user_id""")
def dead_air(s, d):
    return intervals.dead_air(spans(s, d), ["user_id"], "start", "stop").withColumn("dead_air", F.round("dead_air", 3))


@register("out_of_order", f"""SELECT user_id, count(*) FILTER (start < m) AS out_of_order FROM (
  SELECT user_id, start, max(stop) OVER (PARTITION BY user_id ORDER BY span_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM {spans_sql('view')} s) x GROUP BY user_id""")
def out_of_order(s, d):
    return intervals.out_of_order(spans(s, d), ["user_id"], "span_id", "start", "stop")


@register("chunk_plan", """WITH x AS (SELECT event_id, value * 10 AS dur FROM events), k AS (SELECT event_id, dur, unnest(range(0, greatest(0, CAST(ceil(dur / 60e0) AS BIGINT) - 1) + 1)) AS chunk FROM x)
 SELECT event_id, CAST(chunk AS INTEGER) AS chunk, chunk * 60e0 AS chunk_start, least(dur, chunk * 60e0 + 63e0) AS chunk_stop FROM k""")
def chunk_plan(s, d):
    e = events(s, d).select("event_id", (F.col("value") * 10).alias("dur"))
    return intervals.chunk_plan(e, "dur").select("event_id", "chunk", "chunk_start", "chunk_stop")


@register("chunk_overlap_merge", """SELECT event_id, chunk * 60e0 + value AS start, chunk * 60e0 + value + 1 AS stop FROM (SELECT event_id, event_id % 4 AS chunk, value FROM events) x WHERE chunk = 0 OR value + 1 > 3""")
def chunk_overlap_merge(s, d):
    e = events(s, d).select("event_id", (F.col("event_id") % 4).alias("chunk"), F.col("value").alias("start"), (F.col("value") + 1).alias("stop"))
    return intervals.merge_chunks(e, "chunk", "start", "stop").select("event_id", "start", "stop")


@register("word_chunks", r"""WITH w AS (SELECT doc_id, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM documents),
 c AS (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 64) + 1, 192)) AS s FROM w WHERE len(w) > 0)
 SELECT doc_id, CAST((s - 1) // 192 AS INTEGER) AS chunk, md5(array_to_string(w[s:s + 255], ' ')) AS digest FROM c""")
def word_chunks(s, d):
    got = sequence.chunks_of_words(load("documents")(s, d).select("doc_id", "text"), "text")
    return got.select("doc_id", "chunk", F.md5("chunk_text").alias("digest"))


@register("words_with_timing", r"""WITH w AS (SELECT conv_id, turn, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS w FROM conversations),
 l AS (SELECT *, list_transform(w, lambda x: length(x)) AS n FROM w), e AS (SELECT conv_id, turn, unnest(range(0, len(w))) AS pos, w, n FROM l)
 SELECT conv_id, turn, CAST(pos AS INTEGER) AS pos, w[pos + 1] AS word, round(10e0 * coalesce(list_sum(n[1:pos]), 0) / list_sum(n), 6) AS word_start, round(10e0 * (coalesce(list_sum(n[1:pos]), 0) + n[pos + 1]) / list_sum(n), 6) AS word_stop FROM e""")
def words_with_timing(s, d):
    c = load("conversations")(s, d).withColumn("a", F.lit(0.0)).withColumn("b", F.lit(10.0))
    got = intervals.words_with_timing(c, "text", "a", "b")
    return got.select("conv_id", "turn", "pos", "word", F.round("word_start", 6).alias("word_start"), F.round("word_stop", 6).alias("word_stop"))


@register("speed_gate", f"""WITH RECURSIVE o AS (SELECT event_id, user_id, t, value, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM {EVENTS} e WHERE event_type = 'view'),
 w AS (SELECT event_id, user_id, n, t AS kt, value AS kv, true AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.event_id, o.user_id, o.n, CASE WHEN ok THEN o.t ELSE w.kt END, CASE WHEN ok THEN o.value ELSE w.kv END, ok
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1, LATERAL (SELECT o.t > w.kt AND abs(o.value - w.kv) / (o.t - w.kt) * 3600 <= 0.5 AS ok) k)
 SELECT event_id, kept FROM w""")
def speed_gate(s, d):
    def step(last, row):
        ok = last is None or (row["t"] > last["t"] and abs(row["value"] - last["value"]) / (row["t"] - last["t"]) * 3600 <= 0.5)
        return (row, True) if ok else (last, False)

    e = events(s, d).where("event_type = 'view'").select("event_id", "user_id", "t", "value")
    return sequence.sequential(e, ["user_id"], ["t", "event_id"], step, "kept", "boolean").select("event_id", "kept")


_FIXES = f"o AS (SELECT event_id, user_id, t, lat, lon, value, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS n FROM {EVENTS} e)"
_METRES = haversine_sql("w.la", "w.lo", "o.lat", "o.lon")


@register("gps_speed_gate", f"""WITH RECURSIVE {_FIXES},
 w AS (SELECT event_id, user_id, n, t AS kt, lat AS la, lon AS lo, true AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.event_id, o.user_id, o.n, CASE WHEN ok THEN o.t ELSE w.kt END, CASE WHEN ok THEN o.lat ELSE w.la END, CASE WHEN ok THEN o.lon ELSE w.lo END, ok
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1, LATERAL (SELECT o.t > w.kt AND {_METRES} / (o.t - w.kt) <= 0.5 AS ok) k)
 SELECT event_id, kept FROM w""")
def gps_speed_gate(s, d):
    e = events(s, d).select("event_id", "user_id", "t", "lat", "lon")
    return sequence.speed_gate(e, ["user_id"], ["t", "event_id"], "t", "lat", "lon", 0.5).select("event_id", "kept")


@register("plausible_fixes", f"""WITH RECURSIVE {_FIXES},
 w AS (SELECT event_id, user_id, n, CASE WHEN value BETWEEN 0 AND 60 THEN lat END AS la, CASE WHEN value BETWEEN 0 AND 60 THEN lon END AS lo, value BETWEEN 0 AND 60 AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.event_id, o.user_id, o.n, CASE WHEN ok THEN o.lat ELSE w.la END, CASE WHEN ok THEN o.lon ELSE w.lo END, ok
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1, LATERAL (SELECT o.value BETWEEN 0 AND 60 AND (w.la IS NULL OR {_METRES} <= 8000) AS ok) k)
 SELECT event_id, kept FROM w""")
def plausible_fixes(s, d):
    e = events(s, d).select("event_id", "user_id", "t", "lat", "lon", F.col("value").alias("mph"))
    return sequence.plausible_fixes(e, ["user_id"], ["t", "event_id"], "lat", "lon", "mph", 8000.0, 60.0).select("event_id", "kept")


@register("spacing_filter", f"""WITH RECURSIVE o AS (SELECT event_id, user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY md5(CAST(event_id AS VARCHAR)), event_id) AS n FROM {EVENTS} e WHERE event_type = 'click'),
 w AS (SELECT event_id, user_id, n, t + 6 AS stop, 1 AS k, true AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.event_id, o.user_id, o.n, CASE WHEN ok THEN o.t + 6 ELSE w.stop END, CASE WHEN ok THEN w.k + 1 ELSE w.k END, ok
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1, LATERAL (SELECT w.k < 4 AND o.t >= w.stop + 8 AS ok) x)
 SELECT event_id, kept FROM w""")
def spacing_filter(s, d):
    e = events(s, d).where("event_type = 'click'").select("event_id", "user_id", "t", F.md5(F.col("event_id").cast("string")).alias("shuffled"))
    return sequence.spacing_filter(e, ["user_id"], ["shuffled", "event_id"], "t", 6.0, 8.0, 4).select("event_id", "kept")


@register("greedy_suppression", f"""WITH RECURSIVE o AS (SELECT event_id, user_id, t, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM {EVENTS} e),
 w AS (SELECT event_id, user_id, n, [t] AS kept_at, true AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.event_id, o.user_id, o.n, CASE WHEN ok THEN list_append(w.kept_at, o.t) ELSE w.kept_at END, ok
   FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1, LATERAL (SELECT len(w.kept_at) < 5 AND list_min(list_transform(w.kept_at, lambda x: abs(x - o.t))) >= {DAY!r}e0 AS ok) k)
 SELECT event_id, kept FROM w""")
def greedy_suppression(s, d):
    e = events(s, d).select("event_id", "user_id", "t", "value")
    return sequence.suppressed(e, ["user_id"], "value", "t", "event_id", DAY, 5).select("event_id", "kept")


@register("consecutive_distinct", f"""WITH RECURSIVE o AS (SELECT vec_id, label, embedding AS v, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS n FROM embeddings),
 w AS (SELECT vec_id, label, n, v, true AS kept FROM o WHERE n = 1
   UNION ALL SELECT o.vec_id, o.label, o.n, CASE WHEN ok THEN o.v ELSE w.v END, ok FROM w JOIN o ON o.label = w.label AND o.n = w.n + 1, LATERAL (SELECT {cosine_sql('o.v', 'w.v')} < 0.1 AS ok) k)
 SELECT vec_id, kept FROM w""")
def consecutive_distinct(s, d):
    e = load("embeddings")(s, d).select("vec_id", "label", F.col("embedding").alias("v"))
    return sequence.consecutive_distinct(e, ["label"], ["vec_id"], "v", 0.1).select("vec_id", "kept")


@register("box_tracks")
def box_tracks(s, d):
    e = events(s, d)
    x, y = (F.col("event_id") * 37 % 100).cast("double"), (F.col("event_id") * 53 % 100).cast("double")
    boxes = e.select("event_id", "user_id", F.col("event_id").alias("frame"), F.array(x, y, x + 40, y + 40).alias("box"))
    return sequence.tracks(boxes, ["user_id"], "frame", "box", 400, "event_id").select("event_id", "track")


@register("trajectory_vectors")
def trajectory_vectors(s, d):
    e = events(s, d).select("user_id", "t", "lat", "lon")
    return sequence.trajectory(e, ["user_id"], "t", "lat", "lon").select("user_id", F.transform("embedding", lambda v: F.round(v, 6)).alias("embedding"))


@register("ema_histogram", """WITH RECURSIVE o AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
 w AS (SELECT user_id, n, value AS e FROM o WHERE n = 1 UNION ALL SELECT o.user_id, o.n, w.e * 0.9e0 + o.value * (1 - 0.9e0) FROM w JOIN o ON o.user_id = w.user_id AND o.n = w.n + 1)
 SELECT user_id, round(arg_max(e, n), 6) AS ema FROM w GROUP BY user_id""")
def ema_histogram(s, d):
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))), lambda x: x["value"])
    return events(s, d).groupBy("user_id").agg(ordered.alias("v")).select("user_id", F.round(sequence.ema(F.col("v"), 0.9), 6).alias("ema"))


@register("lateral_topn", """SELECT l_suppkey, l_orderkey, l_linenumber, CAST(n AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber) AS n FROM lineitem) x WHERE n <= 3""")
def lateral_topn(s, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber"))
    return LI(s, d).select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice").withColumn("rank", nth).where("rank <= 3").select("l_suppkey", "l_orderkey", "l_linenumber", "rank")


@register("stratified_cap", """WITH a AS (SELECT event_id, user_id, event_type, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY value DESC, event_id) AS k FROM events),
 b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS n FROM a WHERE k <= 3) SELECT event_id, CAST(n AS INTEGER) AS nth FROM b WHERE n <= 8""")
def stratified_cap(s, d):
    return sequence.stratified_cap(events(s, d), ["user_id"], "event_type", [F.col("value").desc(), F.col("event_id")], 3, 8).select("event_id", "nth")


@register("quota_per_kind", "SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) x WHERE n <= 7")
def quota_per_kind(s, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("event_type").orderBy("event_id"))
    return events(s, d).select("event_id", "event_type").withColumn("n", nth).where("n <= 7").select("event_id")


@register("detection_state_machine", f"""WITH RECURSIVE o AS (SELECT 'cam' || user_id % 8 AS camera_id, t, value > 5 AS hit, row_number() OVER (PARTITION BY user_id % 8 ORDER BY t, value > 5 DESC) AS n FROM {EVENTS} e),
 w AS (SELECT camera_id, n, hit::INT AS pending, NULL::DOUBLE AS opened, NULL::DOUBLE AS seen, 0 AS frames, NULL::DOUBLE AS ended, NULL::DOUBLE AS start, NULL::DOUBLE AS last_seen, 0 AS many FROM o WHERE n = 1
   UNION ALL SELECT o.camera_id, o.n, p, CASE WHEN opens THEN o.t WHEN closes THEN NULL ELSE w.opened END, CASE WHEN opens OR (o.hit AND w.opened IS NOT NULL) THEN o.t WHEN closes THEN NULL ELSE w.seen END,
     CASE WHEN opens THEN 1 WHEN closes THEN 0 WHEN o.hit AND w.opened IS NOT NULL THEN w.frames + 1 ELSE w.frames END, CASE WHEN closes THEN o.t ELSE w.ended END,
     CASE WHEN closes THEN w.opened END, CASE WHEN closes THEN w.seen END, CASE WHEN closes THEN w.frames ELSE 0 END
   FROM w JOIN o ON o.camera_id = w.camera_id AND o.n = w.n + 1, LATERAL (SELECT CASE WHEN o.hit THEN w.pending + 1 ELSE 0 END AS p,
     o.hit AND w.opened IS NULL AND w.pending + 1 >= 2 AND (w.ended IS NULL OR o.t - w.ended >= 3600) AS opens, NOT o.hit AND w.opened IS NOT NULL AND o.t - w.seen > 7200 AS closes) k)
 SELECT camera_id, round(start, 3) AS start, round(last_seen, 3) AS last_seen, many AS frames FROM w WHERE start IS NOT NULL
 UNION ALL SELECT camera_id, round(opened, 3), round(seen, 3), frames FROM w WHERE opened IS NOT NULL AND n = (SELECT max(n) FROM o WHERE o.camera_id = w.camera_id)""")
def detection_state_machine(s, d):
    e = events(s, d)
    frames = e.select(F.concat(F.lit("cam"), (F.col("user_id") % 8).cast("string")).alias("camera_id"), F.col("t").alias("ts"), F.when(F.col("value") > 5, 1).otherwise(0).alias("n_detections"))
    got = detection.events(frames, detection.Rules(2, 7200.0, 3600.0))
    return got.select("camera_id", F.round("start", 3).alias("start"), F.round("last_seen", 3).alias("last_seen"), "frames")


@register("hour_windows", """SELECT event_type, date_trunc('hour', ts) AS start, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""")
def hour_windows(s, d):
    e = events(s, d)
    return e.groupBy("event_type", F.window("ts", "1 hour").alias("w")).agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select("event_type", F.col("w.start").cast("timestamp_ntz").alias("start"), "n", "total")


@register("session_windows", """WITH f AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 12 HOUR THEN 1 ELSE 0 END AS new FROM events),
 g AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM f) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k""")
def session_windows(s, d):
    e = events(s, d)
    return e.groupBy("user_id", F.session_window("ts", "12 hours").alias("w")).agg(F.count("*").alias("n")).select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), "n")


_PAIR = "(SELECT event_id, event_id % 2 = 0 AS boxed, CASE event_id % 3 WHEN 0 THEN 35.5e0 WHEN 1 THEN -110.5e0 ELSE value * 3 END AS lat, CASE event_id % 3 WHEN 0 THEN 110.5e0 WHEN 1 THEN 35.5e0 ELSE value * 5 END AS lon FROM events)"


@register("location_repair", f"""WITH r AS (SELECT event_id, boxed, CASE WHEN lat BETWEEN -90 AND 90 THEN lat END AS la, CASE WHEN lon BETWEEN -180 AND 180 THEN lon END AS lo FROM {_PAIR} p),
 w AS (SELECT *, coalesce(la IS NOT NULL AND lo > 0 AND CASE WHEN boxed THEN la BETWEEN 30 AND 40 AND -lo BETWEEN -120 AND -100 ELSE lo BETWEEN 20 AND 170 END, false) AS west FROM r),
 x AS (SELECT event_id, boxed, la, west, CASE WHEN west THEN -lo ELSE lo END AS lo FROM w),
 y AS (SELECT *, coalesce(boxed AND NOT (la BETWEEN 30 AND 40 AND lo BETWEEN -120 AND -100) AND lo BETWEEN 30 AND 40 AND la BETWEEN -120 AND -100, false) AS swap FROM x)
 SELECT event_id, CASE WHEN swap THEN lo ELSE la END AS lat, CASE WHEN swap THEN la ELSE lo END AS lon, concat_ws(',', CASE WHEN west THEN 'FIXED_WEST' END, CASE WHEN swap THEN 'SWAPPED' END) AS flags FROM y""")
def location_repair(s, d):
    pick = lambda a, b, c: F.when(F.col("event_id") % 3 == 0, a).when(F.col("event_id") % 3 == 1, b).otherwise(c)
    e = events(s, d).select("event_id", pick(35.5, -110.5, F.col("value") * 3).alias("lat"), pick(110.5, 35.5, F.col("value") * 5).alias("lon"))
    boxed, free = X.repaired_point(F.col("lat"), F.col("lon"), box=(30, 40, -120, -100)), X.repaired_point(F.col("lat"), F.col("lon"))
    p = F.when(F.col("event_id") % 2 == 0, boxed).otherwise(free)
    return e.select("event_id", p.alias("p")).select("event_id", "p.lat", "p.lon", F.array_join("p.flags", ",").alias("flags"))
