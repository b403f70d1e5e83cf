"""Roll-ups, reports, roles and roll-forward queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import aggregates, graph, incremental
from meridian.plans.base import EVENTS, PLACES, events, load, places
from meridian.plans.registry import register

orders, lineitem, part, customer, docs, conv, labels = (load(n) for n in ("orders", "lineitem", "part", "customer", "documents", "conversations", "labels"))


@register("count_by_label", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def count_by_label(s, d):
    return events(s, d).groupBy("event_type").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "event_type")


@register("conditional_counts", "SELECT user_id, count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'purchase') AS buys, count(*) FILTER (value > 20) AS large FROM events GROUP BY user_id")
def conditional_counts(s, d):
    return aggregates_by_user(events(s, d))


def aggregates_by_user(e):
    return e.groupBy("user_id").agg(F.count_if(F.col("event_type") == "view").alias("views"), F.count_if(F.col("event_type") == "purchase").alias("buys"), F.count_if(F.col("value") > 20).alias("large"))


@register("coverage_report", """SELECT 'quality' AS property, count(l.quality) AS filled, count(*) AS total, round(100e0 * count(l.quality) / count(*), 2) AS percent FROM documents d LEFT JOIN labels l USING (doc_id)
 UNION ALL SELECT 'lang', count(lang), count(*), round(100e0 * count(lang) / count(*), 2) FROM documents""")
def coverage_report(s, d):
    rows = docs(s, d).select("doc_id", "lang").join(labels(s, d), "doc_id", "left")
    return aggregates.coverage(rows, ["quality", "lang"])


@register("weighted_sums", "SELECT o_custkey, round(sum(l_discount * l_quantity), 4) AS weighted FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY o_custkey")
def weighted_sums(s, d):
    return orders(s, d).join(lineitem(s, d), F.col("o_orderkey") == F.col("l_orderkey")).groupBy("o_custkey").agg(F.round(F.sum(F.col("l_discount") * F.col("l_quantity")), 4).alias("weighted"))


@register("dominant_per_group", """WITH w AS (SELECT user_id, event_type, round(sum(value), 6) AS w FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY w DESC, event_type) AS n FROM w)
 SELECT user_id, event_type, round(w, 4) AS weight FROM r WHERE n = 1""")
def dominant_per_group(s, d):
    return aggregates.dominant(events(s, d), ["user_id"], "event_type", F.col("value")).withColumn("weight", F.round("weight", 4))


@register("dominance_score", "SELECT user_id, round(sum(value), 4) AS speech_s, count(DISTINCT event_type) AS file_count, count(DISTINCT CAST(ts AS DATE)) AS active_days, round(sum(value) + 30 * count(DISTINCT CAST(ts AS DATE)) + 5 * count(DISTINCT event_type), 4) AS dominance FROM events GROUP BY user_id")
def dominance_score(s, d):
    got = aggregates.dominance(events(s, d), "user_id", F.col("value"), "event_type", F.to_date("ts"))
    return got.withColumn("speech_s", F.round("speech_s", 4)).withColumn("dominance", F.round("dominance", 4))


@register("evidence_promotion", "SELECT user_id, round(sum(value), 4) AS weight_sum, CASE WHEN sum(value) >= 700 OR user_id % 10 = 0 THEN 'confirmed' ELSE 'tentative' END AS status FROM events GROUP BY user_id")
def evidence_promotion(s, d):
    g = events(s, d).groupBy("user_id").agg(F.sum("value").alias("w"))
    status = F.when(F.col("user_id") % 10 == 0, "confirmed").when(F.col("w") >= 700, "confirmed").otherwise("tentative")
    return g.select("user_id", F.round("w", 4).alias("weight_sum"), status.alias("status"))


SHARES = """shares AS (SELECT user_id AS place, count(*) AS n, avg(CASE WHEN isodow(ts) < 6 THEN 1e0 ELSE 0 END) AS weekday, avg(CASE WHEN hour(ts) BETWEEN 9 AND 18 THEN 1e0 ELSE 0 END) AS business, avg(CASE WHEN hour(ts) BETWEEN 18 AND 23 THEN 1e0 ELSE 0 END) AS evening FROM events GROUP BY user_id)"""


@register("weekday_hour_shares", f"WITH {SHARES} SELECT place, n, round(weekday, 6) AS weekday, round(business, 6) AS business, round(evening, 6) AS evening FROM shares")
def weekday_hour_shares(s, d):
    got = aggregates.hour_shares(events(s, d), "user_id", "ts").withColumnRenamed("user_id", "place")
    return got.select("place", "n", *[F.round(c, 6).alias(c) for c in ("weekday", "business", "evening")])


@register("shares_rollup", f"""WITH {SHARES} SELECT place % 10 AS region, round(sum(weekday * n) / sum(n), 6) AS weekday, round(sum(business * n) / sum(n), 6) AS business, round(sum(evening * n) / sum(n), 6) AS evening, CAST(sum(n) AS BIGINT) AS n FROM shares GROUP BY 1""")
def shares_rollup(s, d):
    got = aggregates.weighted_shares(aggregates.hour_shares(events(s, d), "user_id", "ts").withColumn("region", F.col("user_id") % 10), ["region"])
    return got.select("region", *[F.round(c, 6).alias(c) for c in ("weekday", "business", "evening")], "n")


@register("role_assignment", f"""WITH {SHARES}, w AS (SELECT *, 0.5e0 * weekday + 0.3e0 * business + 0.2e0 * CASE WHEN weekday > 0.5 THEN evening ELSE 0 END AS score, row_number() OVER (ORDER BY n DESC, place) = 1 AS home FROM shares),
 r AS (SELECT *, row_number() OVER (PARTITION BY home ORDER BY round(score, 9) DESC, place) AS k FROM w)
 SELECT place, CASE WHEN home THEN 'home' WHEN k = 1 THEN 'work' WHEN n < 65 OR weekday < 0.15 THEN 'travel' ELSE 'other' END AS role FROM r""")
def role_assignment(s, d):
    got = aggregates.hour_shares(events(s, d), "user_id", "ts").withColumnRenamed("user_id", "place")
    return aggregates.place_roles(got, "place", 65).select("place", "role")


@register("daily_rollup", """WITH r AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_id, props, row_number() OVER (PARTITION BY CAST(ts AS DATE) ORDER BY event_id) AS k FROM events)
 SELECT day, count(*) AS n, substr(string_agg(CASE WHEN k <= 8 THEN '- ' || substr(props, 1, 6) END, chr(10) ORDER BY k), 1, 60) AS digest FROM r GROUP BY day""")
def daily_rollup(s, d):
    return aggregates.daily_digest(events(s, d).select("ts", "event_id", "props"), F.to_date("ts").cast("string"), "event_id", "props", 8, 6, 60)


@register("place_hour", """SELECT date_trunc('hour', ts) AS hour, arg_min(event_type, (-n, event_type)) AS place, max(n) AS pings FROM (SELECT date_trunc('hour', ts) AS ts, event_type, count(*) AS n FROM events GROUP BY 1, 2) x GROUP BY 1""")
def place_hour(s, d):
    got = aggregates.dominant(events(s, d).withColumn("hour", F.date_trunc("hour", "ts").cast("timestamp_ntz")), ["hour"], "event_type", F.lit(1))
    return got.select("hour", F.col("event_type").alias("place"), F.col("weight").cast("long").alias("pings"))


@register("second_medians", f"SELECT user_id, CAST(floor(t / 86400) AS BIGINT) AS sec, median(value) AS value, median(lat) AS lat FROM {EVENTS} e GROUP BY 1, 2")
def second_medians(s, d):
    e = events(s, d).withColumn("sec", F.floor(F.col("t") / 86400).cast("long"))
    return aggregates.second_medians(e, ["user_id"], "sec", ["value", "lat"])


@register("weighted_centre", f"""WITH c AS (SELECT nation, role, count(*) AS n, avg(lat) AS lat, avg(lon) AS lon FROM {PLACES} p GROUP BY 1, 2)
 SELECT nation, round(sum(lat * n) / sum(n), 6) AS lat, round(sum(lon * n) / sum(n), 6) AS lon, CAST(sum(n) AS BIGINT) AS n, count(*) AS cells, arg_min(role, (-n, role)) AS role FROM c GROUP BY nation""")
def weighted_centre(s, d):
    cells = places(s, d).groupBy("nation", "role").agg(F.count("*").alias("n"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon"))
    got = aggregates.weighted_centre(cells, ["nation"], "lat", "lon", "n", "role")
    return got.withColumn("lat", F.round("lat", 6)).withColumn("lon", F.round("lon", 6))


@register("entity_bags", "SELECT md5(event_type || '|' || user_id || '|') AS id, event_type, user_id, count(*) AS n, list(event_id ORDER BY event_id) AS starts, round(avg(value), 6) AS avg_score FROM events GROUP BY event_type, user_id")
def entity_bags(s, d):
    g = events(s, d).groupBy("event_type", "user_id").agg(F.count("*").alias("n"), F.sort_array(F.collect_list("event_id")).alias("starts"), F.round(F.avg("value"), 6).alias("avg_score"))
    return g.withColumn("id", X.stable_id("event_type", "user_id"))


@register("freshness", "SELECT event_type, CAST(max(ts) AS VARCHAR) AS newest, datediff('day', max(ts), TIMESTAMP '2024-02-15') AS stale_days FROM events GROUP BY event_type")
def freshness(s, d):
    g = events(s, d).groupBy("event_type").agg(F.max("ts").alias("m"))
    return g.select("event_type", F.col("m").cast("string").alias("newest"), F.datediff(F.lit("2024-02-15").cast("date"), F.col("m")).cast("long").alias("stale_days"))


@register("degree_top", "SELECT l_suppkey, count(*) AS degree FROM lineitem GROUP BY l_suppkey ORDER BY degree DESC, l_suppkey LIMIT 5")
def degree_top(s, d):
    return lineitem(s, d).groupBy("l_suppkey").agg(F.count("*").alias("degree")).orderBy(F.col("degree").desc(), "l_suppkey").limit(5)


@register("theme_counts", "SELECT p_type, count(DISTINCT o_custkey) AS customers FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus = 'F' GROUP BY p_type")
def theme_counts(s, d):
    j = part(s, d).join(lineitem(s, d), F.col("p_partkey") == F.col("l_partkey")).join(orders(s, d).where("o_orderstatus = 'F'"), F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy("p_type").agg(F.countDistinct("o_custkey").alias("customers"))


@register("distinct_slice", "SELECT o_custkey, list_sort(list(DISTINCT o_orderpriority))[1:3] AS priorities FROM orders GROUP BY o_custkey")
def distinct_slice(s, d):
    return orders(s, d).groupBy("o_custkey").agg(F.slice(F.sort_array(F.collect_set("o_orderpriority")), 1, 3).alias("priorities"))


@register("trip_selection", "SELECT user_id, count(DISTINCT CAST(ts AS DATE)) AS days FROM events WHERE event_type = 'view' GROUP BY user_id HAVING count(DISTINCT CAST(ts AS DATE)) >= 3 ORDER BY days DESC, user_id LIMIT 20")
def trip_selection(s, d):
    g = events(s, d).where("event_type = 'view'").groupBy("user_id").agg(F.countDistinct(F.to_date("ts")).alias("days"))
    return g.where("days >= 3").orderBy(F.col("days").desc(), "user_id").limit(20)


@register("left_join_stats", "SELECT c_custkey, round(avg(o_totalprice), 6) AS avg_price, max(o_totalprice) AS max_price, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey")
def left_join_stats(s, d):
    j = customer(s, d).join(orders(s, d), F.col("o_custkey") == F.col("c_custkey"), "left")
    return j.groupBy("c_custkey").agg(F.round(F.avg("o_totalprice"), 6).alias("avg_price"), F.max("o_totalprice").alias("max_price"), F.count("o_orderkey").alias("n"))


def _records(s, d):
    """KPI records: a part is a short, its brand the platform, its type the topic."""
    p = part(s, d)
    k = F.col("p_partkey")
    return p.select(k.cast("string").alias("short_id"), F.col("p_brand").alias("platform"), F.col("p_type").alias("topic"), F.substring("p_name", 1, 4).alias("hook"), (k * 37 % 1000).cast("double").alias("views"), (k * 13 % 100).cast("double").alias("avg_view_pct"), (k * 7 % 50 / F.lit(10.0)).alias("ctr"), (k * 11 % 100).cast("double").alias("pred_virality"))


RECORDS = "(SELECT CAST(p_partkey AS VARCHAR) AS short_id, p_brand AS platform, p_type AS topic, substr(p_name, 1, 4) AS hook, CAST(p_partkey * 37 % 1000 AS DOUBLE) AS views, CAST(p_partkey * 13 % 100 AS DOUBLE) AS avg_view_pct, p_partkey * 7 % 50 / 10e0 AS ctr, CAST(p_partkey * 11 % 100 AS DOUBLE) AS pred_virality FROM part)"


@register("kpi_report", f"SELECT platform, round(avg(views), 1) AS avg_views, round(avg(avg_view_pct), 1) AS avg_retention, count(*) AS n FROM {RECORDS} r GROUP BY platform")
def kpi_report(s, d):
    return aggregates.kpi_report(_records(s, d), "platform", "topic", "hook")["platforms"]


@register("kpi_error", f"SELECT round(avg(abs(100e0 * views / m - pred_virality)), 1) AS mae FROM {RECORDS} r, (SELECT max(views) AS m FROM {RECORDS} q) x")
def kpi_error(s, d):
    return aggregates.kpi_report(_records(s, d), "platform", "topic", "hook")["error"]


@register("kpi_hooks", f"""WITH h AS (SELECT hook, round(avg(avg_view_pct), 1) AS retention FROM {RECORDS} r GROUP BY hook)
 SELECT * FROM (SELECT hook, retention, 'top' AS side FROM h ORDER BY retention DESC, hook LIMIT 5) a UNION ALL SELECT * FROM (SELECT hook, retention, 'weak' AS side FROM h ORDER BY retention, hook LIMIT 5) b""")
def kpi_hooks(s, d):
    return aggregates.kpi_report(_records(s, d), "platform", "topic", "hook")["hooks"]


@register("kpi_actions", f"""SELECT 0 AS place, 'rerender' AS action, short_id AS subject, ctr AS value FROM {RECORDS} r WHERE ctr < 0.5
 UNION ALL SELECT 1, 'promote', s, v FROM (SELECT platform, arg_min(short_id, (-avg_view_pct, short_id)) AS s, max(avg_view_pct) AS v FROM {RECORDS} r WHERE avg_view_pct > 60 GROUP BY platform) x
 UNION ALL SELECT 2, 'pause', topic, round(avg(views), 6) FROM {RECORDS} r GROUP BY topic HAVING avg(views) < 499""")
def kpi_actions(s, d):
    got = aggregates.kpi_actions(_records(s, d), "platform", "topic", low_ctr=0.5, low_views=499.0)
    return got.withColumn("value", F.round("value", 6))


@register("keyword_lift", "SELECT round(avg(value) FILTER (contains(props, '7')), 6) AS with_mean, round(avg(value) FILTER (NOT contains(props, '7')), 6) AS without_mean, round(avg(value) FILTER (contains(props, '7')) / avg(value) FILTER (NOT contains(props, '7')), 6) AS lift FROM events")
def keyword_lift(s, d):
    got = aggregates.lift(events(s, d), F.col("props").contains("7"), F.col("value"))
    return got.select(*[F.round(c, 6).alias(c) for c in got.columns])


@register("graded_scores", f"SELECT short_id, round(0.6e0 * avg_view_pct + 0.4e0 * pred_virality, 6) AS score, CASE WHEN 0.6e0 * avg_view_pct + 0.4e0 * pred_virality >= 90 THEN 'A' WHEN 0.6e0 * avg_view_pct + 0.4e0 * pred_virality >= 80 THEN 'B' WHEN 0.6e0 * avg_view_pct + 0.4e0 * pred_virality >= 70 THEN 'C' WHEN 0.6e0 * avg_view_pct + 0.4e0 * pred_virality >= 60 THEN 'D' ELSE 'F' END AS grade FROM {RECORDS} r")
def graded_scores(s, d):
    got = aggregates.graded(_records(s, d), {"avg_view_pct": 0.6, "pred_virality": 0.4})
    return got.select("short_id", F.round("score", 6).alias("score"), "grade")


@register("cluster_sizes", "SELECT label, count(*) AS size, list(vec_id ORDER BY vec_id)[1:5] AS members FROM embeddings GROUP BY label HAVING count(*) >= 45")
def cluster_sizes(s, d):
    g = load("embeddings")(s, d).groupBy("label").agg(F.count("*").alias("size"), F.slice(F.sort_array(F.collect_list("vec_id")), 1, 5).alias("members"))
    return g.where("size >= 45")


@register("mode_label", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, arg_min(event_type, (-n, event_type)) AS mode FROM c GROUP BY user_id")
def mode_label(s, d):
    return aggregates.dominant(events(s, d), ["user_id"], "event_type", F.lit(1)).select("user_id", F.col("event_type").alias("mode"))


@register("queue_status", "SELECT o_orderstatus AS status, count(*) AS n, list(o_orderkey ORDER BY o_orderkey DESC)[1:10] AS last FROM orders GROUP BY 1")
def queue_status(s, d):
    w = Window.partitionBy("o_orderstatus").orderBy(F.col("o_orderkey").desc())
    o = orders(s, d).select("o_orderstatus", "o_orderkey")
    last = o.withColumn("k", F.row_number().over(w)).where("k <= 10").groupBy("o_orderstatus").agg(F.sort_array(F.collect_list("o_orderkey"), asc=False).alias("last"))
    return o.groupBy("o_orderstatus").agg(F.count("*").alias("n")).join(last, "o_orderstatus").withColumnRenamed("o_orderstatus", "status")


@register("pending_work", """SELECT 'unlabelled' AS kind, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
 UNION ALL SELECT 'no_orders', count(*) FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)""")
def pending_work(s, d):
    a = docs(s, d).select("doc_id").join(labels(s, d), "doc_id", "left_anti").agg(F.lit("unlabelled").alias("kind"), F.count("*").alias("n"))
    b = customer(s, d).join(orders(s, d), F.col("o_custkey") == F.col("c_custkey"), "left_anti").agg(F.lit("no_orders").alias("kind"), F.count("*").alias("n"))
    return a.unionByName(b)


@register("health_snapshot", "SELECT count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (value > 20) AS large, count(*) FILTER (props IS NULL) AS bare FROM events")
def health_snapshot(s, d):
    return aggregates.health_snapshot(events(s, d), {"errors": F.col("event_type") == "error", "large": F.col("value") > 20, "bare": F.col("props").isNull()})


@register("one_anchor", "SELECT count(*) FILTER (user_id = 7) > 0 AS present, count(DISTINCT CASE WHEN user_id = 7 THEN user_id END) = 1 AS exactly_one FROM events")
def one_anchor(s, d):
    hit = F.col("user_id") == 7
    return events(s, d).agg((F.count_if(hit) > 0).alias("present"), (F.countDistinct(F.when(hit, F.col("user_id"))) == 1).alias("exactly_one"))


@register("stall_detection", "WITH a AS (SELECT event_type, count(*) AS n FROM events GROUP BY 1), b AS (SELECT event_type, count(*) FILTER (event_type <> 'view') AS p FROM events WHERE event_id % 2 = 0 OR event_type = 'click' GROUP BY 1) SELECT a.event_type, a.n, b.p AS before, a.n <= b.p AS stalled FROM a LEFT JOIN b USING (event_type)")
def stall_detection(s, d):
    e = events(s, d)
    now = e.groupBy("event_type").agg(F.count("*").alias("n"))
    old = e.where((F.col("event_id") % 2 == 0) | (F.col("event_type") == "click")).groupBy("event_type").agg(F.count_if(F.col("event_type") != "view").alias("n"))
    return incremental.stalled(now, old, "event_type", "n")


@register("grid_raster", """WITH b AS (SELECT user_id, event_id * 37 % 80 * 1e0 AS x, event_id * 53 % 60 * 1e0 AS y FROM events), c AS (
   SELECT user_id, x, y, cx, cy FROM b, range(0, 4) t(cx), range(0, 4) u(cy))
 SELECT user_id, CAST(cy AS INTEGER) AS cell_y, CAST(cx AS INTEGER) AS cell_x, round(sum(greatest(0, least(x + 20, (cx + 1) * 25e0) - greatest(x, cx * 25e0)) * greatest(0, least(y + 20, (cy + 1) * 20e0) - greatest(y, cy * 20e0)) / 400), 6) AS value
 FROM c GROUP BY 1, 2, 3 HAVING sum(greatest(0, least(x + 20, (cx + 1) * 25e0) - greatest(x, cx * 25e0)) * greatest(0, least(y + 20, (cy + 1) * 20e0) - greatest(y, cy * 20e0))) > 0""")
def grid_raster(s, d):
    e = events(s, d)
    x, y = (F.col("event_id") * 37 % 80).cast("double"), (F.col("event_id") * 53 % 60).cast("double")
    got = aggregates.rasterised(e.select("user_id", F.array(x, y, x + 20, y + 20).alias("box")), ["user_id"], "box", 100.0, 80.0, 4, 4)
    return got.withColumn("value", F.round("value", 6))


@register("cooccurrence_companions", "SELECT l_suppkey, count(DISTINCT l_orderkey) AS groups FROM lineitem WHERE l_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_suppkey = 3) AND l_suppkey <> 3 GROUP BY l_suppkey")
def cooccurrence_companions(s, d):
    return graph.companions(lineitem(s, d).select("l_orderkey", "l_suppkey"), "l_orderkey", "l_suppkey", 3)


@register("specific_child", """WITH c AS (SELECT o_custkey, o_orderpriority, sum(o_totalprice) AS sc FROM orders GROUP BY 1, 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY (o_orderpriority = '5-LOW')::INT, sc DESC) AS k FROM c) SELECT o_custkey, o_orderpriority, round(sc, 4) AS sc FROM r WHERE k = 1""")
def specific_child(s, d):
    c = orders(s, d).groupBy("o_custkey", "o_orderpriority").agg(F.sum("o_totalprice").alias("sc"))
    return graph.specific_child(c, "o_custkey", "o_orderpriority", "sc", ["5-LOW"]).withColumn("sc", F.round("sc", 4))
