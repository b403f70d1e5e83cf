"""Joins, sets, paging, upserts, incremental work and composite queries over the tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import graph, incremental, intervals, nearest, upsert, vectors
from meridian.plans.base import EVENTS, PLACES, cosine_sql, events, haversine_sql, load, places
from meridian.plans.registry import register
from meridian.plans.vector_queries import CENTROIDS
from meridian.sources import readers, writers

orders, lineitem, part, customer, docs, conv, labels, nation, region, supplier, emb = (load(n) for n in ("orders", "lineitem", "part", "customer", "documents", "conversations", "labels", "nation", "region", "supplier", "embeddings"))


@register("join_chain", "SELECT r_name, n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2")
def join_chain(s, d):
    j = region(s, d).join(nation(s, d), F.col("r_regionkey") == F.col("n_regionkey")).join(customer(s, d), F.col("n_nationkey") == F.col("c_nationkey")).join(orders(s, d), F.col("c_custkey") == F.col("o_custkey"))
    return j.groupBy("r_name", "n_name").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@register("left_outer_join", "SELECT c_custkey, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'")
def left_outer_join(s, d):
    return customer(s, d).join(orders(s, d).where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@register("semi_join", "SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def semi_join(s, d):
    return customer(s, d).join(orders(s, d).where("o_totalprice > 400000"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@register("anti_join", "SELECT s_suppkey FROM supplier WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity * l_discount > 4.9)")
def anti_join(s, d):
    return supplier(s, d).join(lineitem(s, d).where("l_quantity * l_discount > 4.9"), F.col("l_suppkey") == F.col("s_suppkey"), "left_anti").select("s_suppkey")


@register("optional_filters", "SELECT event_id FROM events WHERE event_type IN ('view', 'click') AND value >= 10 AND contains(props, '7')")
def optional_filters(s, d):
    df = events(s, d)
    for value, pred in ((["view", "click"], lambda v: F.col("event_type").isin(v)), (10, lambda v: F.col("value") >= v), (None, lambda v: F.col("user_id") == v), ("7", lambda v: F.col("props").contains(v))):
        if value is not None:
            df = df.where(pred(value))
    return df.select("event_id")


@register("pattern_filters", "SELECT p_partkey FROM part WHERE starts_with(p_name, 're') AND regexp_matches(p_brand, '#1\\d$') AND length(p_name) BETWEEN 8 AND 12 AND contains(lower(p_type), 'o')")
def pattern_filters(s, d):
    return part(s, d).where(F.col("p_name").startswith("re") & F.col("p_brand").rlike(r"#1\d$") & F.length("p_name").between(8, 12) & F.lower("p_type").contains("o")).select("p_partkey")


@register("keyset_page", "SELECT o_orderkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 25")
def keyset_page(s, d):
    return readers.page(orders(s, d), "o_orderkey", 500, 25).select("o_orderkey")


@register("offset_page", "SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20 OFFSET 40")
def offset_page(s, d):
    return readers.offset_page(orders(s, d).withColumn("neg", -F.col("o_totalprice")), ["neg", "o_orderkey"], 40, 20).select("o_orderkey")


@register("hash_sample", "SELECT event_id FROM events WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 4) AS INTEGER) < 6554")
def hash_sample(s, d):
    return events(s, d).where(F.conv(F.substring(F.md5(F.col("event_id").cast("string")), 1, 4), 16, 10).cast("int") < 6554).select("event_id")


@register("set_intersection", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_intersection(s, d):
    o = orders(s, d)
    return o.where("o_orderstatus = 'F'").select("o_custkey").intersect(o.where("o_orderstatus = 'P'").select("o_custkey"))


@register("set_difference", "SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_difference(s, d):
    o = orders(s, d)
    return o.where("o_orderstatus = 'F'").select("o_custkey").subtract(o.where("o_orderstatus = 'P'").select("o_custkey"))


@register("pool_top", "SELECT event_id, value FROM events WHERE value >= 10 ORDER BY value DESC, event_id LIMIT 30")
def pool_top(s, d):
    return events(s, d).where("value >= 10").orderBy(F.col("value").desc(), "event_id").limit(30).select("event_id", "value")


@register("preferred_candidate", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey) AS n FROM orders) x WHERE n = 1")
def preferred_candidate(s, d):
    rank = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    return upsert.latest(orders(s, d), ["o_custkey"], [rank, F.col("o_totalprice").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@register("keep_largest", "SELECT l_partkey, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_quantity * l_tax DESC, l_orderkey, l_linenumber) AS n FROM lineitem) x WHERE n = 1")
def keep_largest(s, d):
    return upsert.latest(lineitem(s, d), ["l_partkey"], [(F.col("l_quantity") * F.col("l_tax")).desc(), F.col("l_orderkey"), F.col("l_linenumber")]).select("l_partkey", "l_orderkey", "l_linenumber")


@register("edge_dedupe", "SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2")
def edge_dedupe(s, d):
    return lineitem(s, d).groupBy("l_suppkey", "l_partkey").agg(F.count("*").alias("n"))


_BASE = "(SELECT c_custkey AS id, c_name AS name, c_acctbal AS bal FROM customer WHERE c_custkey % 3 <> 0)"
_DELTA = "(SELECT c_custkey AS id, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 'new' || c_custkey END AS name, 1e0 AS bal FROM customer WHERE c_custkey % 2 = 0)"


def _base_delta(s, d):
    c = customer(s, d)
    k = F.col("c_custkey")
    base = c.where(k % 3 != 0).select(k.alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))
    delta = c.where(k % 2 == 0).select(k.alias("id"), F.when(k % 4 != 0, F.concat(F.lit("new"), k.cast("string"))).alias("name"), F.lit(1.0).alias("bal"))
    return base, delta


@register("upsert_merge", f"SELECT coalesce(b.id, d.id) AS id, CASE WHEN b.id IS NULL THEN d.name WHEN d.id IS NULL THEN b.name ELSE coalesce(d.name, b.name) END AS name, CASE WHEN b.id IS NULL THEN d.bal WHEN d.id IS NULL THEN b.bal ELSE b.bal + d.bal END AS bal FROM {_BASE} b FULL JOIN {_DELTA} d ON b.id = d.id")
def upsert_merge(s, d):
    return upsert.upsert(*_base_delta(s, d), ["id"], {"bal": upsert.add})


@register("upsert_first_wins", f"SELECT coalesce(b.id, d.id) AS id, coalesce(b.name, d.name) AS name FROM {_BASE} b FULL JOIN {_DELTA} d ON b.id = d.id")
def upsert_first_wins(s, d):
    base, delta = _base_delta(s, d)
    return upsert.upsert(base.drop("bal"), delta.drop("bal"), ["id"], default=upsert.keep_old)


@register("insert_if_absent", f"SELECT id, name FROM {_BASE} b UNION ALL SELECT id, name FROM {_DELTA} d WHERE id NOT IN (SELECT id FROM {_BASE} x)")
def insert_if_absent(s, d):
    base, delta = _base_delta(s, d)
    return upsert.insert_if_absent(base.drop("bal"), delta.drop("bal"), ["id"])


@register("replace_edges", "SELECT o_custkey AS src, o_orderkey AS dst FROM orders WHERE o_custkey % 5 <> 0 UNION ALL SELECT o_custkey, o_orderkey + 1000000 FROM orders WHERE o_custkey % 5 = 0")
def replace_edges(s, d):
    o = orders(s, d).select(F.col("o_custkey").alias("src"), F.col("o_orderkey").alias("dst"))
    return upsert.replace_edges(o, o.where("src % 5 = 0").withColumn("dst", F.col("dst") + 1000000), ["src"])


@register("accumulate_counts", "SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def accumulate_counts(s, d):
    e = events(s, d)
    part_of = lambda k: e.where(F.col("event_id") % 2 == k).groupBy("user_id", "event_type").agg(F.count("*").alias("n")).withColumn("src", F.lit(k))
    return upsert.accumulate(part_of(0).unionByName(part_of(1)), part_of(1), ["user_id", "event_type"], "n", "src")


@register("delete_where", "SELECT event_id FROM events WHERE NOT (value > 5 AND event_type = 'error')")
def delete_where(s, d):
    return upsert.delete_where(events(s, d), (F.col("value") > 5) & (F.col("event_type") == "error")).select("event_id")


@register("retention_cap", f"""WITH y AS (SELECT event_id, user_id, value, t FROM {EVENTS} e WHERE 1706745600 - t <= 864000), r AS (SELECT event_id, sum(CAST(value * 100 AS BIGINT)) OVER (PARTITION BY user_id ORDER BY t DESC, event_id ROWS UNBOUNDED PRECEDING) AS c FROM y)
 SELECT event_id FROM r WHERE c <= 10000""")
def retention_cap(s, d):
    e = events(s, d).withColumn("size", F.round(F.col("value") * 100).cast("long"))
    return upsert.retained(e, 10000, 864000.0, 1706745600.0, "size", "t", "event_id", ["user_id"]).select("event_id")


@register("hash_change_detect", "SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN 'new' ELSE 'changed' END AS change FROM documents WHERE doc_id % 5 = 0 OR doc_id % 7 = 0")
def hash_change_detect(s, d):
    t = docs(s, d).select("doc_id", "text")
    state = t.where("doc_id % 5 <> 0").select("doc_id", F.when(F.col("doc_id") % 7 == 0, "old").otherwise(F.sha2("text", 256)).alias("content_hash"))
    return incremental.changed(t, state, "doc_id", "text").select("doc_id", "change")


@register("reingest_decision", """SELECT user_id, source IS NULL OR n = 0 OR w * 2 > n AS again FROM (SELECT user_id, max(CASE WHEN user_id % 9 <> 0 THEN 'src' END) AS source, count(*) FILTER (user_id % 11 <> 0) AS n, count(*) FILTER (value < 4) AS w FROM events GROUP BY user_id) x""")
def reingest_decision(s, d):
    g = events(s, d).groupBy("user_id").agg(F.max(F.when(F.col("user_id") % 9 != 0, "src")).alias("source"), F.min("ts").alias("started_at"), F.count_if(F.col("user_id") % 11 != 0).alias("segments"), F.count_if(F.col("value") < 4).alias("without_vectors"))
    return g.select("user_id", incremental.needs_ingest(g).alias("again"))


_JOBS = "(SELECT user_id AS key, CASE WHEN user_id % 3 = 0 THEN '' WHEN user_id % 3 = 1 THEN 'a' ELSE NULL END AS owner, user_id * 1000 AS claimed_at, 'pending' AS status FROM (SELECT DISTINCT user_id FROM events) u)"


def _jobs(s, d):
    u = F.col("user_id")
    return events(s, d).select(u.alias("key"), F.when(u % 3 == 0, "").when(u % 3 == 1, "a").alias("owner"), (u * 1000).alias("claimed_at"), F.lit("pending").alias("status")).distinct()


@register("lease_claim", f"""SELECT key, CASE WHEN c THEN 'me' ELSE owner END AS owner, CASE WHEN c THEN 200000 ELSE claimed_at END AS claimed_at, CASE WHEN c THEN 'running' ELSE status END AS status FROM (
   SELECT *, key % 2 = 0 AND (coalesce(owner, '') = '' OR claimed_at + 100000 < 200000) AS c FROM {_JOBS} j) x""")
def lease_claim(s, d):
    j = _jobs(s, d)
    return incremental.claimed(j, j.where("key % 2 = 0"), "me", 200000, 100000)


@register("lease_reap", f"""WITH g AS (SELECT *, coalesce(owner, '') <> '' AND claimed_at + 100000 < 200000 AS e FROM {_JOBS} j), r AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY claimed_at, key) AS n FROM g)
 SELECT key, CASE WHEN e AND n <= 10 THEN '' ELSE owner END AS owner, status FROM r""")
def lease_reap(s, d):
    return incremental.reaped(_jobs(s, d), 200000, 100000, 10).select("key", "owner", "status")


@register("queue_transition", "SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'P' AND n <= 40 THEN 'READY' ELSE o_orderstatus END AS status FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) x")
def queue_transition(s, d):
    t = orders(s, d).select(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("priority"))
    return incremental.queue_step(t, "P", "READY", 40).select("id", "status")


STATES = ["signup", "view", "click", "purchase"]


@register("state_order", """WITH e AS (SELECT event_id, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS f, event_type AS t, value > 40 AS forced FROM events)
 SELECT event_id, forced OR coalesce(list_position(['signup', 'view', 'click', 'purchase'], t), 0) = coalesce(list_position(['signup', 'view', 'click', 'purchase'], f), 0) + 1 AS ok FROM e WHERE f IS NOT NULL""")
def state_order(s, d):
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    e = events(s, d).withColumn("f", F.lag("event_type").over(w)).where("f is not null")
    return e.select("event_id", incremental.valid_step(STATES, F.col("f"), F.col("event_type"), F.col("value") > 40).alias("ok"))


@register("calendar_dimension", "SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS dom, CAST(isodow(ts) AS INTEGER) AS weekday FROM events")
def calendar_dimension(s, d):
    return events(s, d).select(F.to_date("ts").cast("string").alias("day"), F.year("ts").alias("year"), F.month("ts").alias("month"), F.dayofmonth("ts").alias("dom"), X.iso_weekday(F.col("ts")).alias("weekday")).distinct()


@register("trailing_window", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n FROM events WHERE CAST(ts AS DATE) >= DATE '2024-01-25' GROUP BY 1")
def trailing_window(s, d):
    e = incremental.since(events(s, d).withColumn("day", F.to_date("ts").cast("string")), "day", "2024-01-25")
    return e.groupBy("day").agg(F.count("*").alias("n"))


@register("stage_preference", "SELECT key, CASE WHEN key % 2 = 0 THEN 'json' ELSE 'csv' END AS format FROM (SELECT DISTINCT user_id AS key FROM events) u")
def stage_preference(s, d):
    u = events(s, d).select(F.col("user_id").alias("key"), F.lit("segments").alias("stage")).distinct()
    files = u.select("*", F.lit("csv").alias("format"), F.lit("p").alias("path")).unionByName(u.where("key % 2 = 0").select("*", F.lit("json").alias("format"), F.lit("p").alias("path")))
    return writers.preferred_stage(files, ["json", "csv"]).select("key", "format")


@register("markdown_notes", "SELECT regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g') AS name, '# ' || p_brand || chr(10) || chr(10) || '- p_type: ' || p_type || chr(10) || '- p_size: ' || p_size AS note FROM part ORDER BY p_name, p_partkey LIMIT 1")
def markdown_notes(s, d):
    first = part(s, d).orderBy("p_name", "p_partkey").limit(1)
    return writers.as_notes(first, "p_name", "p_brand", ["p_type", "p_size"], 1)


@register("identity_rename", "SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 3 THEN 'owner' ELSE l_returnflag END AS label FROM lineitem")
def identity_rename(s, d):
    links = supplier(s, d).select("s_suppkey", (F.col("s_suppkey") % 10).alias("gid"))
    names = s.createDataFrame([(3, "owner")], "gid long, label string")
    rows = lineitem(s, d).select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("s_suppkey"), F.col("l_returnflag").alias("label"))
    return graph.renamed(links, names, rows, "s_suppkey", "gid", "label").select("l_orderkey", "l_linenumber", "label")


@register("identity_merge", "SELECT DISTINCT o_orderkey AS src, CASE WHEN o_custkey % 4 = 1 THEN o_custkey - 1 ELSE o_custkey END AS dst FROM orders")
def identity_merge(s, d):
    edges = orders(s, d).select(F.col("o_orderkey").alias("src"), F.col("o_custkey").alias("dst"))
    same = customer(s, d).where("c_custkey % 4 = 1").select(F.col("c_custkey").alias("old"), (F.col("c_custkey") - 1).alias("canonical"))
    return graph.merged_identities(edges, same)


@register("speaker_fallback", "SELECT c.conv_id, c.turn, coalesce(l.lang, CASE WHEN c.turn % 2 = 0 THEN 'even' END, 'none') AS speaker FROM conversations c LEFT JOIN documents l ON l.doc_id = c.conv_id AND c.turn % 3 = 0")
def speaker_fallback(s, d):
    x = docs(s, d).select("doc_id", "lang")
    j = conv(s, d).join(x, (F.col("doc_id") == F.col("conv_id")) & (F.col("turn") % 3 == 0), "left")
    return j.select("conv_id", "turn", F.coalesce("lang", F.when(F.col("turn") % 2 == 0, "even"), F.lit("none")).alias("speaker"))


@register("said_near", f"""WITH p AS (SELECT DISTINCT CAST(floor(t / 3600) AS BIGINT) AS h FROM {EVENTS} e WHERE event_type = 'purchase' AND user_id = 5),
 u AS (SELECT event_id, CAST(floor(t / 3600) AS BIGINT) AS h, props FROM {EVENTS} e WHERE event_type = 'click') SELECT DISTINCT u.event_id, u.props FROM u JOIN p ON abs(u.h - p.h) <= 1""")
def said_near(s, d):
    e = events(s, d).withColumn("h", F.floor(F.col("t") / 3600).cast("long"))
    hours = e.where("event_type = 'purchase' and user_id = 5").select(F.explode(F.array(F.col("h") - 1, F.col("h"), F.col("h") + 1)).alias("h")).distinct()
    return e.where("event_type = 'click'").join(hours, "h", "left_semi").select("event_id", "props").distinct()


@register("location_resolution", f"""WITH a AS (SELECT v.event_id, max(CASE WHEN b.buy_id IS NOT NULL THEN 1 ELSE 0 END) AS by_event FROM (SELECT event_id, user_id, t FROM {EVENTS} e WHERE event_type = 'view') v
   LEFT JOIN (SELECT event_id AS buy_id, user_id, t FROM {EVENTS} e WHERE event_type = 'purchase') b ON v.user_id = b.user_id AND abs(v.t - b.t) <= 7200 GROUP BY 1),
 p AS (SELECT DISTINCT e.event_id FROM (SELECT event_id, lat, lon FROM {EVENTS} x WHERE event_type = 'view') e JOIN {PLACES} p ON abs(e.lat - p.lat) <= 0.2 WHERE {haversine_sql('e.lat', 'e.lon', 'p.lat', 'p.lon')} <= 6000)
 SELECT a.event_id, CASE WHEN by_event = 1 THEN 'event' WHEN p.event_id IS NOT NULL THEN 'place' ELSE 'none' END AS source FROM a LEFT JOIN p ON p.event_id = a.event_id""")
def location_resolution(s, d):
    v = events(s, d).where("event_type = 'view'")
    buys = events(s, d).where("event_type = 'purchase'").select(F.col("event_id").alias("buy_id"), "user_id", "t")
    timed = nearest.nearest_time(v.select("event_id", "user_id", "t"), buys, "event_id", "buy_id", "t", "t", 7200.0, ["user_id"])
    near = nearest.nearest_place(v, places(s, d), "event_id", "place", 6000.0).select("event_id", "place")
    return timed.join(near, "event_id", "left").select("event_id", F.when(F.col("match_id").isNotNull(), "event").when(F.col("place").isNotNull(), "place").otherwise("none").alias("source"))


@register("trip_story", f"""WITH v AS (SELECT event_id, user_id, t, lat, lon FROM {EVENTS} e WHERE event_type = 'view' AND user_id IN (SELECT user_id FROM events WHERE event_type = 'view' GROUP BY user_id HAVING count(*) >= 15)),
 c AS (SELECT v.event_id, p.role, row_number() OVER (PARTITION BY v.event_id ORDER BY {haversine_sql('v.lat', 'v.lon', 'p.lat', 'p.lon')}, p.place) AS n FROM v JOIN {PLACES} p ON abs(v.lat - p.lat) <= 0.5 WHERE {haversine_sql('v.lat', 'v.lon', 'p.lat', 'p.lon')} <= 15000)
 SELECT v.user_id, CAST(row_number() OVER (PARTITION BY v.user_id ORDER BY v.t, v.event_id) AS INTEGER) AS nth, v.event_id, coalesce(c.role, 'somewhere') AS label FROM v LEFT JOIN c ON c.event_id = v.event_id AND c.n = 1""")
def trip_story(s, d):
    v = events(s, d).where("event_type = 'view'")
    busy = v.groupBy("user_id").agg(F.count("*").alias("n")).where("n >= 15").select("user_id")
    v = v.join(busy, "user_id", "left_semi")
    named = nearest.nearest_place(v, places(s, d), "event_id", "place", 15000.0).join(places(s, d).select("place", "role"), "place").select("event_id", "role")
    nth = F.row_number().over(Window.partitionBy("user_id").orderBy("t", "event_id"))
    return v.join(named, "event_id", "left").withColumn("nth", nth).select("user_id", "nth", "event_id", F.coalesce("role", F.lit("somewhere")).alias("label"))


@register("highlights", "SELECT kind, event_id FROM (SELECT event_type AS kind, event_id, row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS n FROM events WHERE event_type IN ('view', 'purchase', 'error')) x WHERE n <= 5")
def highlights(s, d):
    e = events(s, d).where(F.col("event_type").isin("view", "purchase", "error"))
    return vectors.top_k(e.select(F.col("event_type").alias("kind"), "event_id", "value"), ["kind"], 5, "value", "event_id").select("kind", "event_id")


@register("identity_linking", f"""WITH RECURSIVE {CENTROIDS}, scored AS (SELECT vec_id, proto, {cosine_sql('embedding', 'c')} AS score FROM embeddings, centroids WHERE proto < 5),
 found AS (SELECT vec_id, proto, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto) AS n FROM scored WHERE score >= 0.35) x WHERE n = 1),
 rest AS (SELECT * FROM embeddings WHERE vec_id NOT IN (SELECT vec_id FROM found)),
 p AS (SELECT x.vec_id AS a, y.vec_id AS b, {cosine_sql('x.embedding', 'y.embedding')} AS score FROM rest x JOIN rest y ON x.vec_id < y.vec_id WHERE {cosine_sql('x.embedding', 'y.embedding')} >= 0.35),
 e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(id, n) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.n), m AS (SELECT id, min(n) AS component FROM r GROUP BY id),
 g AS (SELECT component, md5(string_agg(CAST(id AS VARCHAR), '|' ORDER BY CAST(id AS VARCHAR))) AS cluster_id, count(*) AS size FROM m GROUP BY 1),
 i AS (SELECT component, count(*) AS n, min(score) AS least FROM p JOIN m ON p.a = m.id GROUP BY 1),
 f AS (SELECT cluster_id, size, CASE WHEN n = size * (size - 1) / 2 THEN least ELSE 0 END AS confidence FROM g JOIN i USING (component))
 SELECT cluster_id, size, round(confidence, 6) AS confidence, CASE WHEN confidence >= 0.36 THEN 'confirmed' ELSE 'tentative' END AS status FROM f
 UNION ALL SELECT 'known-' || proto, count(*), round(min(score), 6), 'confirmed' FROM found GROUP BY proto""")
def identity_linking(s, d):
    """Fetch, prefilter against known prototypes, cluster the rest, finish clusters."""
    e = emb(s, d)
    known = vectors.weighted_mean(e.where("label < 5"), ["label"], "embedding").withColumnRenamed("label", "proto")
    found = graph.checkpointed(vectors.assign(e, known, 0.35, "vec_id", "proto"))
    rest = e.join(found, "vec_id", "left_anti")
    pairs = graph.checkpointed(vectors.near_duplicate_pairs(rest, 0.35, "vec_id"))
    members = graph.connected_components(pairs, "a", "b").withColumnRenamed("component", "label")
    done = vectors.finished_clusters(members, pairs, "label", "id", 0.36)
    old = found.groupBy("proto").agg(F.count("*").alias("size"), F.min("score").alias("confidence")).select(F.concat(F.lit("known-"), F.col("proto").cast("string")).alias("cluster_id"), "size", "confidence", F.lit("confirmed").alias("status"))
    return done.unionByName(old).withColumn("confidence", F.round("confidence", 6))


@register("life_timeline", """WITH day AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type, count(*) AS n FROM events GROUP BY 1, 2), t AS (SELECT day, arg_min(event_type, (-n, event_type)) AS place, max(n) AS pings, CAST(sum(n) AS BIGINT) AS total FROM day GROUP BY day)
 SELECT day, place, pings, total, lead(day) OVER (ORDER BY day) AS next_day FROM t""")
def life_timeline(s, d):
    from meridian.operators import aggregates

    e = events(s, d).withColumn("day", F.to_date("ts").cast("string"))
    best = aggregates.dominant(e, ["day"], "event_type", F.lit(1)).select("day", F.col("event_type").alias("place"), F.col("weight").cast("long").alias("pings"))
    total = e.groupBy("day").agg(F.count("*").alias("total"))
    return best.join(total, "day").withColumn("next_day", F.lead("day").over(Window.orderBy("day")))


@register("transcript_ingest", """WITH w AS (SELECT conv_id, turn, turn * 10e0 AS start, turn * 10e0 + 12 AS stop FROM conversations), o AS (SELECT *, max(stop) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS m FROM w)
 SELECT conv_id, count(*) AS segments, count(*) FILTER (start < m) AS out_of_order, max(stop) AS ended FROM o GROUP BY conv_id""")
def transcript_ingest(s, d):
    c = conv(s, d).select("conv_id", "turn", (F.col("turn") * 10.0).alias("start"), (F.col("turn") * 10.0 + 12).alias("stop"), "text")
    clean = intervals.clean_segments(c, "start", "stop")
    late = intervals.out_of_order(clean, ["conv_id"], "turn", "start", "stop")
    return clean.groupBy("conv_id").agg(F.count("*").alias("segments"), F.max("stop").alias("ended")).join(late, "conv_id")


@register("year_contrast", "SELECT p_brand, CAST(min(year(o_orderdate)) AS INTEGER) AS first, CAST(max(year(o_orderdate)) AS INTEGER) AS last, arg_min(p_name, (-length(p_name), p_name)) AS longest FROM part JOIN lineitem ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey GROUP BY p_brand")
def year_contrast(s, d):
    j = part(s, d).join(lineitem(s, d), F.col("p_partkey") == F.col("l_partkey")).join(orders(s, d), F.col("o_orderkey") == F.col("l_orderkey"))
    best = F.min(F.struct((-F.length("p_name")).alias("n"), "p_name"))
    return j.groupBy("p_brand").agg(F.min(F.year("o_orderdate")).alias("first"), F.max(F.year("o_orderdate")).alias("last"), best.getField("p_name").alias("longest"))


@register("pricing_summary", """SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, round(avg(l_discount), 6) AS avg_disc, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '2000-09-02' GROUP BY 1, 2""")
def pricing_summary(s, d):
    li = lineitem(s, d).where(F.col("l_shipdate") <= F.lit("2000-09-02").cast("timestamp_ntz"))
    return li.groupBy("l_returnflag", "l_linestatus").agg(F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"), F.round(F.avg("l_discount"), 6).alias("avg_disc"), F.count("*").alias("n"))

