"""Queries of the composite operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import composites, graph, vectors
from meridian.plans.base import EVENTS, cosine_sql, events, load
from meridian.plans.registry import register
from meridian.plans.vector_queries import SEED, _seed

part, orders, docs, conv, emb, lineitem = (load(n) for n in ("part", "orders", "documents", "conversations", "embeddings", "lineitem"))


@register("fuzzy_key_join", """WITH l AS (SELECT p_partkey, 'key' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS k FROM part),
 r AS (SELECT 'key' || lpad(CAST(p_partkey AS VARCHAR), 6, '0') || CASE WHEN p_partkey % 3 = 0 THEN '_x' ELSE '' END AS k, 'a/' || p_partkey AS path FROM part WHERE p_size % 5 <> 0)
 SELECT l.p_partkey, r.path FROM l LEFT JOIN r ON contains(r.k, l.k)""")
def fuzzy_key_join(s, d):
    p = part(s, d)
    key = F.concat(F.lit("key"), F.lpad(F.col("p_partkey").cast("string"), 6, "0"))
    right = p.where("p_size % 5 <> 0").select(F.concat(key, F.when(F.col("p_partkey") % 3 == 0, "_x").otherwise("")).alias("rk"), F.concat(F.lit("a/"), F.col("p_partkey").cast("string")).alias("path"))
    return composites.fuzzy_key_join(p.select("p_partkey", key.alias("k")), right, "k", "rk", "path").select("p_partkey", "path")


@register("owner_fan_out", "SELECT 'owner' AS owner, user_id FROM (SELECT DISTINCT user_id FROM events) u WHERE user_id % 4 <> 0")
def owner_fan_out(s, d):
    e = events(s, d)
    have = e.where("user_id % 4 = 0").select(F.lit("owner").alias("owner"), "user_id")
    return composites.fan_out(e, have, "user_id", "owner")


@register("plan_lookup", """WITH p AS (SELECT o_custkey AS plan, list(o_orderkey) AS members FROM orders GROUP BY 1), i AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 7 END AS plan FROM orders)
 SELECT i.o_orderkey, coalesce(i.plan, o.o_custkey) AS plan FROM i JOIN orders o USING (o_orderkey)""")
def plan_lookup(s, d):
    o = orders(s, d)
    plans = o.groupBy(F.col("o_custkey").alias("plan")).agg(F.collect_list("o_orderkey").alias("members")).withColumn("nth", F.col("plan"))
    items = o.select("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.lit(7).cast("long")).alias("plan"))
    return composites.from_plan(items, plans, "o_orderkey", "members", "nth", ["plan"])


@register("calendar_fill")
def calendar_fill(s, d):
    slots = part(s, d).select("p_brand", F.col("p_partkey").alias("slot"), F.concat(F.lit("t"), F.col("p_size") % 5).alias("topic"))
    shorts = part(s, d).select("p_brand", F.col("p_partkey").cast("string").alias("short_id"), F.concat(F.lit("t"), F.col("p_partkey") % 7).alias("topic"), F.col("p_size").alias("place"))
    return composites.calendar(slots, shorts, ["p_brand"])


@register("audio_quality", """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings), q AS (SELECT vec_id, sqrt(list_sum(list_transform(x, lambda y: y * y)) / len(x)) AS rms, list_sort(list_transform(x, lambda y: abs(y)))[greatest(1, CAST(ceil(len(x) * 0.2) AS INTEGER))] AS noise FROM v)
 SELECT vec_id, round(rms, 6) AS rms, round(20 * log10(rms / noise), 4) AS snr_db, round(greatest(0.5, least(2, 20 * log10(rms / noise) / 20)), 6) AS weight FROM q""")
def audio_quality(s, d):
    q = composites.audio_quality(F.col("embedding").cast("array<double>"))
    return emb(s, d).select("vec_id", q.alias("q")).select("vec_id", F.round("q.rms", 6).alias("rms"), F.round("q.snr_db", 4).alias("snr_db"), F.round("q.weight", 6).alias("weight"))


@register("hook_scores", r"SELECT doc_id, CASE WHEN contains(lower(text), 'the real') OR contains(lower(text), 'idiot') THEN 40 ELSE 0 END + CASE WHEN contains(text, '?') THEN 25 ELSE 0 END + CASE WHEN regexp_matches(text, '\d') THEN 20 ELSE 0 END + CASE WHEN length(text) <= 90 THEN 15 ELSE 0 END AS score FROM documents")
def hook_scores(s, d):
    return docs(s, d).select("doc_id", composites.hook_score(F.col("text"), ["the real", "idiot"]).alias("score"))


TEMPLATES = {"view": ["look at %", "see %"], "click": ["try %", "tap %", "press %"], "other": ["about %"]}


@register("hook_templates", "SELECT event_id, CASE event_type WHEN 'view' THEN (['look at %', 'see %'])[event_id % 2 + 1] WHEN 'click' THEN (['try %', 'tap %', 'press %'])[event_id % 3 + 1] ELSE 'about %' END AS template FROM events")
def hook_templates(s, d):
    return events(s, d).select("event_id", composites.hook_template(F.col("event_type"), F.col("event_id"), TEMPLATES, "other").alias("template"))


@register("hashed_embedding")
def hashed_embedding(s, d):
    return conv(s, d).select("conv_id", "turn", F.transform(composites.hashed_embedding(F.col("text"), 16), lambda v: F.round(v, 6)).alias("embedding"))


@register("entity_patterns", r"""WITH f AS (SELECT doc_id, 'Email' AS label, unnest(regexp_extract_all(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}')) AS entity FROM documents
 UNION ALL SELECT doc_id, 'Url', unnest(regexp_extract_all(text, 'https?://[^\s"''<>]+')) FROM documents) SELECT doc_id, label, entity, count(*) AS n FROM f GROUP BY 1, 2, 3""")
def entity_patterns(s, d):
    return composites.entities(docs(s, d), "doc_id", "text", composites.ENTITIES[:2])


@register("recall_media", f"SELECT id, round(score, 6) AS score FROM (SELECT vec_id AS id, label, '2024-01-' || lpad(CAST(vec_id % 28 + 1 AS VARCHAR), 2, '0') AS date, {cosine_sql('embedding', SEED)} AS score FROM embeddings) x WHERE label % 2 = 0 AND date >= '2024-01-05' AND date <= '2024-01-20' AND id IN (SELECT event_id FROM events WHERE event_type <> 'error') ORDER BY x.score DESC, id LIMIT 12")
def recall_media(s, d):
    e = emb(s, d)
    media = e.select(F.col("vec_id").alias("id"), "embedding", F.when(F.col("label") % 2 == 0, "photo").otherwise("video").alias("kind"), F.concat(F.lit("2024-01-"), F.lpad((F.col("vec_id") % 28 + 1).cast("string"), 2, "0")).alias("date"))
    at = load("events")(s, d).where("event_type <> 'error'").select(F.col("event_id").alias("id"))
    return composites.recall(media, _seed(e), 12, "photo", "2024-01-05", "2024-01-20", at).select("id", F.round("score", 6).alias("score"))


@register("curate_topic", """WITH b AS (SELECT p_type AS item, count(DISTINCT l_orderkey) AS support FROM part JOIN lineitem ON p_partkey = l_partkey WHERE p_size < 10 GROUP BY 1 ORDER BY support DESC, item LIMIT 4),
 c AS (SELECT p_type AS item, p_name AS text, row_number() OVER (PARTITION BY p_type ORDER BY p_partkey) AS n FROM part) SELECT b.item, b.support, (SELECT list(text ORDER BY n) FROM c WHERE c.item = b.item AND n <= 3) AS texts FROM b""")
def curate_topic(s, d):
    p = part(s, d)
    items = p.where("p_size < 10").join(lineitem(s, d), F.col("p_partkey") == F.col("l_partkey")).select(F.col("p_type").alias("item"), "l_orderkey")
    chunks = p.select(F.col("p_type").alias("item"), F.col("p_partkey").alias("chunk"), F.col("p_name").alias("text"))
    return composites.curated(items, "item", "l_orderkey", chunks, 4, 3)


@register("patched_minutes", f"""WITH v AS (SELECT vec_id, vec_id // 60 AS minute, CASE WHEN vec_id % 3 = 0 THEN [1e0, 2e0] ELSE list_transform(embedding[9:10], lambda x: CAST(x AS DOUBLE)) END AS tail FROM embeddings)
 SELECT minute, round(avg(tail[1]), 6) AS a, round(avg(tail[2]), 6) AS b FROM v GROUP BY minute""")
def patched_minutes(s, d):
    sec = emb(s, d).select("vec_id", F.expr("vec_id div 60").alias("minute"), F.slice("embedding", 1, 10).cast("array<double>").alias("vec"))
    found = sec.where("vec_id % 3 = 0").select("vec_id", F.array(F.lit(1.0), F.lit(2.0)).alias("loc"))
    _, minutes = composites.patched_locations(sec, found, ["vec_id"], 2)
    return minutes.select("minute", F.round(F.col("embedding")[8], 6).alias("a"), F.round(F.col("embedding")[9], 6).alias("b"))


@register("validated_points", f"SELECT event_id, event_id % 5 <> 0 AND event_id % 2 = 0 AS agrees FROM {EVENTS} e WHERE event_type = 'view'")
def validated_points(s, d):
    v = events(s, d).where("event_type = 'view'").select("event_id", "lat", "lon")
    other = v.where("event_id % 5 <> 0").withColumn("lat", F.col("lat") + F.when(F.col("event_id") % 2 == 0, 0.0001).otherwise(0.01))
    return composites.validated(v, other, "event_id", 50.0).select("event_id", "agrees")


@register("seed_resolution", f"SELECT vec_id, round({cosine_sql('embedding', '(SELECT embedding FROM embeddings WHERE vec_id = 7)')}, 6) AS score FROM embeddings WHERE vec_id <> 7 ORDER BY score DESC, vec_id LIMIT 5")
def seed_resolution(s, d):
    e = emb(s, d)
    q = vectors.seed_vector(e, [F.col("vec_id") == -1, F.col("vec_id") == 7, F.col("vec_id") == 8], ["embedding"]) or []
    return vectors.knn(e, q, 5, "vec_id", exclude=7).select("vec_id", F.round("score", 6).alias("score"))


@register("community_samples", "WITH c AS (SELECT vec_id AS id, label AS component FROM embeddings), t AS (SELECT component FROM c GROUP BY 1 ORDER BY count(*) DESC, component LIMIT 3), r AS (SELECT component, id, row_number() OVER (PARTITION BY component ORDER BY id) AS n FROM c JOIN documents ON doc_id = id WHERE component IN (SELECT component FROM t)) SELECT component, CAST(n AS INTEGER) AS nth, text FROM r JOIN documents ON doc_id = id WHERE n <= 2")
def community_samples(s, d):
    c = emb(s, d).select(F.col("vec_id").alias("id"), F.col("label").alias("component"))
    texts = docs(s, d).select(F.col("doc_id").alias("id"), "text")
    return graph.community_samples(c, texts, 3, 2)


_FORMS = ("yyyy_MMdd_HHmmss", "yyyyMMdd_HHmmss", "yyyyMMddHHmmss", "yyyy-MM-dd_HH-mm-ss", "yyyy_MM_dd_HH_mm_ss", "'/m/'yyyy/MM/dd/'a_'HHmmss'.mp4'", "yyyy-MM-dd")


@register("key_times", f"SELECT event_id, CASE WHEN event_id % {len(_FORMS)} < {len(_FORMS) - 1} THEN date_trunc('second', ts)::TIMESTAMP END AS at FROM events e")
def key_times(s, d):
    nth = F.col("event_id") % len(_FORMS)
    key = F.coalesce(*[F.when(nth == i, F.concat(F.lit("clip_"), F.date_format("ts", form), F.lit("_FR"))) for i, form in enumerate(_FORMS)])
    return events(s, d).select("event_id", X.key_time(key).cast("timestamp_ntz").alias("at"))
