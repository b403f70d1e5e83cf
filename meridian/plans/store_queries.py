"""Queries of moves, stores, links, versions and query tools."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.operators import search, tools, upsert
from meridian.plans.base import load, seconds
from meridian.plans.registry import register
from meridian.plans.text_queries import WORDS
from meridian.sources import writers

part, supplier, orders, lineitem, customer, conv, ev = (load(n) for n in ("part", "supplier", "orders", "lineitem", "customer", "conversations", "events"))

_MOVES = """files AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 11 = 0 THEN 'd/f' || p_partkey % 70 || '.txt' ELSE 's/' || p_partkey END AS path, 'd/f' || p_partkey % 70 || '.txt' AS dst, p_size AS size, p_brand AS hash FROM part),
 there AS (SELECT 'd/f' || s_suppkey || '.txt' AS path, s_suppkey % 50 AS size, CAST(NULL AS VARCHAR) AS hash FROM supplier UNION ALL SELECT 'd/f' || s_suppkey || '_' || s_suppkey % 5 || '.txt', 1, 'x' FROM supplier),
 r AS (SELECT f.*, t.path AS e, t.size AS tsize, t.hash AS thash, row_number() OVER (PARTITION BY dst ORDER BY (f.path <> f.dst)::INT, id) AS nth FROM files f LEFT JOIN there t ON t.path = f.dst)"""


def _files(s, d):
    p, u = part(s, d), supplier(s, d)
    dst = F.concat(F.lit("d/f"), F.col("p_partkey") % 70, F.lit(".txt"))
    files = p.select(F.col("p_partkey").alias("id"), F.when(F.col("p_partkey") % 11 == 0, dst).otherwise(F.concat(F.lit("s/"), F.col("p_partkey"))).alias("path"), dst.alias("dst"), F.col("p_size").alias("size"), F.col("p_brand").alias("hash"))
    k = F.col("s_suppkey")
    plain = u.select(F.concat(F.lit("d/f"), k, F.lit(".txt")).alias("path"), (k % 50).alias("size"), F.lit(None).cast("string").alias("hash"))
    numbered = u.select(F.concat(F.lit("d/f"), k, F.lit("_"), k % 5, F.lit(".txt")).alias("path"), F.lit(1).cast("long").alias("size"), F.lit("x").alias("hash"))
    return files, plain.unionByName(numbered)


@register("move_collisions", f"""WITH {_MOVES} SELECT id, CASE WHEN path = dst THEN 'same' WHEN e IS NULL AND nth = 1 THEN 'move' WHEN coalesce(size = tsize AND coalesce(hash = thash, true), false) THEN 'duplicate' ELSE 'exists' END AS action,
 CASE WHEN path <> dst AND e IS NULL AND nth = 1 THEN dst END AS final FROM r""")
def move_collisions(s, d):
    return upsert.file_moves(*_files(s, d), "skip").select("id", "action", "final")


@register("move_renames", f"""WITH {_MOVES}, names AS (SELECT path AS p FROM there UNION SELECT dst FROM files), used AS (SELECT DISTINCT regexp_replace(p, '_[1-9][0-9]*\\.txt$', '') AS stem, TRY_CAST(regexp_extract(p, '_([1-9][0-9]*)\\.txt$', 1) AS BIGINT) AS n FROM names WHERE regexp_matches(p, '_[1-9][0-9]*\\.txt$')),
 need AS (SELECT id, dst[:-5] AS stem, row_number() OVER (PARTITION BY dst ORDER BY nth) AS o FROM r WHERE path <> dst AND (e IS NOT NULL OR nth > 1)),
 free AS (SELECT stem, g, row_number() OVER (PARTITION BY stem ORDER BY g) AS o FROM (SELECT stem, unnest(range(1, count(*) + 20)) AS g FROM need GROUP BY stem) x WHERE NOT EXISTS (SELECT 1 FROM used WHERE used.stem = x.stem AND used.n = x.g))
 SELECT id, CASE WHEN path = dst THEN 'same' WHEN f.g IS NULL THEN 'move' ELSE 'rename' END AS action, CASE WHEN path = dst THEN NULL WHEN f.g IS NULL THEN dst ELSE f.stem || '_' || f.g || '.txt' END AS final
 FROM r LEFT JOIN need USING (id) LEFT JOIN free f ON f.stem = need.stem AND f.o = need.o""")
def move_renames(s, d):
    return upsert.file_moves(*_files(s, d), "rename").select("id", "action", "final")


@register("pending_intents", """SELECT o_orderkey AS op FROM orders WHERE o_orderstatus <> 'F' AND o_orderkey % 7 < 3 AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""")
def pending_intents(s, d):
    intents = orders(s, d).select(F.col("o_orderkey").alias("op"), F.when(F.col("o_orderstatus") == "F", "done").otherwise("new").alias("status"), (F.col("o_orderkey") % 7).alias("tries"))
    landed = lineitem(s, d).where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("op"))
    return upsert.pending_intents(intents, landed, "op", 3).select("op")


@register("link_table_join", "SELECT c_custkey, o_orderkey, o_totalprice, round(o_orderkey % 997 / 997e0, 6) AS score FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderkey % 997 / 997e0 >= 0.5")
def link_table_join(s, d):
    o = orders(s, d)
    links = o.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", (F.col("o_orderkey") % 997 / F.lit(997.0)).alias("score"))
    return upsert.linked(customer(s, d).select("c_custkey"), links, o.select("o_orderkey", "o_totalprice"), "c_custkey", "o_orderkey", 0.5).select("c_custkey", "o_orderkey", "o_totalprice", F.round("score", 6).alias("score"))


@register("schema_normalise", "SELECT event_id, CASE WHEN event_id % 4 = 3 THEN event_type ELSE upper(event_type) END AS event_type, 2 AS schema_version FROM events")
def schema_normalise(s, d):
    k = F.col("event_id") % 4
    rows = ev(s, d).select("event_id", "event_type", F.when(k == 3, 2).when(k > 0, 1).cast("int").alias("schema_version"))
    return upsert.normalised(rows, 2, lambda old: old.withColumn("event_type", F.upper("event_type")))


_SAID = "conv_id * 1000 + turn"


@register("index_mirror", f"""WITH c AS (SELECT {_SAID} AS id, CASE WHEN turn % 2 = 0 THEN text || ' amended' ELSE text END AS text FROM conversations), t AS (SELECT id, unnest({WORDS}) AS term FROM c)
 SELECT term, id, count(*) AS tf FROM t GROUP BY 1, 2""")
def index_mirror(s, d):
    c = conv(s, d).select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "turn", "text")
    changed = c.where("turn % 2 = 0").select("id", F.concat("text", F.lit(" amended")).alias("text"))
    return writers.mirrored_index(search.inverted_index(c), changed).select("term", "id", "tf")


def _toolbox(s, d) -> tools.Toolbox:
    c = conv(s, d)
    sid = (F.col("conv_id") * 1000 + F.col("turn")).alias("id")
    spoken = c.where("role = 'user'").select(sid, "text", F.timestamp_seconds(F.col("conv_id") * 3600 + F.col("turn") * 60).alias("ts"), (F.col("conv_id") * 3600.0 + F.col("turn") * 60).alias("t"), F.when(F.col("conv_id") % 4 == 0, F.concat(F.lit("place "), F.col("conv_id") % 12)).alias("place"))
    written = c.where("role <> 'user'").select(sid, "text", F.timestamp_seconds(F.col("conv_id") * 3600 + F.col("turn") * 60).alias("ts"))
    concepts = spoken.select("id", F.concat(F.lit("topic "), F.length("text") % 10).alias("concept"), (F.col("id") % 97 / F.lit(97.0)).alias("score"))
    stays = ev(s, d).select((seconds("ts") - 1704067200.0).alias("t"), F.concat(F.lit("place "), F.col("user_id") % 15).alias("place"))
    return tools.personal_toolbox(spoken, written, concepts, stays)


@register("tool_said_about", f"SELECT {_SAID} AS id, 'topic ' || length(text) % 10 AS concept, round(({_SAID}) % 97 / 97e0, 3) AS score FROM conversations WHERE role = 'user' AND contains('topic ' || length(text) % 10, 'topic 3') ORDER BY ({_SAID}) % 97 DESC, id LIMIT 100")
def tool_said_about(s, d):
    return _toolbox(s, d).call("said_about", concept=" topic 3", limit=1000).select("id", "concept", "score")


@register("tool_said_at", f"SELECT {_SAID} AS id, 'place ' || conv_id % 12 AS place FROM conversations WHERE role = 'user' AND conv_id % 4 = 0 AND contains('place ' || conv_id % 12, 'place 8') ORDER BY id LIMIT 20")
def tool_said_at(s, d):
    return _toolbox(s, d).call("said_at", place="place 8", limit=20).select("id", "place")


@register("tool_said_near", f"""WITH u AS (SELECT {_SAID} AS id, conv_id * 3600e0 + turn * 60 AS t FROM conversations WHERE role = 'user' AND conv_id % 4 <> 0), s AS (SELECT epoch_us(ts) / 1e6 - 1704067200e0 AS t, 'place ' || user_id % 15 AS place FROM events)
 SELECT id, arg_min(place, (abs(u.t - s.t), place)) AS place FROM u JOIN s ON abs(u.t - s.t) <= 3600 AND contains(s.place, 'place 13') GROUP BY id ORDER BY min(abs(u.t - s.t)), id LIMIT 20""")
def tool_said_near(s, d):
    return _toolbox(s, d).call("said_at", place="place 13", limit=20).select("id", "place")


@register("tool_activity_on", f"""WITH c AS (SELECT {_SAID} AS id, role, conv_id * 3600 + turn * 60 AS t, CASE WHEN role = 'user' THEN 'said' ELSE 'wrote' END AS kind FROM conversations),
 r AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY t, id) AS n FROM c WHERE t // 86400 = 1) SELECT kind, id FROM r WHERE n <= 15""")
def tool_activity_on(s, d):
    return _toolbox(s, d).call("activity_on", day="1970/01/02", limit=15).select("kind", "id")


@register("tool_timeline", "SELECT 'place ' || user_id % 15 AS place, count(*) AS n FROM events GROUP BY 1")
def tool_timeline(s, d):
    return _toolbox(s, d).call("timeline", limit=200).select("place", "n")
