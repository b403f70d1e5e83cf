"""Vector search, clustering and retrieval queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meridian.functions import exprs as X
from meridian.operators import graph, search, vectors
from meridian.plans.base import cosine_sql, load
from meridian.plans.registry import register

emb = load("embeddings")


def _seed(e, vec_id: int = 0) -> list[float]:
    row = e.where(F.col("vec_id") == vec_id).first()
    return list(row.embedding) if row else []


def _rounded(df, *cols, n: int = 6):
    for c in cols:
        df = df.withColumn(c, F.round(c, n))
    return df


SEED = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"
SCORED = f"SELECT vec_id, label, round({cosine_sql('embedding', SEED)}, 6) AS score FROM embeddings"


@register("knn_topk", f"SELECT vec_id, label, score FROM ({SCORED}) x ORDER BY score DESC, vec_id LIMIT 10")
def knn_topk(s, d):
    e = emb(s, d)
    return _rounded(vectors.knn(e, _seed(e), 10, "vec_id").select("vec_id", "label", "score"), "score")


@register("knn_exclude_seed", f"SELECT vec_id, label, score FROM ({SCORED}) x WHERE vec_id <> 0 ORDER BY score DESC, vec_id LIMIT 10")
def knn_exclude_seed(s, d):
    e = emb(s, d)
    return _rounded(vectors.knn(e, _seed(e), 10, "vec_id", exclude=0).select("vec_id", "label", "score"), "score")


@register("knn_prefilter", f"SELECT vec_id, label, score FROM ({SCORED}) x WHERE label IN (1, 2) ORDER BY score DESC, vec_id LIMIT 8")
def knn_prefilter(s, d):
    e = emb(s, d)
    return _rounded(vectors.knn(e, _seed(e), 8, "vec_id", where=F.col("label").isin(1, 2)).select("vec_id", "label", "score"), "score")


@register("knn_overfetch", f"SELECT * FROM (SELECT vec_id, label, score FROM ({SCORED}) x ORDER BY score DESC, vec_id LIMIT 32) y WHERE label IN (1, 2) ORDER BY score DESC, vec_id LIMIT 8")
def knn_overfetch(s, d):
    e = emb(s, d)
    return _rounded(vectors.knn_overfetch(e, _seed(e), 8, F.col("label").isin(1, 2), 4, "vec_id").select("vec_id", "label", "score"), "score")


CENTROIDS = """centroids AS (
  SELECT label AS proto, list(s ORDER BY i) AS c, max(n) AS n FROM (
    SELECT label, i, sum(CAST(x AS DOUBLE)) AS s, count(*) AS n FROM (
      SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) u GROUP BY label, i) v
  GROUP BY label)"""


@register("label_centroid", f"WITH {CENTROIDS} SELECT proto AS label, round({cosine_sql('c', SEED)}, 6) AS seed_score, CAST(n AS DOUBLE) AS weight_sum FROM centroids")
def label_centroid(s, d):
    e = emb(s, d)
    c = vectors.weighted_mean(e, ["label"], "embedding")
    q = F.array(*[F.lit(x) for x in _seed(e)])
    return c.select("label", F.round(X.cosine(F.col("embedding"), q), 6).alias("seed_score"), "weight_sum")


@register("centroid_assign", f"""WITH {CENTROIDS}, scored AS (SELECT vec_id, proto, {cosine_sql('embedding', 'c')} AS score FROM embeddings, centroids),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto) AS n FROM scored WHERE score >= 0.3)
 SELECT vec_id, proto, round(score, 6) AS score FROM r WHERE n = 1""")
def centroid_assign(s, d):
    e = emb(s, d)
    protos = vectors.weighted_mean(e, ["label"], "embedding").withColumnRenamed("label", "proto")
    return _rounded(vectors.assign(e, protos, 0.3, "vec_id", "proto"), "score")


@register("knn_join_threshold", f"""WITH {CENTROIDS}, scored AS (SELECT vec_id, proto, {cosine_sql('embedding', 'c')} AS score FROM embeddings, centroids),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto) AS n FROM scored WHERE score >= 0.1)
 SELECT vec_id, proto, round(score, 6) AS score, CAST(n AS INTEGER) AS rank FROM r WHERE n <= 3""")
def knn_join_threshold(s, d):
    e = emb(s, d)
    protos = vectors.weighted_mean(e, ["label"], "embedding").withColumnRenamed("label", "proto")
    return _rounded(vectors.similarity_join(e, protos, 3, 0.1, "vec_id", "proto"), "score")


@register("adaptive_identify", f"""WITH {CENTROIDS}, best AS (
  SELECT vec_id, proto, score, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto) AS n FROM (
    SELECT vec_id, proto, {cosine_sql('embedding', 'c')} AS score FROM embeddings, centroids) x)
 SELECT vec_id, 'L' || proto AS name, round(score, 6) AS score, 0.3e0 AS threshold,
        CASE WHEN score >= 0.35 THEN 'match' WHEN score >= 0.3 THEN 'weak' ELSE 'none' END AS verdict FROM best WHERE n = 1""")
def adaptive_identify(s, d):
    e = emb(s, d)
    protos = vectors.weighted_mean(e, ["label"], "embedding").withColumnRenamed("label", "proto").withColumn("name", F.concat(F.lit("L"), F.col("proto").cast("string")))
    return _rounded(vectors.identify(e, protos, "vec_id", "proto", "name", 0.3, 0.4), "score").select("vec_id", "name", "score", "threshold", "verdict")


@register("near_dup_pairs", f"""SELECT x.label, x.vec_id AS a, y.vec_id AS b, round({cosine_sql('x.embedding', 'y.embedding')}, 6) AS score
 FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id < y.vec_id WHERE {cosine_sql('x.embedding', 'y.embedding')} >= 0.35""")
def near_dup_pairs(s, d):
    return _rounded(vectors.near_duplicate_pairs(emb(s, d), 0.35, "vec_id", by=["label"]), "score")


@register("prototype_update", f"""WITH {CENTROIDS}, scored AS (SELECT vec_id, proto, {cosine_sql('embedding', 'c')} AS score FROM embeddings, centroids),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, proto) AS n FROM scored WHERE score >= 0.35)
 SELECT c.proto, CAST(c.n AS DOUBLE) + count(r.vec_id) AS weight_sum, count(r.vec_id) AS added,
        CASE WHEN coalesce(min(r.score), 1) >= 0.4 THEN 'confirmed' ELSE 'tentative' END AS status
 FROM centroids c LEFT JOIN r ON r.proto = c.proto AND r.n = 1 GROUP BY c.proto, c.n""")
def prototype_update(s, d):
    e = emb(s, d)
    protos = vectors.weighted_mean(e, ["label"], "embedding").withColumnRenamed("label", "proto")
    found = vectors.assign(e, protos, 0.35, "vec_id", "proto")
    return vectors.updated_prototypes(protos, found, e, "vec_id", "proto", 0.4).select("proto", "weight_sum", "added", "status")


@register("vector_minute_sum", """SELECT m AS minute, list(s ORDER BY i) AS embedding FROM (
   SELECT m, i, round(sum(CAST(x AS DOUBLE)), 6) AS s FROM (
     SELECT vec_id // 60 AS m, unnest(embedding[1:7]) AS x, generate_subscripts(embedding[1:7], 1) AS i FROM embeddings) u GROUP BY m, i) v GROUP BY m""")
def vector_minute_sum(s, d):
    e = emb(s, d).select(F.expr("vec_id div 60").alias("minute"), F.slice("embedding", 1, 7).alias("embedding"))
    return vectors.vector_sum(e, ["minute"], "embedding").withColumn("embedding", F.transform("embedding", lambda x: F.round(x, 6)))


@register("gated_match", f"""WITH p AS (SELECT x.vec_id AS a, y.vec_id AS b, round({cosine_sql('x.embedding[1:32]', 'y.embedding[1:32]')}, 6) AS appearance,
   round({cosine_sql('x.embedding[33:64]', 'y.embedding[33:64]')}, 6) AS trajectory
   FROM embeddings x JOIN embeddings y ON x.label = y.label AND x.vec_id <> y.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY appearance DESC, b) AS n FROM p WHERE appearance >= 0.3 AND trajectory >= 0.2)
 SELECT a, b, appearance, trajectory FROM r WHERE n = 1""")
def gated_match(s, d):
    e = emb(s, d)
    first = vectors.near_duplicate_pairs(e.select("label", "vec_id", F.slice("embedding", 1, 32).alias("half")), 0.3 - 1e-6, "vec_id", "half", ["label"])
    other = e.select("vec_id", F.slice("embedding", 33, 32).alias("v"))
    of = lambda name, v: other.select(F.col("vec_id").alias(name), F.col("v").alias(v))
    pairs = first.join(of("a", "va"), "a").join(of("b", "vb"), "b").select("a", "b", F.round("score", 6).alias("appearance"), F.round(X.cosine(F.col("va"), F.col("vb")), 6).alias("trajectory"))
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "appearance", "trajectory"))
    return vectors.gated_match(both, at_first=0.3, at_second=0.2)


@register("priority_members", f"""WITH seed AS (SELECT vec_id, embedding FROM embeddings WHERE label = 3 ORDER BY vec_id LIMIT 20),
 c AS (SELECT list(s ORDER BY i) AS c FROM (SELECT i, sum(CAST(x AS DOUBLE)) AS s FROM (
   SELECT unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM seed) u GROUP BY i) v),
 top AS (SELECT vec_id, {cosine_sql('embedding', 'c.c')} AS score FROM embeddings, c WHERE label <> 3 ORDER BY score DESC, vec_id LIMIT 15)
 SELECT vec_id, round(score, 6) AS score FROM top WHERE score >= 0.1""")
def priority_members(s, d):
    e = emb(s, d).withColumn("w", F.lit(1.0))
    return _rounded(vectors.priority_members(e, F.col("label") == 3, "vec_id", "w", 0.1, 15), "score")


_AGREE = f"""WITH s AS (SELECT q.vec_id AS q, c.vec_id AS i, {cosine_sql('q.embedding', 'c.embedding')} AS full_score,
   {cosine_sql('q.embedding[1:32]', 'c.embedding[1:32]')} AS half_score FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
 g AS (SELECT q, i, row_number() OVER (PARTITION BY q ORDER BY half_score DESC, i) AS r FROM s),
 f AS (SELECT q, i, row_number() OVER (PARTITION BY q ORDER BY full_score DESC, i) AS r FROM s),
 b AS (SELECT coalesce(g.q, f.q) AS q, g.r AS gr, f.r AS fr FROM (SELECT * FROM g WHERE r <= 10) g FULL JOIN (SELECT * FROM f WHERE r <= 10) f ON g.q = f.q AND g.i = f.i)
 SELECT q AS query, round(sum(CASE WHEN gr IS NOT NULL AND fr IS NOT NULL THEN 1e0 / log2(gr + 1) ELSE 0 END)
   / (SELECT sum(1e0 / log2(n + 1)) FROM range(1, 11) t(n)), 6) AS ndcg_agreement,
   count(*) FILTER (gr IS NOT NULL AND fr IS NOT NULL) AS overlap,
   round(count(*) FILTER (gr IS NOT NULL AND fr IS NOT NULL) / CAST(count(*) AS DOUBLE), 6) AS jaccard,
   coalesce(max(CASE WHEN gr = 1 AND fr = 1 THEN 1 ELSE 0 END), 0) = 1 AS top1 FROM b GROUP BY q"""


@register("ndcg_overlap", _AGREE)
def ndcg_overlap(s, d):
    e = emb(s, d)
    q = e.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query"), "embedding", F.slice("embedding", 1, 32).alias("half"))
    c = e.select(F.col("vec_id").alias("item"), "embedding", F.slice("embedding", 1, 32).alias("half"))
    ref = vectors.similarity_join(q, c, 11, -1.0, "query", "item", "embedding", "embedding").where("query <> item")
    got = vectors.similarity_join(q, c, 11, -1.0, "query", "item", "half", "half").where("query <> item")
    again = lambda x: vectors.top_k(x.drop("rank"), ["query"], 10, "score", "item")
    return _rounded(vectors.retrieval_agreement(again(got), again(ref), "query", "item", "rank", 10), "ndcg_agreement", "jaccard")


_LINKED = f"""p AS (SELECT x.vec_id AS a, y.vec_id AS b, {cosine_sql('x.embedding', 'y.embedding')} AS score FROM embeddings x JOIN embeddings y ON x.vec_id < y.vec_id WHERE {cosine_sql('x.embedding', 'y.embedding')} >= 0.35),
 e AS (SELECT a, b FROM p UNION SELECT b, a FROM p), r(id, n) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON e.a = r.n),
 c AS (SELECT id, min(n) AS component FROM r GROUP BY id)"""


@register("connected_components", f"WITH RECURSIVE {_LINKED} SELECT id, component FROM c")
def connected_components(s, d):
    pairs = vectors.near_duplicate_pairs(emb(s, d), 0.35, "vec_id")
    return graph.connected_components(pairs, "a", "b")


@register("cluster_finalise", f"""WITH RECURSIVE {_LINKED}, g AS (SELECT component, md5(string_agg(CAST(id AS VARCHAR), '|' ORDER BY CAST(id AS VARCHAR))) AS cluster_id, count(*) AS size FROM c GROUP BY 1),
 i AS (SELECT component, count(*) AS n, min(score) AS least FROM p JOIN c ON p.a = c.id GROUP BY 1),
 f AS (SELECT cluster_id, size, CASE WHEN n = size * (size - 1) / 2 THEN least ELSE 0 END AS confidence FROM g JOIN i USING (component))
 SELECT cluster_id, size, round(confidence, 6) AS confidence, CASE WHEN confidence >= 0.36 THEN 'confirmed' ELSE 'tentative' END AS status FROM f""")
def cluster_finalise(s, d):
    pairs = graph.checkpointed(vectors.near_duplicate_pairs(emb(s, d), 0.35, "vec_id"))
    members = graph.connected_components(pairs, "a", "b").withColumnRenamed("component", "label")
    return _rounded(vectors.finished_clusters(members, pairs, "label", "id", 0.36), "confidence")


@register("kmeans_clusters")
def kmeans_clusters(s, d):
    return vectors.kmeans(emb(s, d), [4, 8], least=5).select("vec_id", "cluster")


@register("federated_merge", f"""WITH s AS ({SCORED}), a AS (SELECT 'even' AS store, vec_id AS id, score FROM s WHERE vec_id % 2 = 0 ORDER BY score DESC, id LIMIT 5),
 b AS (SELECT 'odd' AS store, vec_id AS id, score FROM s WHERE vec_id % 2 = 1 ORDER BY score DESC, id LIMIT 5)
 SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) u ORDER BY score DESC, store, id LIMIT 6""")
def federated_merge(s, d):
    e = emb(s, d)
    q = _seed(e)
    part = lambda k: _rounded(vectors.knn(e.where(F.col("vec_id") % 2 == k), q, 5, "vec_id").select(F.col("vec_id").alias("id"), "score"), "score")
    return search.federated({"even": part(0), "odd": part(1)}, 6)


@register("ab_best_child", f"""WITH p AS (SELECT label AS parent, round(max({cosine_sql('embedding', SEED)}), 6) AS score FROM embeddings GROUP BY label ORDER BY 2 DESC, 1 LIMIT 5),
 c AS (SELECT label AS parent, vec_id AS child_id, round({cosine_sql('embedding[1:32]', SEED + '[1:32]')}, 6) AS s FROM embeddings ORDER BY s DESC, child_id LIMIT 30),
 b AS (SELECT *, row_number() OVER (PARTITION BY parent ORDER BY s DESC, child_id) AS n FROM c)
 SELECT p.parent, p.score, b.child_id, b.s AS child_score FROM p LEFT JOIN b ON b.parent = p.parent AND b.n = 1""")
def ab_best_child(s, d):
    e = emb(s, d)
    q = _seed(e)
    whole, half = F.array(*[F.lit(x) for x in q]), F.array(*[F.lit(x) for x in q[:32]])
    parents = e.groupBy(F.col("label").alias("parent")).agg(F.round(F.max(X.cosine(F.col("embedding"), whole)), 6).alias("score"))
    children = e.select(F.col("label").alias("parent"), F.col("vec_id").alias("child_id"), F.round(X.cosine(F.slice("embedding", 1, 32), half), 6).alias("score"))
    return search.best_child(parents, children, "parent", 5, 30)
