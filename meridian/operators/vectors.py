"""Vector search, joins, centroids and evaluation over ARRAY<FLOAT> columns. Scores are raw cosines in double precision."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from meridian.functions.exprs import cosine, unit

#: A side is broadcast only up to so many bytes, by its rows and its longest vector; beyond that, joins go through blocks.
MOST_BROADCAST = 16 << 20
#: Between a product of matrices and the same sum term by term.
SLACK = 1e-9


def top_k(df: DataFrame, by: list[str], k: int, score: str = "score", tie: str = "id") -> DataFrame:
    """The k best rows of each group with rank from 1, ties to the smaller id. Map-side limits cut each partition to k a group."""
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), tie)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def knn(items: DataFrame, query: list[float], k: int, id_col: str = "id", vec: str = "embedding", where: Column | None = None, exclude: object = None) -> DataFrame:
    """(.., score): the k items most like one vector. The predicate and the seed are applied before the cut, so k rows come back."""
    rows = items if where is None else items.where(where)
    if exclude is not None:
        rows = rows.where(F.col(id_col) != F.lit(exclude))
    q = F.array(*[F.lit(float(x)) for x in query])
    return rows.withColumn("score", cosine(F.col(vec), q)).orderBy(F.col("score").desc(), id_col).limit(k)


def knn_overfetch(items: DataFrame, query: list[float], k: int, where: Column, factor: int = 4, id_col: str = "id", vec: str = "embedding") -> DataFrame:
    """The predicate after fetching factor * k: may give fewer than k rows."""
    return knn(items, query, factor * k, id_col, vec).where(where).orderBy(F.col("score").desc(), id_col).limit(k)


def seed_vector(items: DataFrame, lookups: list[Column], vec_cols: list[str]) -> list[float] | None:
    """The vector of the first lookup that finds a row, from the first vector column that is set there."""
    n = F.coalesce(*[F.when(c, F.lit(i)) for i, c in enumerate(lookups)])
    row = items.where(F.reduce(F.array(*lookups), F.lit(False), lambda a, b: a | F.coalesce(b, F.lit(False)))).select(n.alias("n"), F.coalesce(*vec_cols).alias("v")).where("v is not null").orderBy("n").first()
    return list(row.v) if row else None


def _by_length(column: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Vectors -> length: (row numbers, matrix of the vectors at length 1); a zero vector stays as it is."""
    sizes, out = pc.list_value_length(column).to_numpy(zero_copy_only=False), {}
    for dim in np.unique(sizes):
        at = np.nonzero(sizes == dim)[0]
        rows = column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), int(dim))
        norm = np.sqrt((rows * rows).sum(axis=1, keepdims=True))
        out[int(dim)] = at, np.divide(rows, norm, out=rows.copy(), where=norm > 0)
    return out


def _dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component on, so that equal rows score alike wherever they stand."""
    out = np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        out = out + x * y
    return out


def _nearest_in(left: pa.Array, right: pa.Array, same: np.ndarray | None, k: int, threshold: float) -> tuple[np.ndarray, ...]:
    """Row numbers (left, right) and scores: for each left row its best right rows, ties at the k-th place included.

    ``same``: for each left row the code of its id, and right codes, of which equal ones don't meet.
    """
    found = []
    right_rows = _by_length(right)
    for dim, (at, a) in _by_length(left).items():
        if dim not in right_rows:
            continue
        to, b = right_rows[dim]
        for start in range(0, len(at), 1024):
            part = a[start : start + 1024]
            score = part @ b.T
            if same is not None:
                score[same[0][at[start : start + 1024]][:, None] == same[1][to]] = -2.0
            cut = np.full((len(part), 1), threshold)
            if len(to) > k:
                cut = np.maximum(cut, np.partition(score, len(to) - k, axis=1)[:, len(to) - k, None])
            i, j = np.nonzero((score >= cut - SLACK) & (score > -2.0))
            exact = _dots(part[i], b[j])
            keep = exact >= threshold
            found.append((at[start + i[keep]], to[j[keep]], exact[keep]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))


def _codes(left: pa.Array, right: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers for ids, equal where the ids are."""
    both = pa.concat_arrays([left, right.cast(left.type)]).dictionary_encode().indices.to_numpy(zero_copy_only=False)
    return both[: len(left)], both[len(left) :]


def _packed(df: DataFrame, by: list[str]) -> DataFrame:
    """(by.., id, v) -> a row a block: (by.., ids, vs)."""
    rows = df.groupBy(*by).agg(F.collect_list(F.struct("id", "v")).alias("r"))
    return rows.select(*by, F.col("r.id").alias("ids"), F.col("r.v").alias("vs"))


def _rows(df: DataFrame, id_col: str, vec: str, *more: str) -> DataFrame:
    """(more.., id, v double[]): rows with an id, and a vector without nulls."""
    v = F.col(vec).cast("array<double>")
    return df.select(*more, F.col(id_col).alias("id"), v.alias("v")).where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull()))


def similarity_join(left: DataFrame, right: DataFrame, k: int, threshold: float, left_id: str, right_id: str, lv: str = "embedding", rv: str = "embedding", not_self: bool = False, block: int = 2048, parts: int = 16) -> DataFrame:
    """(left_id, right_id, score, rank): each left row's k best right rows at or above the threshold, ties to the smaller id.

    Scores are products of matrices over Arrow batches. The right side (concepts, prototypes) is measured: up to
    MOST_BROADCAST bytes it goes to every task. Larger, both sides are cut into blocks of about ``block`` rows; every left
    block meets every right one under a key of the right block and one of ``parts``, and a left row's best of a block are cut
    to k before the blocks meet. Vectors of different lengths don't match; rows without id or vector take no part.
    """
    a, b = _rows(left, left_id, lv), _rows(right, right_id, rv)
    kinds = StructType([StructField("l", a.schema["id"].dataType), StructField("r", b.schema["id"].dataType), StructField("score", DoubleType())])
    names = ["l", "r", "score"]
    n, longest = b.agg(F.count("*"), F.coalesce(F.max(F.size("v")), F.lit(0))).first()
    if n * (longest + 4) * 8 <= MOST_BROADCAST:
        held = b.toArrow().combine_chunks()
        ids, vs = (pa.concat_arrays(held[c].chunks) if held.num_rows else held[c].combine_chunks() for c in ("id", "v"))

        def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                same = _codes(batch.column(0), ids) if not_self else None
                i, j, score = _nearest_in(batch.column(1), vs, same, k, threshold)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), ids.take(pa.array(j)), pa.array(score)], names)

        scored = a.mapInArrow(near, kinds)
    else:
        blocks, many = -(-n // block), F.lit(max(1, -(-a.count() // block)))
        each = lambda m: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long")))
        right_blocks = _packed(b.withColumn("g", F.pmod(F.xxhash64("id"), F.lit(blocks))), ["g"]).select("g", each(parts).alias("p"), F.col("ids").alias("r_ids"), F.col("vs").alias("r_vs"))
        left_blocks = _packed(a.withColumn("h", F.pmod(F.xxhash64("id"), many)), ["h"]).select((F.col("h") % parts).alias("p"), each(blocks).alias("g"), "ids", "vs")

        def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    l_ids, l_vs, r_ids, r_vs = (batch.column(c)[row].values for c in range(4))
                    i, j, score = _nearest_in(l_vs, r_vs, _codes(l_ids, r_ids) if not_self else None, k, threshold)
                    yield pa.RecordBatch.from_arrays([l_ids.take(pa.array(i)), r_ids.take(pa.array(j)), pa.array(score)], names)

        scored = left_blocks.join(right_blocks, ["g", "p"]).select("ids", "vs", "r_ids", "r_vs").mapInArrow(meet, kinds)
    return top_k(scored, ["l"], k, "score", "r").select(F.col("l").alias(left_id), F.col("r").alias(right_id), "score", "rank")


def near_duplicate_pairs(items: DataFrame, threshold: float, id_col: str = "id", vec: str = "embedding", by: list[str] = (), block: int = 1024) -> DataFrame:
    """(by.., a, b, score), a < b: pairs of one group at or above the threshold, each once.

    Every pair of a group is compared, so the work is quadratic in a group; groups are cut into blocks of about ``block``
    rows and pairs of blocks are the join's keys, so that a large group spreads over all tasks. A pair of blocks is one
    product of matrices; only pairs that reach the threshold leave it. Rows without id or vector take no part.
    """
    keys = [f"k{i}" for i in range(len(by))]
    rows = _rows(items.select("*", *[F.col(c).alias(k) for c, k in zip(by, keys)]), id_col, vec, *keys).withColumn("all", F.lit(1))
    groups = [*keys, "all"]
    sizes = rows.groupBy(*groups).agg(F.ceil(F.count("*") / block).cast("int").alias("k"))
    same = lambda x, y: reduce(lambda p, q: p & q, [F.col(f"{x}.{c}").eqNullSafe(F.col(f"{y}.{c}")) for c in groups])
    cut = rows.alias("x").join(sizes.alias("y"), same("x", "y")).select("x.*", "y.k").withColumn("own", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    packed = _packed(cut, [*groups, "k", "own"])
    one = packed.select(*groups, F.col("own").alias("i"), F.explode(F.sequence("own", F.col("k") - 1)).alias("j"), "ids", "vs")
    two = packed.select(*groups, F.explode(F.sequence(F.lit(0), "own")).alias("i"), F.col("own").alias("j"), F.col("ids").alias("b_ids"), F.col("vs").alias("b_vs"))
    met = one.alias("x").join(two.alias("y"), same("x", "y") & (F.col("x.i") == F.col("y.i")) & (F.col("x.j") == F.col("y.j")))
    kind = rows.schema["id"].dataType
    kinds = StructType([*[rows.schema[k] for k in keys], StructField("a", kind), StructField("b", kind), StructField("score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                a_ids, a_vs, b_ids, b_vs = (batch.column(len(keys) + 1 + c)[row].values for c in range(4))
                own, other = _by_length(a_vs), _by_length(b_vs)
                inner = batch.column(len(keys))[row].as_py()
                for dim in own.keys() & other.keys():
                    (at, a), (to, b) = own[dim], other[dim]
                    i, j = np.nonzero(a @ b.T >= threshold - SLACK)
                    score = _dots(a[i], b[j])
                    x, y = a_ids.take(pa.array(at[i])), b_ids.take(pa.array(to[j]))
                    keep = pc.and_(pa.array(score >= threshold), pc.less(x, y) if inner else pc.not_equal(x, y))  # a block with itself: each pair once
                    swap = pc.greater(x, y)
                    columns = [pa.array([batch.column(c)[row].as_py()] * len(i), batch.schema.field(c).type) for c in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*columns, pc.if_else(swap, y, x), pc.if_else(swap, x, y), pa.array(score)], [*keys, "a", "b", "score"]).filter(keep)

    pairs = met.select(*[f"x.{k}" for k in keys], (F.col("x.i") == F.col("x.j")).alias("inner"), "x.ids", "x.vs", "y.b_ids", "y.b_vs").mapInArrow(run, kinds)
    return pairs.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "a", "b", "score")


def weighted_mean(df: DataFrame, by: list[str], vec: str, weight: Column | float = 1.0, normal: bool = True) -> DataFrame:
    """(by.., embedding, weight_sum): weighted mean vector of a group, at length 1 if ``normal``.

    Positions are summed as rows, map-side first, so that no group's vectors gather in one task.
    """
    w = weight if isinstance(weight, Column) else F.lit(float(weight))
    rows = df.select(*by, w.cast("double").alias("__w"), F.posexplode(vec).alias("__i", "__x"))
    sums = rows.groupBy(*by, "__i").agg(F.sum(F.col("__w") * F.col("__x").cast("double")).alias("s"), F.sum("__w").alias("n"))
    whole = sums.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("__i", "s"))).alias("p"), F.max("n").alias("weight_sum"))
    mean = F.transform("p", lambda x: x["s"] / F.col("weight_sum"))
    return whole.withColumn("embedding", unit(mean) if normal else mean).select(*by, "embedding", "weight_sum")


def vector_sum(df: DataFrame, by: list[str], vec: str, mean: bool = False) -> DataFrame:
    """(by.., embedding): vectors of finer steps added up, or averaged, for a coarser one."""
    rows = df.select(*by, F.posexplode(vec).alias("__i", "__x"))
    how = F.avg(F.col("__x").cast("double")) if mean else F.sum(F.col("__x").cast("double"))
    sums = rows.groupBy(*by, "__i").agg(how.alias("s"))
    return sums.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list(F.struct("__i", "s"))), lambda x: x["s"]).alias("embedding"))


def assign(items: DataFrame, prototypes: DataFrame, threshold: float, item_id: str, proto_id: str, iv: str = "embedding", pv: str = "embedding") -> DataFrame:
    """(item_id, proto_id, score): the nearest prototype of each item, if near enough."""
    return similarity_join(items, prototypes, 1, threshold, item_id, proto_id, iv, pv).drop("rank")


def updated_prototypes(prototypes: DataFrame, assigned: DataFrame, items: DataFrame, item_id: str, proto_id: str, confirm_at: float, vec: str = "embedding", weight: str = "weight_sum") -> DataFrame:
    """Prototypes moved to the weighted mean of themselves and their new members; status by the worst new member's score."""
    members = assigned.join(items.select(item_id, F.col(vec).alias("__v"), F.lit(1.0).alias("__w")), item_id).select(proto_id, "__v", "__w", "score")
    old = prototypes.select(proto_id, F.col(vec).alias("__v"), F.col(weight).cast("double").alias("__w"))
    mean = weighted_mean(old.unionByName(members.drop("score")), [proto_id], "__v", F.col("__w"))
    worst = members.groupBy(proto_id).agg(F.min("score").alias("worst"), F.count("*").alias("added"))
    return mean.join(worst, proto_id, "left").withColumn("added", F.coalesce("added", F.lit(0))).withColumn("status", F.when(F.coalesce("worst", F.lit(1.0)) >= confirm_at, "confirmed").otherwise("tentative"))


def identify(items: DataFrame, prototypes: DataFrame, item_id: str, proto_id: str, label: str, low: float = 0.72, high: float = 0.85, margin: float = 0.05) -> DataFrame:
    """(item_id, label, score, threshold, verdict): the threshold follows the vector's quality.

    A vector with a length of at least 1e-6 and most components set is good and takes ``low``; others take ``high``.
    Scores from the threshold + margin are a match, from the threshold a weak one.
    """
    filled = F.size(F.filter("embedding", lambda x: x != 0)) / F.greatest(F.size("embedding"), F.lit(1))
    rows = items.select(item_id, F.when(filled >= 0.5, low).otherwise(high).alias("threshold"))
    best = similarity_join(items, prototypes, 1, -1.0, item_id, proto_id).join(prototypes.select(proto_id, label), proto_id)
    verdict = F.when(F.col("score") >= F.col("threshold") + margin, "match").when(F.col("score") >= F.col("threshold"), "weak").otherwise("none")
    return rows.join(best.select(item_id, label, "score"), item_id).withColumn("verdict", verdict)


def gated_match(pairs: DataFrame, first: str = "appearance", second: str = "trajectory", at_first: float = 0.87, at_second: float = 0.82, item: str = "a", cand: str = "b") -> DataFrame:
    """Of pairs with two scores: those above both gates, the best by the first score for each item."""
    good = pairs.where((F.col(first) >= at_first) & (F.col(second) >= at_second))
    return top_k(good, [item], 1, first, cand).drop("rank")


def priority_members(items: DataFrame, seed_where: Column, id_col: str, weight: str, threshold: float, most: int, top: int = 20) -> DataFrame:
    """(id, score): items near the weighted mean of the seed's ``top`` heaviest vectors, ``most`` of them."""
    seed = items.where(seed_where).orderBy(F.col(weight).desc(), id_col).limit(top)
    mean = weighted_mean(seed.withColumn("__one", F.lit(1)), ["__one"], "embedding", F.col(weight)).first()
    if mean is None:
        return items.select(id_col, F.lit(0.0).alias("score")).limit(0)
    return knn(items.where(~seed_where), list(mean.embedding), most, id_col).where(F.col("score") >= threshold).select(id_col, "score")


def finished_clusters(members: DataFrame, pairs: DataFrame, cluster: str = "label", member: str = "id", confirm_at: float = 0.8) -> DataFrame:
    """(cluster_id, size, confidence, status): id is the md5 of the sorted members; confidence is the least pair score.

    A pair without a score counts as 0; single members and low confidence are tentative.
    """
    groups = members.groupBy(cluster).agg(F.md5(F.array_join(F.sort_array(F.collect_list(F.col(member).cast("string"))), "|")).alias("cluster_id"), F.count("*").alias("size"))
    a = members.select(F.col(member).alias("a"), F.col(cluster).alias("__ca"))
    b = members.select(F.col(member).alias("b"), F.col(cluster).alias("__cb"))
    inner = pairs.join(a, "a").join(b, "b").where("__ca = __cb").groupBy(F.col("__ca").alias(cluster)).agg(F.count("*").alias("n"), F.min("score").alias("least"))
    full = F.col("n") == F.col("size") * (F.col("size") - 1) / 2
    value = F.when(F.col("size") == 1, 0.0).when(full, F.col("least")).otherwise(0.0)
    return groups.join(inner, cluster, "left").withColumn("confidence", value).withColumn("status", F.when(F.col("confidence") >= confirm_at, "confirmed").otherwise("tentative")).select("cluster_id", "size", "confidence", "status")


def retrieval_agreement(got: DataFrame, ref: DataFrame, query: str, item: str, rank: str, k: int) -> DataFrame:
    """(query, ndcg_agreement, overlap, jaccard, top1): ranked lists against reference lists; ranks from 1.

    Relevance is membership of the reference's first k, so the figure measures agreement.
    """
    g = got.where(F.col(rank) <= k).select(query, F.col(item).alias("__i"), F.col(rank).alias("__r"))
    r = ref.where(F.col(rank) <= k).select(query, F.col(item).alias("__i"), F.col(rank).alias("__rr"))
    both = g.join(r, [query, "__i"], "full_outer")
    gain = 1 / F.log2(F.col("__r") + 1)
    sums = both.groupBy(query).agg(
        F.sum(F.when(F.col("__r").isNotNull() & F.col("__rr").isNotNull(), gain).otherwise(0.0)).alias("dcg"),
        F.count_if(F.col("__r").isNotNull() & F.col("__rr").isNotNull()).alias("overlap"),
        F.count("*").alias("all"),
        F.count("__rr").alias("n"),
        F.max((F.col("__r") == 1) & (F.col("__rr") == 1)).alias("top1"),
    )
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.col("n").cast("int"), F.lit(1))), F.lit(0.0), lambda acc, i: acc + 1 / F.log2(i + F.lit(1.0)))
    return sums.select(query, (F.col("dcg") / ideal).alias("ndcg_agreement"), "overlap", (F.col("overlap") / F.col("all")).alias("jaccard"), F.coalesce("top1", F.lit(False)).alias("top1"))


def kmeans(items: DataFrame, ks: list[int], vec: str = "embedding", seed: int = 1, least: int = 1) -> DataFrame:
    """items + cluster: k-means with the k of the best silhouette; clusters smaller than ``least`` get null."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    if items.isEmpty():
        return items.withColumn("cluster", F.lit(None).cast("int"))
    data = items.withColumn("__x", array_to_vector(F.col(vec).cast("array<double>")))
    fits = []
    for k in ks:
        out = KMeans(k=k, seed=seed, featuresCol="__x", predictionCol="cluster").fit(data).transform(data)
        fits.append((ClusteringEvaluator(featuresCol="__x", predictionCol="cluster").evaluate(out), -k, out))
    best = max(fits, key=lambda f: f[:2])[2].drop("__x")
    large = best.groupBy("cluster").agg(F.count("*").alias("__n")).where(F.col("__n") >= least)
    return best.join(large, "cluster", "left").withColumn("cluster", F.when(F.col("__n").isNotNull(), F.col("cluster"))).drop("__n")
