"""Nearest neighbours by shifted space-filling curves.

Index: every distinct vector is projected by seeded random maps to a few dimensions, shifted and quantised; each map gives
a Hilbert key. The curves' rows are range-partitioned, sorted and cut into pages, which hold an 8-bit sketch of each vector.
Search: a query meets the rows within a window of ranks on every curve; the best by sketch from all windows are merged and
reranked by the true cosine. The window is fitted: for a bounded sample of the queries the true neighbours are found by one
pass over all vectors, and the window is that within which the wanted share of them lies on at least one curve. Vectors
with structure get short windows; vectors without any need windows that are a share of the table.

Vectors that a power of two takes into each other have exactly equal cosines with all others. They are one node, with its
k + 1 smallest ids (more can't be in a result), so that a vector held by a third of all rows costs no more than another.
Nodes are numbered in the order of their smallest ids, which is the order of ties.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meridian.llm.common import checkpointed, frugal, stored, table
from meridian.llm.hilbert import hilbert_index


@dataclass(frozen=True)
class Index:
    """curves: orderings. dims, bits: of a projected point. page: rows of a curve in a page.

    recall: share of the sample's true neighbours that the windows must hold; 1 lets every query meet every row (on one
    curve, as the others add nothing then). sample: queries that the window is fitted on. least: rows on either side that
    a window has at least. rerank: nodes whose true cosine is taken, in multiples of k.
    """

    curves: int = 32
    dims: int = 8
    bits: int = 7
    page: int = 1024
    recall: float = 0.96
    sample: int = 128
    least: int = 256
    rerank: int = 4
    seed: int = 7


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component to the last, so that equal rows give equal values wherever they stand."""
    ab, aa, bb = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for x, y in zip(a.T, b.T):
        ab, aa, bb = ab + x * y, aa + x * x, bb + y * y
    return ab / (np.sqrt(aa) * np.sqrt(bb))


def valid_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """Distinct (id, v): ids not null, vectors finite and not zero, as doubles with the largest component in [0.5, 1).

    Scaling by a power of two changes no cosine and keeps squares from overflowing.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            lists = batch.column(1)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False).astype("<f8"), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            out = []
            for a, b in zip(ends, ends[1:]):
                v = flat[a:b]
                top = np.abs(v).max() if b > a else 0.0
                out.append(np.ldexp(v, -int(np.frexp(top)[1])).tobytes() if np.isfinite(top) and top > 0 else None)
            made = pa.array(out, pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), made], ["id", "v"]).filter(made.is_valid())

    plain = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return plain.where("id IS NOT NULL AND v IS NOT NULL").mapInArrow(run, "id long, v binary").distinct()


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Vectors as bytes -> (row numbers, matrix) for each length."""
    rows = column.to_pylist()
    sizes = np.fromiter(map(len, rows), np.int64, len(rows)) // 8
    for dim in np.unique(sizes):
        at = np.nonzero(sizes == dim)[0]
        yield at, np.frombuffer(b"".join([rows[i] for i in at]), "<f8").reshape(-1, dim)


def _units(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def sketches(unit: np.ndarray) -> np.ndarray:
    """(n, dim) -> (n, dim + 4) bytes: components as signed bytes and their step, for each row."""
    step = (np.abs(unit).max(axis=1, keepdims=True) / 127).astype("<f4")
    return np.hstack([np.rint(unit / step).astype(np.int8).view(np.uint8), step.view(np.uint8)])


def _opened(data: bytes, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Packed sketches -> components (exact sums in float32 up to a thousand of them) and steps."""
    raw = np.frombuffer(data, np.uint8).reshape(rows, -1)
    parts = raw[:, :-4].view(np.int8)
    return parts.astype(np.float32 if parts.shape[1] <= 1000 else np.float64), np.ascontiguousarray(raw[:, -4:]).view("<f4")[:, 0].astype(np.float64)


@lru_cache(maxsize=256)
def _projection(dim: int, curve: int, dims: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, dim, curve])
    return rng.normal(size=(dim, dims)), rng.uniform(-0.25, 0.25, size=dims)


def _keyed(nodes: DataFrame, ix: Index) -> DataFrame:
    """(node, v, isq) -> (curve, key, node, isq, sketch), a row a curve. Vectors of another length have curves of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for at, v in _by_length(batch.column(1)):
                unit, dim = _units(v), v.shape[1]
                own = pa.array(at)
                packed = pa.array([r.tobytes() for r in sketches(unit)], pa.binary())
                for c in range(ix.curves):
                    project, shift = _projection(dim, c, min(ix.dims, dim), ix.seed)
                    cells = ((unit @ project + shift) / 6 + 0.5) * (1 << ix.bits)
                    key = hilbert_index(np.clip(cells, 0, (1 << ix.bits) - 1).astype(np.int64), ix.bits)
                    columns = [pa.array(np.full(len(at), dim * ix.curves + c, np.int64)), pa.array(key), batch.column(0).take(own), batch.column(2).take(own), packed]
                    yield pa.RecordBatch.from_arrays(columns, ["curve", "key", "node", "isq", "sketch"])

    return nodes.select("node", "v", "isq").mapInArrow(run, "curve long, key long, node long, isq boolean, sketch binary")


def _pages(keyed: DataFrame, ix: Index) -> DataFrame:
    """Sorted curves -> (curve, rank, n, nodes, flags, sketches): runs of a curve; rank counts all rows before the page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        from pyspark import TaskContext

        part, at, held = TaskContext.get().partitionId(), 0, None

        def page(rows: pa.Table) -> pa.RecordBatch:
            nodes, flags = rows["node"].to_numpy().astype("<i8").tobytes(), rows["isq"].to_numpy().astype(np.uint8).tobytes()
            made = [part, rows["curve"][0].as_py(), at, rows.num_rows, nodes, flags, b"".join(rows["sketch"].to_pylist())]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(made, kinds)], ["part", "curve", "at", "n", "nodes", "flags", "sketches"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if held is None else pa.concat_tables([held, rows])
            curve = rows["curve"].to_numpy()
            begins = np.concatenate([[0], np.nonzero(np.diff(curve))[0] + 1, [len(curve)]])
            cuts = [c for a, b in zip(begins, begins[1:]) for c in range(a, b, ix.page)]
            for a, b in zip(cuts, cuts[1:]):
                yield page(rows.slice(a, b - a))
                at += b - a
            held = rows.slice(cuts[-1]) if cuts else None
        if held is not None and held.num_rows:
            yield page(held)

    order = ["curve", "key", "node"]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("curve", "node", "isq", "sketch")
    pages = stored(sorted_rows.mapInArrow(run, "part int, curve long, at long, n int, nodes binary, flags binary, sketches binary"), "curves")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row a partition
    starts = pages.groupBy("part").agg(F.sum("n").alias("rows")).select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    return pages.join(starts, "part").select("curve", (F.col("start") + F.col("at")).alias("rank"), "n", "nodes", "flags", "sketches")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("q").orderBy(F.col("score").desc(), "cand")
    return pairs.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k)


def fitted_window(nodes: DataFrame, pages: DataFrame, k: int, ix: Index) -> int:
    """Ranks on either side within which the share ``recall`` of a sample's true neighbours lies on some curve.

    One pass over all vectors for at most ``sample`` queries, and one over the pages' nodes. Only the sample, its neighbours
    and their ranks come to the driver.
    """
    asked = [(r.node, bytes(r.v)) for r in nodes.where("isq").orderBy(F.xxhash64("v"), "v").limit(ix.sample).select("node", "v").collect()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        numbers, vectors = np.array([n for n, _ in asked], np.int64), pa.array([v for _, v in asked], pa.binary())
        mine = {v.shape[1]: (numbers[at], _units(v)) for at, v in _by_length(vectors)}
        best = {d: (np.full((len(q), k), -2.0), np.full((len(q), k), -1, np.int64)) for d, (q, _) in mine.items()}
        for batch in batches:
            node = batch.column(0).to_numpy()
            for at, v in _by_length(batch.column(1)):
                if v.shape[1] in mine:
                    q, unit = mine[v.shape[1]]
                    score = np.where(q[:, None] == node[at], -2.0, unit @ _units(v).T)
                    score = np.hstack([best[v.shape[1]][0], score])
                    name = np.hstack([best[v.shape[1]][1], np.broadcast_to(node[at], (len(q), len(at)))])
                    keep = np.argsort(-score, axis=1, kind="stable")[:, :k]
                    best[v.shape[1]] = np.take_along_axis(score, keep, 1), np.take_along_axis(name, keep, 1)
        for d, (score, name) in best.items():
            i, j = np.nonzero(name >= 0)
            yield pa.RecordBatch.from_arrays([pa.array(mine[d][0][i]), pa.array(name[i, j]), pa.array(score[i, j])], ["q", "cand", "score"])

    pairs = [(r.q, r.cand) for r in _top(nodes.select("node", "v").mapInArrow(run, "q long, cand long, score double"), k).collect()] if asked else []
    wanted = np.array(sorted({x for p in pairs for x in p}), np.int64)

    def ranked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for curve, rank, data in zip(*(c.to_pylist() for c in batch.columns)):
                own = np.frombuffer(data, "<i8")
                at = np.nonzero(np.isin(own, wanted))[0]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), curve, np.int64)), pa.array(own[at]), pa.array(rank + at)], ["curve", "node", "rank"])

    if not pairs:
        return ix.least
    ranks: dict[int, dict[int, int]] = {}
    for r in pages.select("curve", "rank", "nodes").mapInArrow(ranked, "curve long, node long, rank long").collect():
        ranks.setdefault(r.node, {})[r.curve] = r["rank"]
    apart = [min(abs(rank - ranks[b][c]) for c, rank in ranks[a].items()) for a, b in pairs]
    return max(ix.least, int(np.quantile(apart, ix.recall, method="higher")))


def _met(pages: DataFrame, window: int, ix: Index, most: int) -> DataFrame:
    """Queries against the rows in their windows -> (q, cand, score by sketch): the ``most`` best of each page they meet."""

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for curve, rank, n, nodes, flags, data in zip(*(c.to_pylist() for c in batch.columns)):
                at = np.nonzero(np.frombuffer(flags, np.uint8))[0]
                if len(at):
                    own, packed = np.frombuffer(nodes, "<i8")[at], np.frombuffer(data, np.uint8).reshape(n, -1)[at]
                    made = [curve, rank + int(at[0]), rank + int(at[-1]), (rank + at).astype("<i8").tobytes(), own.tobytes(), packed.tobytes()]
                    yield pa.RecordBatch.from_arrays([pa.array([x]) for x in made], ["curve", "lo", "hi", "q_ranks", "q_nodes", "q_sketches"])

    first, b_first = F.expr(f"rank div {ix.page}"), F.expr(f"greatest(0, lo - {window}) div {ix.page}")
    blocks = pages.mapInArrow(asked, "curve long, lo long, hi long, q_ranks binary, q_nodes binary, q_sketches binary")
    blocks = blocks.withColumn("b_first", b_first).withColumn("part", F.explode(F.sequence("b_first", F.expr(f"(hi + {window}) div {ix.page}")))).drop("lo", "hi")
    rows = pages.drop("flags").withColumn("first", first).withColumn("part", F.explode(F.sequence("first", F.expr(f"(rank + n - 1) div {ix.page}"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            for rank, n, nodes, data, q_ranks, q_nodes, q_data in zip(*(c.to_pylist() for c in batch.columns)):
                here, q = np.frombuffer(q_ranks, "<i8"), np.frombuffer(q_nodes, "<i8")
                (x, steps), (y, q_steps) = _opened(data, n), _opened(q_data, len(q))
                score = (y @ x.T).astype(np.float64) * q_steps[:, None] * steps
                score[np.abs(here[:, None] - (rank + np.arange(n))) > window] = -2.0
                cut = np.partition(score, n - most, axis=1)[:, n - most, None] if n > most else -2.0
                i, j = np.nonzero((score >= cut) & (score > -2.0))  # ties at the cut stay
                yield pa.RecordBatch.from_arrays([pa.array(q[i]), pa.array(np.frombuffer(nodes, "<i8")[j]), pa.array(score[i, j])], ["q", "cand", "score"])

    met = rows.join(blocks, ["curve", "part"]).where("part = greatest(first, b_first)")  # a pair's first common part
    pairs = met.select("rank", "n", "nodes", "sketches", "q_ranks", "q_nodes", "q_sketches").mapInArrow(run, "q long, cand long, score double")
    return pairs.groupBy("q", "cand").agg(F.max("score").alias("score"))


def _reranked(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(q, cand) -> (q, cand, score): the cosine of the vectors themselves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frugal()
        for batch in batches:
            score = np.empty(batch.num_rows)
            others = batch.column(3)
            for at, v in _by_length(batch.column(2)):
                score[at] = cosines(v, np.frombuffer(b"".join(others.take(pa.array(at)).to_pylist()), "<f8").reshape(len(at), -1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score)], ["q", "cand", "score"])

    of = lambda name, v: nodes.select(F.col("node").alias(name), F.col("v").alias(v))
    return pairs.join(of("q", "x"), "q").join(of("cand", "y"), "cand").select("q", "cand", "x", "y").mapInArrow(run, "q long, cand long, score double")


def nearest(df: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", ix: Index = Index()) -> DataFrame:
    """The k nearest found by cosine of every row that ``is_query`` (a predicate on column ``id``) selects, own id left out.

    -> (query_id, rank from 1, vec_id, score), ties to the smaller id; all found where there are fewer than k. Null ids,
    null, empty and zero vectors and those with null or non-finite components take no part; rows of equal id and vector
    count once, rows that share an id only are candidates of their own. A query meets vectors of its own length only. An
    empty table gives no rows, other columns are ignored.
    """
    if ix.recall >= 1:
        ix = replace(ix, curves=1)
    most = k + 1
    rows = checkpointed(valid_vectors(df, id_col, vec_col))
    few = Window.partitionBy("v").orderBy("id")
    ids = rows.withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= most)
    flags = rows.groupBy("v").agg(F.max(F.coalesce(is_query, F.lit(False))).alias("isq"))
    grouped = ids.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")).join(flags, "v")
    order = [F.col("ids")[0], F.col("v")]
    nodes = stored(grouped.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("node", F.monotonically_increasing_id()), "nodes")
    pages = _pages(_keyed(nodes, ix), ix)
    window = (1 << 62) if ix.recall >= 1 else fitted_window(nodes, pages, k, ix)
    window = min(window, int(nodes.count()) * ix.curves)
    found = checkpointed(_top(_met(pages, window, ix, ix.rerank * most), ix.rerank * most).select("q", "cand"))
    best = _top(_reranked(found, nodes), most).select("q", "cand", "score")
    flat = best.join(nodes.select(F.col("node").alias("cand"), "ids"), "cand").select("q", "score", F.explode("ids").alias("cand"))
    asked = rows.where(is_query).join(nodes.where("isq").select("v", F.col("node").alias("q")), "v").select(F.col("id").alias("query_id"), "q")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        asked.join(_top(flat, most).select("q", "score", F.col("cand").alias("vec_id")), "q")
        .where("vec_id <> query_id")
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def op1_curves(spark, sf_dir: str) -> DataFrame:
    """Every fiftieth vector against all others, as ``nearest`` does it: nulls, ties and repeats as stated there."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


ORACLE = """
WITH v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL)) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))
         / (sqrt(list_sum(list_transform(q.e, lambda z: z * z))) * sqrt(list_sum(list_transform(c.e, lambda z: z * z)))) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""
