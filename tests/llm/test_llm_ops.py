"""Edge cases and brute-force checks of the training-data operators."""

import base64
import hashlib
import math
import random
import textwrap
import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

pytest.importorskip("meridian.llm")
from meridian.llm import ann, bpe, gif, hilbert, licences, mixing, quality, sharding, simhash, token_files, toxicity  # noqa: E402
from meridian.llm.components import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, label int, bucket string, rank int, kind string, rate double, id long"
LONG = "lorem ipsum dolor " * 4000
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog again and again", "en", "a", 1, "x", 1, "y", 2),
    (2, "the QUICK brown fox jumps over the lazy dog again and again", "en", "b", 1, None, None, None, None),
    (3, None, None, None, None, None, None, None, None),
    (4, "", "de", "a", 0, "x", 0, "", 0),
    (5, " \t\n ", "de", None, 0, "x", 0, "", 0),
    (6, LONG, "la", "b", 1, "x", 0, "", 0),
    (7, "Ünïcode 🙂 text", "fr", "c", 1, "x", 0, "", 0),
    (7, "Ünïcode 🙂 text", "fr", "c", 1, "x", 0, "", 0),
    (None, "no id here", "en", "a", 1, "x", 0, "", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "k", 9.0, 1) for r in ROWS], DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def real(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def brute_fingerprint(text):
    words = (text or "").encode().translate(simhash.LOWER_ASCII).split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    bits = [sum(xxhash.xxh64_intdigest(x, 42) >> b & 1 for x in shingles) * 2 > len(shingles) for b in range(64)]
    return sum(1 << b for b in range(64) if bits[b]) if shingles else 0


def brute_components(nodes, linked):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    return {n: root(n) for n in nodes}


def test_components(spark):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 120, (70, 2))] + [(i, i + 1) for i in range(200, 240)]
    got = {r.a: r.label for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    want = brute_components({x for p in pairs for x in p}, pairs)
    assert {n: got.get(n, n) for n in want} == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bit_sliced_distances_are_exact():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (5, 8), dtype=np.uint8)
    fps = np.vstack([base[rng.integers(0, 5, 400)]])
    for row in fps:
        for b in rng.integers(0, 64, rng.integers(0, 4)):
            row[b // 8] ^= 1 << (b % 8)
    sizes = np.array([3, 1, 60, 64, 65, 130, 77])
    plan = simhash.CONTRACT
    a, b = simhash.linked(sizes, fps, plan)
    words = fps.view(">u8")[:, 0].tolist()
    start = 0
    for n in sizes.tolist():
        near = [(i, j) for i in range(start, start + n) for j in range(start, i) if (words[i] ^ words[j]).bit_count() <= 2]
        want = brute_components(range(start, start + n), near)
        got = brute_components(range(start, start + n), [(x, y) for x, y in zip(a.tolist(), b.tolist()) if start <= x < start + n])
        assert got == want
        start += n


def test_simhash_against_brute_force(spark, sf, real):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.op2_simhash(spark, sf).collect()}
    want = {r.doc_id: brute_fingerprint(r.text) for r in real.collect()}
    assert {k: int(v[0], 16) for k, v in got.items()} == want and all(len(v[0]) == 16 for v in got.values())
    ids = sorted(want)
    linked = [(a, b) for a in ids for b in ids if a < b and (want[a] ^ want[b]).bit_count() <= 2]
    assert {k: v[1] for k, v in got.items()} == brute_components(ids, linked)


def test_simhash_edge_cases(docs, none):
    got = defaultdict(list)
    for r in simhash.near_duplicates(docs).collect():
        got[r.doc_id].append((bytes(r.fp), r.component_id))
    assert sum(map(len, got.values())) == len(ROWS)
    assert {got[i][0] for i in (3, 4, 5)} == {(bytes(8), 3)}
    assert got[1][0][1] == got[2][0][1] == 1 and len(got[7]) == 2
    assert simhash.near_duplicates(none).count() == 0
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 3, 6, 7]


def test_near_dedup_finds_planted_copies(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(3000)]
    rows, pairs = [], []
    for d in range(60):
        text = rng.choice(words, 200).tolist()
        rows.append((d, " ".join(text)))
        copy = text.copy()
        copy[int(rng.integers(5, 190))] = "changed"
        rows.append((1000 + d, " ".join(copy)))
        pairs.append((d, 1000 + d))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR_DEDUP).collect()}
    assert got == {x: a for a, b in pairs for x in (a, b)}


def test_near_dedup_misses_no_similar_pair(spark, monkeypatch):
    monkeypatch.setattr(simhash, "MOST_COMMON", 50)
    rng = np.random.default_rng(8)
    passage, rows = [f"p{i}" for i in range(30)], [(9000, "short text"), (9001, "Short  text"), (9002, "short texts")]
    for d in range(150):
        base = [f"w{x}" for x in rng.integers(0, 100_000, int(rng.integers(60, 400)))] + passage
        for c in range(3):
            copy = base.copy()
            for at in rng.choice(len(base), int(len(base) * 0.025 * c), replace=False):
                copy[at] = f"x{rng.integers(0, 100_000)}"
            rows.append((d * 10 + c, " ".join(copy)))
    sets = {i: set(simhash.shingles(t, 5).tolist()) for i, t in rows}
    near = {(a, b): j for a in sets for b in sets if a < b and (j := len(sets[a] & sets[b]) / len(sets[a] | sets[b])) >= 0.8}
    assert sum(j < 0.85 for j in near.values()) > 20
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR_DEDUP).collect()}
    assert got == brute_components(sets, near)


def test_near_dedup_finds_its_links_by_fingerprints(spark, monkeypatch):
    whole = simhash._prefixes
    monkeypatch.setattr(simhash, "_prefixes", lambda *a: whole(*a).where("false"))  # what fingerprints miss stays missed
    rng = np.random.default_rng(11)
    rows = []
    for d in range(80):
        base = [f"w{x}" for x in rng.integers(0, 100_000, 300)]
        for c in range(3):
            copy = base.copy()
            for at in rng.choice(300, 2 * c, replace=False):
                copy[at] = f"x{rng.integers(0, 100_000)}"
            rows.append((d * 10 + c, " ".join(copy)))
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR_DEDUP).collect()}
    assert sum(v == k // 10 * 10 for k, v in got.items()) >= 0.95 * len(rows) and all(v // 10 == k // 10 for k, v in got.items())


def test_near_dedup_links_stand_for_direct_pairs():
    rng = np.random.default_rng(12)
    base = rng.integers(0, 256, 16, dtype=np.uint8)
    fps = np.stack([base] * 200)
    for i in range(1, 200):
        for bit in rng.choice(128, int(rng.integers(1, 24)), replace=False):
            fps[i, bit // 8] ^= 1 << (bit % 8)
    a, b = simhash.linked(np.array([150, 50]), fps, simhash.NEAR_DEDUP, chunk=300)
    want = {}
    for i in range(200):
        apart = [(int(np.unpackbits(fps[i] ^ fps[j]).sum()), j) for j in range(0 if i < 150 else 150, i)]
        if apart and min(apart)[0] <= simhash.NEAR_DEDUP.radius:
            want[i] = min(apart)[1]
    assert dict(zip(a.tolist(), b.tolist())) == want and len(want) > 150


def test_near_dedup_compares_few_whole_sets(spark, monkeypatch):
    met, whole = [], simhash._similar
    monkeypatch.setattr(simhash, "MOST_COMMON", 0)
    monkeypatch.setattr(simhash, "_similar", lambda pairs, *a: met.append(pairs.count()) or whole(pairs, *a))
    rng = np.random.default_rng(13)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(d, " ".join([*(f"w{x}" for x in rng.integers(0, 10**6, 1500)), passage])) for d in range(30)]
    got = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR_DEDUP).collect()
    assert all(r.doc_id == r.component_id for r in got) and sum(met) < 5


def test_near_dedup_connects_a_large_group_by_few_pairs(spark, monkeypatch):
    met, whole, proposed = [], simhash._similar, simhash._proposed
    monkeypatch.setattr(simhash, "_proposed", lambda *a: proposed(*a).where("false"))  # as if fingerprints missed them
    monkeypatch.setattr(simhash, "_similar", lambda pairs, *a: met.append(pairs.count()) or whole(pairs, *a))
    rng = np.random.default_rng(14)
    base, rows = [f"w{i}" for i in range(150)], []
    for d in range(240):
        copy = base.copy()
        for at in rng.choice(np.arange(5, 145), 1 + d % 2, replace=False):
            copy[at] = f"x{rng.integers(0, 10**6)}"
        rows.append((d, " ".join(copy)))
    rows.append((999, " ".join([*base[:60], *(f"y{i}" for i in range(90))])))
    sets = {i: set(simhash.shingles(t, 5).tolist()) for i, t in rows}
    near = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8]
    assert len(near) > 10_000
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), simhash.NEAR_DEDUP).collect()}
    assert got == brute_components(sets, near) and sum(met) < 6000


def test_pipeline_stages_bound_their_batches(spark):
    corpus = pytest.importorskip("corpus_pipeline")
    docs, key = spark.createDataFrame([(1, "a b c", "en", "web", 5)], "doc_id long, text string, lang string, source string, n_chars long"), "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        spark.conf.unset(key)
        corpus.token_stage(spark, docs, "")
        assert int(spark.conf.get(key).removesuffix("b")) <= 4 << 20
        spark.conf.set(key, 1 << 25)
        corpus.token_stage(spark, docs, "")
        assert int(spark.conf.get(key).removesuffix("b")) == 1 << 25  # the session's own
    finally:
        spark.conf.unset(key)


def test_deduplicated_decides_by_row(spark):
    text = lambda n: " ".join(f"{n}w{i}" for i in range(50))
    rows = [(3, text("a")), (5, text("a")), (5, text("b")), (6, text("b")), (6, text("c")), (None, text("d")), (None, text("d")), (None, text("e")), (7, text("e"))]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, text("d")), (3, text("a")), (5, text("b")), (6, text("c")), (7, text("e"))]


def brute_nearest(path, k=5):
    """(query, neighbour) pairs by a full matrix of cosines, ties to the smaller id."""
    e = pq.read_table(f"{path}/embeddings.parquet")
    ids, x = e["vec_id"].to_numpy(), np.stack(e["embedding"].to_numpy(zero_copy_only=False)).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    asked = np.nonzero(ids % 50 == 0)[0]
    score = x[asked] @ x.T
    score[np.arange(len(asked)), asked] = -2
    return {int(ids[q]): [(int(ids[j]), float(s[j])) for j in np.lexsort((ids, -s))[:k]] for q, s in zip(asked, score)}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01", "sf0.1"])
def test_curves_recall(spark, sf, folder):
    path = f"{sf.rsplit('/', 1)[0]}/{folder}"
    want, got = brute_nearest(path), defaultdict(list)
    for r in ann.op1_curves(spark, path).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    assert set(got) == set(want) and all(len(rows) == 5 for rows in got.values())
    found = sum(len({v for v, _ in got[q]} & {v for v, _ in rows}) for q, rows in want.items())
    assert found >= 0.9 * 5 * len(want)
    scores = {(q, v): s for q, rows in want.items() for v, s in rows}
    assert all(math.isclose(s, scores.get((q, v), s), rel_tol=1e-12) for q, rows in got.items() for v, s in rows)


def test_windows_without_bound_are_exact(spark, sf):
    df = spark.read.parquet(f"{sf}/embeddings.parquet")
    got = {(r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.col("id") % 50 == 0, ix=ann.Index(recall=1.0)).collect()}
    assert got == {(q, n, v) for q, rows in brute_nearest(sf).items() for n, (v, _) in enumerate(rows, 1)}


def test_ann_ties_go_to_the_smaller_id(spark):
    rows = [(i, [2.0**i, 2.0 ** (i + 1)]) for i in range(40)] + [(100 + i, [1.0, float(i)]) for i in range(30)]
    got = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") == 0).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [1, 2, 3, 4, 5]


def test_ann_extreme_vectors(spark):
    rows = [(0, [1e300, 1e300]), (1, [1e-300, 2e-300]), (2, [3.0, 3.0]), (3, [1.0, 0.0, 0.0]), (50, [0.0, 2.0, 0.0]), (51, [1e-320, 0.0]), (52, [])]
    got = {(r.query_id, r["rank"], r.vec_id): r.score for r in ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0).collect()}
    assert set(got) == {(0, 1, 2), (0, 2, 1), (0, 3, 51), (50, 1, 3)}  # a vector meets those of its own length
    assert math.isclose(got[0, 2, 1], 3 / math.sqrt(10))


def test_ann_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 0.0]), (4, None), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [None, 1.0]), (8, [1.0]), (None, [1.0, 0.0]), (50, [0.0, 1.0]), (50, [0.0, 1.0]), (9, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int")
    got = sorted((r.query_id, r["rank"], r.vec_id) for r in ann.nearest(df, F.col("id") % 50 == 0, k=3).collect())
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 9), (50, 1, 9), (50, 2, 0), (50, 3, 1)]
    assert ann.nearest(df.limit(0), F.col("id") % 50 == 0).count() == 0
    many = spark.createDataFrame([(i, [1.0, 0.0]) for i in range(300)], "vec_id long, embedding array<float>")
    assert [r.vec_id for r in ann.nearest(many, F.col("id") == 50).orderBy("rank").collect()] == [0, 1, 2, 3, 4]


def test_windows_are_fitted_to_structure(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(60, 16)) * 10
    rows = [(i, (centres[i % 60] + 0.01 * rng.normal(size=16)).tolist()) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    windows, fit = [], ann.fitted_window
    monkeypatch.setattr(ann, "fitted_window", lambda *a: windows.append(fit(*a)) or windows[-1])
    exact = {(r.query_id, r.vec_id) for r in ann.nearest(df, F.col("id") % 50 == 0, ix=ann.Index(recall=1.0)).collect()}
    found = {(r.query_id, r.vec_id) for r in ann.nearest(df, F.col("id") % 50 == 0, ix=ann.Index(least=1, curves=8)).collect()}
    assert len(exact) == 300 and len(exact & found) >= 0.9 * len(exact) and windows[0] < 60


def test_hilbert_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    h = hilbert.hilbert_index(grid, 3)
    assert sorted(h) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(h)], axis=0)).sum(axis=1) == 1).all()


def test_shards_against_brute_force(spark, sf, real):
    rows = [(r.doc_id, r.text or "", r.lang, r.source) for r in real.collect()]
    lang, source = {}, {}
    for _, t, la, so in rows:
        lang[t], source[t] = min(la, lang.get(t, la)), min(so, source.get(t, so))
    rank = lambda values: {v: i * 32 // len(set(values)) for i, v in enumerate(sorted(set(values)))}
    langs, sources = rank(lang.values()), rank(source.values())
    points = np.array([(langs[lang[t]], sources[source[t]], min(31, (len(t.encode()) + 8).bit_length())) for _, t, *_ in rows])
    order = sorted(zip(hilbert.hilbert_index(points, 5).tolist(), [hashlib.md5(t.encode()).digest() for _, t, *_ in rows], [i for i, *_ in rows]))
    n = len(rows)
    want = {i: (h, at * 24 // n, at - -(-(at * 24 // n) * n // 24)) for at, (h, _, i) in enumerate(order)}
    assert {r.doc_id: (r.hilbert, r.shard, r.slot) for r in sharding.op10_hilbert_shards(spark, sf).collect()} == want


def test_shards_prune(spark, sf):
    docs = spark.read.parquet(f"{sf.rsplit('/', 1)[0]}/sf0.01/documents.parquet")
    found = sharding.hilbert_shards(docs).cache()
    index, dealt = sharding.shard_index(found).cache(), sharding.shard_index(found.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(24)))).cache()
    read, plain = 0, 0
    for r in found.select("lang", "source").distinct().collect():
        for sizes in ((0, 300), (300, 3000), (3000, 1 << 40)):
            here = {x.shard for x in sharding.admitted(index, r.lang, r.source, sizes).collect()}
            hit = found.where((F.col("lang") == r.lang) & (F.col("source") == r.source) & F.col("size").between(*sizes))
            assert {x.shard for x in hit.select("shard").distinct().collect()} <= here
            read, plain = read + len(here), plain + sharding.admitted(dealt, r.lang, r.source, sizes).count()
    assert read < plain / 3


def test_shards(spark, sf, docs, none):
    got = sharding.op10_hilbert_shards(spark, sf).toPandas()
    counts = got.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert len(counts) == 24 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] + 1 == counts["count"]).all() and (counts["nunique"] == counts["count"]).all()
    own = sharding.hilbert_shards(docs, 4).toPandas()
    assert len(own) == len(ROWS) and own[own.doc_id == 3].iloc[0][["size", "text_crc32"]].tolist() == [8, 0]
    assert own[own.doc_id == 7]["text_crc32"].tolist() == [zlib.crc32("Ünïcode 🙂 text".encode())] * 2
    assert sharding.hilbert_shards(none).count() == 0


def test_mixing_edge_cases(docs, none):
    got = mixing.mixed(docs).toPandas()
    assert len(got) == len(ROWS)
    sizes = got.groupby("source", dropna=False)["size"].sum()
    targets = got.groupby("source", dropna=False)["target"].first()
    assert math.isclose(targets.sum(), sizes.sum()) and (targets <= 3 * sizes + 1e-6).all()
    taken = got.groupby("source", dropna=False)["taken"].sum()
    assert (abs(taken - targets) <= 1).all() and (got.taken <= 3 * got["size"]).all()
    assert got[got.taken > 0].position.between(0, 1).all() and got[got.taken == 0].position.isna().all()
    assert mixing.mixed(none).count() == 0
    again = mixing.mixed(docs.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, again[key].values.tolist()))
    whole = mixing.mixed_documents(docs)
    assert whole.columns == docs.columns and whole.count() > 0 and mixing.mixed_documents(none).count() == 0


def test_mixing_against_its_sql_on_odd_rows(spark, tmp_path):
    import duckdb

    rng = random.Random(4)
    rows = [(None if rng.random() < 0.3 else rng.randrange(40), " ".join(["w"] * rng.choice([0, 0, 1, 5, 400])) or None, rng.choice(["a", "b", None])) for _ in range(300)]
    rows += [(7, "again and again", "a")] * 500 + [(None, "no id", "b")] * 500
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    got = mixing.op9_mixing(spark, str(tmp_path))
    want = con.execute(f"SELECT {', '.join(got.columns)} FROM ({mixing.ORACLE})").fetchall()
    plain = lambda rows: sorted(str([None if v is None else round(v, 9) for v in r]) for r in rows)
    assert plain(got.collect()) == plain(want)


CLASHING = "quality toxicity spans of kind rate copies copy share position own_id own_digest digest __copy __nth __text c0 c1 label node".split()


def test_stages_keep_columns_of_any_name(spark):
    corpus = pytest.importorskip("corpus_pipeline")
    rng = random.Random(1)
    words = [f"word{i}" for i in range(60)]
    texts = [" ".join(rng.choices(words, k=30)) + "." for _ in range(60)]
    rows = [(i, t, "en", "web") for i, t in enumerate(texts)] + [(100, texts[0], "en", "web"), (None, texts[1], None, None), (101, None, "en", "web"), (102, "", "de", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    for n in CLASHING:
        df = df.withColumn(n, F.concat(F.lit(f"{n} of "), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))))
    df = df.withColumn("tags", F.create_map(F.lit("a"), F.col("lang"))).withColumn("a.b", F.struct(F.lit(1).alias("x")))
    labels = spark.createDataFrame([(i, int(i % 5 > 0), int(i % 7 == 0)) for i in range(60)], "doc_id long, quality int, toxic int")
    for made in (quality.kept(df, labels), toxicity.kept(df, labels), simhash.deduplicated(df), mixing.mixed_documents(df)):
        assert made.columns == df.columns
        own = made.collect()
        assert own and all(r[n] == f"{n} of {'none' if r.doc_id is None else r.doc_id}" for r in own for n in CLASHING)
        assert all(r.tags == {"a": r.lang} and r["a.b"].x == 1 for r in own)
    kept = [r.doc_id for r in simhash.deduplicated(df).collect()]
    assert 100 not in kept and None not in kept and len(kept) == 61
    assert corpus.STAGES[0][0] == "quality"


def test_stages_on_empty_tables(spark, none, docs, tmp_path):
    corpus = pytest.importorskip("corpus_pipeline")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus.STAGES:
        made = stage(spark, none, str(tmp_path))
        assert made.count() == 0 and (made.columns == none.columns or name == "tokens")
        assert stage(spark, docs, str(tmp_path)).count() > 0
    none.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus.run(spark, str(tmp_path)).count() == 0


def test_storage(spark, tmp_path):
    from types import SimpleNamespace

    from meridian.llm import common

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))
    mark = common.bookmark()
    tables = [common.stored(spark.range(3), "test") for _ in range(3)]
    paths = [Path(t.inputFiles()[0].removeprefix("file:")).parent for t in tables]
    common.discard(spark, mark, keep=1)
    assert [p.exists() for p in paths] == [False, False, True] and common.bookmark() == mark + 1
    assert common.fresh(spark.range(1).withColumn("_ID", F.lit(1)), "id") == "__id"


def test_spans_point_into_the_text():
    for text in ("İİ grobian İx grobheit", "plain grobian", "ŉ ﬀ İ̇ grobian", "ΑΣ Σ grobian"):
        found = toxicity.words_of(text)
        spans = toxicity.word_spans(text)
        assert len(found) == len(spans)
        assert all(text[a:b].lower() == w for w, (a, b) in zip(found, spans) if w.startswith("grob"))
        assert any(w == "grobian" for w in found)


def test_toxicity_training_is_bounded_in_bytes(spark):
    rows = [(i, f"word{i} grobian " * (4000 if i % 10 == 0 else 20)) for i in range(0, 200, 2)] + [(i, f"word{i} kind " * 20) for i in range(1, 200, 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id long, toxic int")
    seen = []
    fit = toxicity.fit
    toxicity.fit = lambda texts, marks, s: seen.append(sum(map(len, texts))) or fit(texts, marks, s)
    try:
        assert toxicity.train(df, labels, toxicity.Settings(document_bytes=10_000, label_bytes=12_000)) is not None
    finally:
        toxicity.fit = fit
    assert 0 < seen[0] <= 1.5 * 24_000


def test_positions_invert_the_schedule(spark):
    mix = mixing.DEFAULT
    for kind, knots in enumerate(mix.schedules):
        for share in (0.0, 0.1, 0.37, 0.5, 0.9, 1.0):
            t = spark.range(1).select(F.expr(mixing.position_sql(mix, str(kind), f"{share}e0")).alias("t")).first().t
            at = np.linspace(0, t, 20001)
            w = np.interp(at, *zip(*knots))
            assert abs(np.trapezoid(w, at) / mix.weights()[kind] - share) < 1e-6


def test_quality(spark, sf, docs, none):
    got = quality.op3_quality(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 3 == 1 for i in got.doc_id]).all()
    m = got.merge(labels, on="doc_id")
    assert ((m.predicted == m.quality)[m.held_out]).mean() >= 0.9
    names = quality.scored(docs, None)
    assert names.columns == [*docs.columns, "quality"] and names.count() == len(ROWS)
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(docs, empty) is None and quality.kept(docs, empty).count() == len(ROWS)
    assert quality.kept(none, empty).count() == 0
    assert quality.features(None).shape == quality.features("").shape == quality.features(LONG).shape


def test_non_negative_risk_separates_unlabelled_text():
    rng = np.random.default_rng(0)
    n = 1600
    good, bad = np.zeros((n, quality.FEATURES)), np.zeros((n, quality.FEATURES))
    good[:, :40], bad[:, :40] = rng.normal(0.3, 0.1, (n, 40)), rng.normal(0.3, 0.1, (n, 40))  # texts use few features
    bad[:, :5] += 0.4
    good, bad = good.clip(0).astype(np.float32), bad.clip(0).astype(np.float32)
    u = np.vstack([good[n // 2 :], bad[: n // 4]])
    m = quality.fit(good[: n // 2], u, 2 / 3, quality.Settings())
    assert (m.score(good[n // 2 :]) >= 0.5).mean() > 0.95 and (m.score(bad[n // 4 :]) < 0.5).mean() > 0.95


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_prior_is_estimated_from_positives_and_unlabelled(share):
    rng = np.random.default_rng(3)
    made = lambda n, up: (rng.normal(0.3, 0.1, (n, quality.FEATURES)) + 0.3 * up * (np.arange(quality.FEATURES) < 5)).clip(0).astype(np.float32) * (np.arange(quality.FEATURES) < 40)
    many = 3000
    u = np.vstack([made(int(many * share), 0), made(many - int(many * share), 1)])
    assert abs(quality.estimated_prior(made(1600, 0), u, quality.Settings(steps=150)) - share) < 0.08


def brute_marginals(potential, trans, start):
    n = len(potential)
    weight = np.zeros(n)
    whole = 0.0
    for state in range(1 << n):
        s = [state >> i & 1 for i in range(n)]
        w = start[s[0]]
        for i in range(n):
            w *= (potential[i] if s[i] else 1) * (trans[s[i - 1], s[i]] if i else 1)
        whole += w
        weight += w * np.array(s)
    return weight / whole, math.log(whole)


def test_forward_backward_against_enumeration():
    rng = np.random.default_rng(4)
    trans, start = np.array([[0.9, 0.2], [0.4, 1.3]]), np.array([0.8, 0.3])
    lengths = [1, 4, 9, 2, 7]
    potential = np.exp(rng.normal(size=sum(lengths)))
    first = np.zeros(len(potential), bool)
    first[np.cumsum([0, *lengths[:-1]])] = True
    p, edges, log_z = toxicity.forward_backward(potential, first, trans, start, True)
    at, total = 0, 0.0
    for n in lengths:
        want, z = brute_marginals(potential[at : at + n], trans, start)
        assert np.allclose(p[at : at + n], want)
        at, total = at + n, total + z
    assert math.isclose(log_z, total) and math.isclose(edges.sum(), sum(n - 1 for n in lengths))


def test_chance_tags_no_words():
    rng = np.random.default_rng(11)
    words = [f"w{i}" for i in range(3000)]
    texts = [" ".join(rng.choice(words, 80)) for _ in range(700)]
    copies = [texts[0] + f" tail{i}" for i in range(40)]  # one toxic text and its near copies count once
    labels = [int(i % 7 == 0) for i in range(700)] + [1] * 40
    assert not toxicity.telling_words(texts + copies, labels, toxicity.Settings())
    marked = [t + " grobian" if k else t for t, k in zip(texts + copies, labels)]
    assert toxicity.telling_words(marked, labels, toxicity.Settings()) == {"grobian"}


def test_toxicity(spark, docs, none):
    rng = np.random.default_rng(6)
    plain, bad = [f"word{i}" for i in range(200)], ["grobian", "grobheit", "scheusal"]
    rows, marks = [], []
    for i in range(400):
        text = rng.choice(plain, 60).tolist()
        if i % 4 == 0:
            for at in rng.choice(60, 4, replace=False):
                text[at] = bad[int(rng.integers(0, 3))]
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(i % 4 == 0)))
    df, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    model = toxicity.train(df, labels)
    got = {r.doc_id: r for r in toxicity.scored(df, model).collect()}
    assert all((got[i].toxicity >= 0.7) == (i % 4 == 0) for i in got)
    text = dict(rows)
    assert {text[0].lower()[s.start : s.stop] for s in got[0].spans} <= set(bad) | {f"{a} {b}" for a in bad for b in bad} and got[0].spans
    assert toxicity.kept(df, labels).count() == 300
    edge = toxicity.scored(docs, model)
    assert edge.count() == len(ROWS) and edge.columns == [*docs.columns, "toxicity", "spans"]
    assert toxicity.scored(none, model).count() == 0 and toxicity.scored(docs, None).count() == len(ROWS)


def test_gif_round_trips(spark, docs, none):
    rng = np.random.default_rng(9)
    for n in (192, 192 * 256, 192 * 257, 192 * 3000):
        for data in (bytes(n), bytes(rng.integers(0, 256, n, dtype=np.uint8)), (b"abcabd" * n)[:n]):
            assert gif.read_samples(gif.write_gif(data)) == data
    got = {r.doc_id: r for r in gif.frames_of(gif.encoded(docs)).collect() if r.doc_id is not None}
    for i, text, *_ in ROWS:
        if i is None:
            continue
        data = (text or "").encode()
        padded = data + b" " * (-len(data) % 192 if data else 192)
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-16:]))
    assert gif.frames_of(gif.encoded(none)).count() == 0 and gif.shown(gif.encoded(none)).count() == 0
    long = got[6]
    assert sum(long.red) == 192 * 256 * len(long.frames) and long.frames[1].start_ms == 40 and long.error is None
    assert [sum(c) for c in zip(*[f.red for f in long.frames])] == long.red == long.blue


def _gif(frames, size=(4, 2), palette=bytes(range(12))):
    import struct

    out = [b"GIF89a", struct.pack("<HHBBB", *size, 0x81, 0, 0), palette]
    for left, top, w, h, flags, delay, transparent, own, samples in frames:
        out.append(b"\x21\xf9\x04" + struct.pack("<BHBB", flags, delay, transparent, 0))
        out.append(b"\x2c" + struct.pack("<HHHHB", left, top, w, h, 0x81 if own else 0) + (own or b"") + b"\x08" + gif._blocks(gif.lzw_encode(bytes(samples))))
    return b"".join([*out, b"\x3b"])


def test_gif_rules():
    own = bytes([200] * 12)
    data = _gif([
        (0, 0, 4, 2, 1 << 2, 5, 0, None, [1] * 8),
        (1, 0, 2, 1, 3 << 2, 7, 0, own, [0, 1]),
        (0, 0, 2, 2, (2 << 2) | 1, 9, 3, None, [2, 3, 3, 2]),
        (3, 1, 1, 1, 0, 0, 0, None, [0]),
    ])
    size, frames = gif.read_frames(data)
    assert size == (4, 2) and [(f.start_ms, f.delay_ms) for f in frames] == [(0, 50), (50, 70), (120, 90), (210, 0)]
    a, b, c, d = [canvas.copy() for canvas in gif.drawn(size, frames)]
    assert (a[..., :3] == [3, 4, 5]).all() and (b[0, 1:3, :3] == 200).all()
    assert c[0, 0, :3].tolist() == [6, 7, 8] and c[0, 1, :3].tolist() == [3, 4, 5]
    assert (d[:2, :2, 3] == 0).all() and d[1, 3, :3].tolist() == [0, 1, 2]
    for stop in (10, len(data) - 1):
        with pytest.raises(Exception):
            gif.read_frames(b"JPEG" + data[:stop])


#: Files that other programs wrote.
SAMPLE = bytes.fromhex(
    "474946383961 0a000a00910000 ffffffff00000000ff000000 21f9040000000000 2c000000000a000a0000"
    "02168c2d99872a1cdc33a00275ec95faa8de608c04914c0100 3b"
)
DOT = base64.b64decode("R0lGODlhAQABAIAAAAAAAP///yH5BAEAAAAALAAAAAABAAEAAAIBRAA7")


def plain_lzw(samples, size, clears):
    """Codes by the book, one at a time; without ``clears`` a full table just stays."""
    clear, bits, at = 1 << size, [], size + 1
    put = lambda code, n: bits.extend(code >> i & 1 for i in range(n))
    known, run = {(i,): i for i in range(clear)}, ()
    put(clear, at)
    for s in samples:
        if (*run, s) in known:
            run = (*run, s)
            continue
        put(known[run], at)
        if len(known) + 2 < 4096:
            known[(*run, s)] = len(known) + 2
            at += len(known) + 1 == 1 << at and at < 12
        elif clears:
            put(clear, at)
            known, at = {(i,): i for i in range(clear)}, size + 1
        run = (s,)
    put(known[run], at)
    at += len(known) + 2 == 1 << at and at < 12
    put(clear + 1, at)
    return bytes(sum(b << i for i, b in enumerate(bits[k : k + 8])) for k in range(0, len(bits), 8))


def test_gif_files_of_other_programs():
    size, (frame,) = gif.read_frames(SAMPLE)
    top, mid = [1] * 5 + [2] * 5, [1] * 3 + [0] * 4 + [2] * 3
    rows = [top] * 3 + [mid] * 2 + [[3 - x if x else 0 for x in mid]] * 2 + [[3 - x for x in top]] * 3
    assert size == (10, 10) and frame.index.tolist() == rows
    size, (frame,) = gif.read_frames(DOT)
    assert size == (1, 1) and frame.transparent == 0 and frame.index.tolist() == [[0]]
    (canvas,) = gif.drawn(size, [frame])
    assert canvas[0, 0, 3] == 0 and gif.histogram(canvas).sum() == 0


@pytest.mark.parametrize("size", [2, 4, 8])
@pytest.mark.parametrize("clears", [True, False])
def test_lzw_of_another_encoder(size, clears):
    rng = np.random.default_rng(size)
    for n in (1, 2, 50, 30_000):
        samples = bytes(rng.integers(0, 1 << size, n, dtype=np.uint8))
        assert gif.lzw_decode(plain_lzw(samples, size, clears), size) == samples


def test_media_columns(spark):
    good = _gif([(0, 0, 4, 2, 1 << 2, 5, 0, None, [1] * 8), (0, 0, 1, 1, 2 << 2, 3, 0, None, [2]), (3, 1, 1, 1, 1, 0, 0, None, [0])])
    odd = {"cut": good[:30], "text": b"hello", "none": None, "empty": b"", "huge": b"GIF89a" + b"\xff" * 4 + b"\0\0\0;", "code": good.replace(b"\x00\x08", b"\x00\x0e", 1), "head": b"GIF89a\x01"}
    rows = [("good", good, 1), ("good", good, 1), *[(k, v, 1) for k, v in odd.items()]]
    got = {r.name: r for r in gif.frames_of(spark.createDataFrame(rows, "name string, media binary, __x int")).collect()}
    r = got["good"]
    assert r.error is None and [(f.start_ms, f.delay_ms, f.disposal, f.transparent) for f in r.frames] == [(0, 50, 1, None), (50, 30, 2, None), (80, 0, 0, 0)]
    assert [sum(f.red) for f in r.frames] == [8, 8, 7]  # the cleared corner is not counted, the transparent dot shows what was there
    assert all(got[k].frames is None and got[k].error for k in odd) and got["none"].media_bytes is None and got["cut"].media_bytes == 30
    flat = gif.shown(spark.createDataFrame(rows, "name string, media binary, __x int"), "name").orderBy("nth").collect()
    assert len(flat) == 6 and {f.name for f in flat} == {"good"}
    last = np.frombuffer(zlib.decompress(flat[-1].rgba), np.uint8).reshape(2, 4, 4)
    assert last[0, 0].tolist() == [0] * 4 and last[1, 3].tolist() == [3, 4, 5, 255]
    with pytest.raises(ValueError):
        gif.frames_of(spark.createDataFrame([(b"", 1)], "media binary, red int"))


ODD = ["", " ", "a  b", "A\x1cB", "İSTANBUL ΣΑΣ Σ", "é café", "don't WE'LL 12345", "<|endoftext|>x <|startoftext|>", "日本語 テキスト 🙂🙂", "x" * 5000, "a　b​c", "\x00\x01\x85 z", "!?" * 300, "\n", "x\n\ny", " x\n", "a\t b\r\nc"]


def test_bpe_equals_the_library(real, docs, none):
    from tokenizers import Tokenizer

    path = bpe.default_path()
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    for text in [*ODD, *[r.text for r in real.collect()]]:
        want = library.encode(text, add_special_tokens=False).ids
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)
    got = bpe.digests(docs).collect()
    assert len(got) == len(ROWS) and {r.n_tokens for r in got if r.doc_id in (3, 4, 5)} == {0}
    assert bpe.digests(none).count() == 0
    assert bpe.encoded(none).count() == 0
    back = {r.doc_id: r.text for r in bpe.decoded(bpe.encoded(docs)).collect()}
    assert back[7].startswith("ü") or "</w>" in back[7]


def test_bpe_on_signs_of_all_planes():
    from tokenizers import Tokenizer

    path, rng = bpe.default_path(), random.Random(5)
    library, own = Tokenizer.from_file(path), bpe.WordBpe(path)
    pools = [range(32, 127), range(0x80, 0x250), range(0x250, 0x3000), range(0x3000, 0xD800), range(0xE000, 0x10000), range(0x10000, 0x33480), [9, 10, 13, 32, 0x1C, 0x85, 0xA0, 0x2028, 0x3000, 0x200B]]
    pools.append([0x558, 0x1C89, 0x1C8A, 0x3262F, 0xA7DA, 0x130, 0x3A3, 0x3C2, 0x1E9E, 0x345, 0x301, 0x327, 0x1ABF, 0x1AC0, 0x8CA])
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randint(1, 12))) for _ in range(100_000)]
    for text, want in zip(texts, library.encode_batch_fast(texts, add_special_tokens=False)):
        assert np.frombuffer(own.encode(text), "<u4").tolist() == want.ids, ascii(text)


def test_segment_tree_merges_leftmost_lowest():
    rng = np.random.default_rng(8)
    pairs = {a << 20 | b: (int(r), 100 + i) for i, (r, (a, b)) in enumerate(zip(rng.permutation(16), [(a, b) for a in range(4) for b in range(4)]))}
    for n in range(1, 60):
        symbols = rng.integers(0, 4, n).tolist()
        want = symbols.copy()
        while True:
            best = min(((pairs[x << 20 | y][0], i) for i, (x, y) in enumerate(zip(want, want[1:])) if x << 20 | y in pairs), default=None)
            if best is None:
                break
            i = best[1]
            want[i : i + 2] = [pairs[want[i] << 20 | want[i + 1]][1]]
        assert bpe.merged(symbols, pairs) == want


def test_token_files(spark, sf, real, docs, none):
    from tokenizers import Tokenizer

    path = bpe.default_path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    start = 0
    got = {r.doc_id: r for r in token_files.op6_token_files(spark, sf).collect()}
    for r in real.orderBy("doc_id").collect():
        ids = np.array([*library.encode(r.text, add_special_tokens=False).ids, 0], "<u4")
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    import pyarrow as pa

    odd = [*ODD, None]
    for text, ids in zip(odd, token_files.Encoder(path).encode_batch(pa.array(odd))):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text or "", add_special_tokens=False).ids
    for layout in (token_files.Layout(planes=32, block=1000, ids_per_file=5000), token_files.Layout(block=7)):
        back = token_files.read_back(token_files.files(docs, layout)).orderBy("start").collect()
        assert len(back) == len(ROWS) and back[0].doc_id is None and back[-1].start + back[-1].n_tokens == sum(r.n_tokens for r in back)
    assert token_files.read_back(token_files.files(none)).count() == 0


def test_token_files_beyond_the_broadcast_bound(docs, monkeypatch):
    layout = token_files.Layout(ids_per_file=2000)
    want = sorted((r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_back(token_files.files(docs, layout)).collect())
    monkeypatch.setattr(token_files, "MOST_BROADCAST", 0)
    assert sorted((r.start, r.n_tokens, r.ids_crc32) for r in token_files.read_back(token_files.files(docs, layout)).collect()) == want


def wrapped(text, width, lead=""):
    """The text as files carry it: lines of ``width`` signs, each with a comment's lead."""
    return "\n".join(lead + line for part in text.split("\n") for line in (textwrap.wrap(part, width) or [""]))


def test_licences(spark, docs, none):
    mit = "MIT LICENCE\n\nCopyright (c) 2020 Someone\nAll rights reserved.\n\n" + licences._MIT.replace(",", "").upper()
    wide = "Released under the " + "-" * 400 + " MIT License."
    rows = [
        (1, mit), (2, "prose\nReleased under the  MIT Licence\nmore"), (3, mit + " extra"), (4, None),
        (5, "LICENSED UNDER CC BY-NC 4.0!\nThis work is licensed under the GNU General Public License, version 3."), (6, wide), (7, "x\n/*" + "*" * 300 + "/ " + wide),
        (None, "Released under Apache 2.0"), (None, "Released under Apache 2.0"), (9, "Released under the MIT Licence and more"),
    ]
    got = sorted((r.doc_id or 0, r.licence, r.notices) for r in licences.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [
        (0, None, "Apache-2.0"), (0, None, "Apache-2.0"), (1, "MIT", ""), (2, None, "MIT"), (3, None, ""), (4, None, ""),
        (5, None, "CC-BY-NC-4.0,GPL-3.0"), (6, None, "MIT"), (7, None, "MIT"), (9, None, ""),
    ]
    assert licences.scanned(docs).count() == len(ROWS) and licences.scanned(none).count() == 0


@pytest.mark.parametrize("width,lead", [(72, ""), (40, " * "), (60, "# "), (1000, "    ")])
def test_licences_as_files_carry_them(spark, width, lead):
    holders = ["Copyright (c) 2019-2024, Somebody Else <a@b.c>", "Copyright © Another", "(C) 2001 A Third", "All rights reserved."]
    rows = [(i, "\n".join(lead + h for h in holders) + "\n\n" + wrapped(text.replace('"', "''"), width, lead)) for i, (_, text) in enumerate(licences.TEXTS)]
    got = {r.doc_id: r.licence for r in licences.scanned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {i: name for i, (name, _) in enumerate(licences.TEXTS)} and len(set(got.values())) >= 20


def test_full_texts_of_long_licences(spark):
    folder = Path("/usr/share/common-licenses")
    names = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    rows = [(name, (folder / file).read_text()) for file, name in names.items() if (folder / file).exists()]
    if not rows:
        pytest.skip("no licence texts on this machine")
    got = licences.scanned(spark.createDataFrame([(i, "\t" + t.upper()) for i, (_, t) in enumerate(rows)], "doc_id long, text string"))
    assert {r.doc_id: r.licence for r in got.collect()} == {i: name for i, (name, _) in enumerate(rows)}


def test_licences_of_a_table_of_ones_own(spark):
    own = spark.createDataFrame([("House", "You may look, but not touch.")], "licence string, text string")
    docs = spark.createDataFrame([(1, "YOU MAY LOOK -- but not touch"), (2, "You may touch")], "doc_id long, text string")
    assert {r.doc_id: r.licence for r in licences.scanned(docs, own).collect()} == {1: "House", 2: None}


def test_pipeline(spark, sf):
    corpus = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    names, rows = docs.columns, docs
    for name, stage in corpus.STAGES:
        before = rows
        rows = stage(spark, rows, sf).cache()
        if name != "tokens":
            assert rows.columns == names
        if name in ("quality", "toxicity", "near_duplicates"):
            assert rows.select("doc_id").subtract(before.select("doc_id")).count() == 0
        if name == "near_duplicates":
            want = {r.component_id for r in simhash.near_duplicates(before, simhash.NEAR_DEDUP).collect()}
            assert {r.doc_id for r in rows.collect()} == want
    good = labels.where("quality = 1 and toxic = 0")
    after = quality.kept(docs, labels)
    assert after.join(good, "doc_id", "left_semi").count() >= 0.95 * docs.join(good, "doc_id", "left_semi").count()
    assert rows.columns == ["doc_id", "ids"] and rows.count() > 0
