"""Further hand-computed cases: readers, outbox, names, manifests, composites, events."""

from meridian.operators import composites, incremental, intervals, search, sequence, upsert, vectors
from meridian.sources import readers, writers
from meridian.streaming import detection
from pyspark.sql import functions as F


def test_readonly_guard():
    assert readers.is_readonly("SELECT 1") and readers.is_readonly("with a as (select 'drop it') select * from a -- delete\n")
    assert not any(map(readers.is_readonly, ("DROP TABLE x", "select 1; delete from x", "with a as (select 1) insert into b select * from a", "")))


def test_gps_and_trips(spark, tmp_path):
    (tmp_path / "g.csv").write_text("Key,MPH,Lat,Long,Frame\nk,35,35.5,-120.25,61\nk,x,,,90\n")
    got = readers.read_gps_csv(spark, str(tmp_path / "g.csv")).orderBy("frame").collect()
    assert (got[0].sec, got[0].mph, got[0].lat, got[0].lon) == (2, 35.0, 35.5, -120.25) and got[1].mph is None and got[1].sec == 3
    (tmp_path / "t.csv").write_text('trackerName,startTime,endTime,tripMiles\nt,01/02/2024 03:04 PM,bad,"1,200.5"\n')
    trip = readers.read_trips_csv(spark, str(tmp_path / "t.csv")).first()
    assert str(trip.start_time) == "2024-01-02 15:04:00" and trip.end_time is None and trip.miles == 1200.5


def test_entities_and_catalogue(spark, tmp_path):
    (tmp_path / "x_entities.csv").write_text("entity,type,confidence\nBob,Person,.9\n,Place,.1\n")
    rows = readers.read_entities_csv(spark, str(tmp_path / "x_entities.csv")).collect()
    assert [(r.text, r.label, r.score) for r in rows] == [("Bob", "Person", 0.9)]
    folder = tmp_path / "2024-03-05"
    folder.mkdir()
    (folder / "a.jpg").write_bytes(b"x")
    media = readers.media_catalogue(readers.scan_files(spark, [str(tmp_path)])).collect()
    assert [str(m.date) for m in media] == ["2024-03-05"]
    assert {r.kind for r in readers.files_by_key(readers.scan_files(spark, [str(tmp_path)])).collect()} == {"entities", "media"}


def test_outbox_and_names(spark):
    intents = spark.createDataFrame([("a", "new", 0), ("b", "new", 5), ("c", "done", 0), ("d", "failed", 1)], "key string, status string, tries int")
    landed = spark.createDataFrame([("d",)], "key string")
    assert [r.key for r in upsert.pending_intents(intents, landed, "key", 3).collect()] == ["a"]
    names = spark.createDataFrame([(1, "a.txt"), (2, "a.txt"), (3, "b.txt")], "id int, name string")
    got = {r.id: r.final for r in upsert.free_name(names, spark.createDataFrame([("b.txt",)], "name string")).collect()}
    assert got == {1: "a.txt", 2: "a_1.txt", 3: "b_1.txt"}


def test_manifests(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b"])], "id int, tags array<string>")
    for _ in range(2):
        writers.write_manifest(df, str(tmp_path / "m"))
    assert spark.read.json(str(tmp_path / "m/jsonl")).count() == 2
    assert spark.read.option("header", "true").csv(str(tmp_path / "m/csv")).first().tags == "a|b"


def test_fuzzy_keys_and_calendar(spark):
    left = spark.createDataFrame([("2025_0101",), ("2025_0202_x",), ("nothing_here",)], "k string")
    right = spark.createDataFrame([("2025_0101", "a/b/1"), ("2025_0101", "a/1"), ("2025_0202", "c/2")], "rk string, path string")
    got = {r.k: r.path for r in composites.fuzzy_key_join(left, right, "k", "rk", "path").collect()}
    assert got == {"2025_0101": "a/1", "2025_0202_x": "c/2", "nothing_here": None}
    slots = spark.createDataFrame([("c", 1, "x"), ("c", 2, "y"), ("c", 3, "x"), ("c", 4, "z"), ("d", 1, "x")], "k string, slot int, topic string")
    shorts = spark.createDataFrame([("c", "s1", "y", 0), ("c", "s2", "x", 1), ("c", "s3", "q", 2), ("e", "s4", "x", 0)], "k string, short_id string, topic string, place int")
    got = {(r.k, r.slot): r.short for r in composites.calendar(slots, shorts, ["k"]).collect()}
    assert got == {("c", 1): "s2", ("c", 2): "s1", ("c", 3): "s3", ("c", 4): None, ("d", 1): None}


def test_suppression_tracks_and_copies(spark):
    df = spark.createDataFrame([("f", 1, 0.0, 9.0), ("f", 2, 3.0, 8.0), ("f", 3, 10.0, 7.0), ("f", 4, 5.0, 6.0)], "k string, id int, t double, s double")
    assert {r.id for r in sequence.suppressed(df, ["k"], "s", "t", "id", 5.0, 3).where("kept").collect()} == {1, 3, 4}
    boxes = spark.createDataFrame([("c", 1, 0, [0.0, 0.0, 9.0, 9.0]), ("c", 2, 1, [5.0, 5.0, 12.0, 12.0]), ("c", 3, 1, [50.0, 50.0, 60.0, 60.0]), ("c", 4, 99, [5.0, 5.0, 12.0, 12.0])], "k string, id int, frame int, box array<double>")
    assert {r.id: r.track for r in sequence.tracks(boxes, ["k"], "frame", "box", 15, "id").collect()} == {1: 0, 2: 0, 3: 1, 4: 2}
    vecs = spark.createDataFrame([("g", i, v) for i, v in enumerate([[1.0, 0.0], [1.0, 0.01], [0.0, 1.0], [1.0, 0.0]])], "k string, n int, v array<double>")
    assert [r.kept for r in sequence.consecutive_distinct(vecs, ["k"], ["n"], "v", 0.95).orderBy("n").collect()] == [True, False, True, True]


def test_spacing_and_chunks(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("a", 3, 80.0)], "k string, id int, t double")
    assert {r.id for r in sequence.spacing_filter(df, ["k"], ["t", "id"], "t", 6.0, 8.0, 5).where("kept").collect()} == {1, 3}
    plan = intervals.chunk_plan(spark.createDataFrame([(130.0,), (0.0,)], "d double"), "d").where("d = 130").orderBy("chunk").collect()
    assert [r.chunk_start for r in plan] == [0.0, 60.0, 120.0] and plan[-1].chunk_stop == 130.0


def test_updates_and_identify(spark):
    protos = spark.createDataFrame([("p", [1.0, 0.0], 3.0)], "proto string, embedding array<double>, weight_sum double")
    items = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 1.0])], "id int, embedding array<double>")
    found = vectors.assign(items, protos, 0.5, "id", "proto")
    assert [r.id for r in found.collect()] == [1]
    new = vectors.updated_prototypes(protos, found, items, "id", "proto", 0.9).first()
    assert new.weight_sum == 4.0 and new.status == "confirmed" and abs(sum(x * x for x in new.embedding) - 1) < 1e-9
    named = protos.withColumn("name", F.lit("n"))
    assert {r.id: r.verdict for r in vectors.identify(items, named, "id", "proto", "name").collect()} == {1: "match", 2: "none"}


def test_events_roll(spark):
    frames = spark.createDataFrame([("c", float(t), 1 if t in (5, 6) else 0) for t in range(12)], "camera_id string, ts double, n_detections int")
    found = detection.events(frames)
    roll = detection.pre_post_roll(frames, found, 2.0, 1.0)
    assert sorted(r.ts for r in roll.collect()) == [4.0, 5.0, 6.0, 7.0]


def test_state_steps(spark):
    df = spark.createDataFrame([("a", "b", False), ("a", "c", False), ("a", "c", True)], "f string, t string, forced boolean")
    assert [r.ok for r in df.select(incremental.valid_step(["a", "b", "c"], F.col("f"), F.col("t"), F.col("forced")).alias("ok")).collect()] == [True, False, True]


def test_propagation(spark):
    direct = spark.createDataFrame([(1, "a"), (1, "b")], "item int, node string")
    edges = spark.createDataFrame([("a", "b", 2000), ("a", "c", 1000), ("b", "d", 999)], "src string, dst string, weight int")
    assert [(r.item, r.node) for r in search.propagated(direct, edges, "item", "node", 1000).collect()] == [(1, "c")]


def test_pairs_do_not_depend_on_blocks(spark):
    import math

    rows = [(i, i % 2, [math.cos(i * 0.3), math.sin(i * 0.3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, g int, embedding array<double>")
    want = {(a, b) for a, _, u in rows for b, _, v in rows if a < b and sum(x * y for x, y in zip(u, v)) >= 0.9}
    for block in (3, 7, 1000):
        assert sorted((r.a, r.b) for r in vectors.near_duplicate_pairs(df, 0.9, block=block).collect()) == sorted(want)
        inner = [(r.a, r.b) for r in vectors.near_duplicate_pairs(df, 0.9, by=["g"], block=block).collect()]
        assert sorted(inner) == sorted((a, b) for a, b in want if a % 2 == b % 2)


def test_similarity_join_without_broadcast(spark, monkeypatch):
    rows = [(i, [float(i % 7 - 3), float(i % 5 - 2), 1.0]) for i in range(30)]
    left = spark.createDataFrame(rows, "l int, embedding array<double>")
    right = spark.createDataFrame(rows[:12], "r int, embedding array<double>")
    want = {(x.l, x.r, x["rank"]) for x in vectors.similarity_join(left, right, 3, 0.2, "l", "r").collect()}
    monkeypatch.setattr(vectors, "MOST_BROADCAST", 0)
    assert want and {(x.l, x.r, x["rank"]) for x in vectors.similarity_join(left, right, 3, 0.2, "l", "r", block=7, parts=3).collect()} == want


def test_many_places_go_through_the_grid(spark):
    from meridian.operators import nearest

    points = spark.createDataFrame([(i, i * 0.01, i * 0.02) for i in range(30)], "p int, lat double, lon double")
    places = spark.createDataFrame([(i, i * 0.03, i * 0.05) for i in range(15)], "q int, lat double, lon double")
    few = {(r.p, r.q) for r in nearest.nearest_of_few(points, places, "p", "q", 5000.0).collect()}
    assert few and {(r.p, r.q) for r in nearest.nearest_of_few(points, places, "p", "q", 5000.0, most_places=3).collect()} == few


def test_vocabulary_links(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "A."), (3, None), (4, "")], "id int, t string")
    names = spark.createDataFrame([(1, "B, c d"), (2, "A"), (3, "a b c d"), (4, "c a")], "n int, name string")
    for name, most in (("MOST_INLINE", search.MOST_INLINE), ("MOST_INLINE", 0), ("MOST_BROADCAST", 0)):
        monkeypatch.setattr(search, name, most)
        got = {(r.id, r.n) for r in search.vocabulary_links(docs, names, "id", "t", "n", "name").collect()}
        assert got == {(1, 1), (1, 2), (1, 3), (2, 2)}


def test_vocabulary_links_of_long_names(spark):
    docs = spark.createDataFrame([(1, "zero one, two three four five six"), (2, "one two three"), (3, "one two three four six")], "id int, t string")
    names = spark.createDataFrame([(1, "One two three four five"), (2, "two three"), (3, "zero one two three four five six"), (4, "one two three four five six seven")], "n int, name string")
    for most in (1, 2, 4):
        got = {(r.id, r.n) for r in search.vocabulary_links(docs, names, "id", "t", "n", "name", most).collect()}
        assert got == {(1, 1), (1, 2), (2, 2), (3, 2), (1, 3)}
    assert search.vocabulary_links(docs, names.where("n > 9"), "id", "t", "n", "name").count() == 0


def test_fuzzy_keys_of_few_signs(spark):
    lefts = ["clip_07", "2025_0303_clip_09", "ab", "zz", "x", "long_key_without", "clip_09"]
    rights = [("2025_clip_07_front", "a/1"), ("clip_07_x", "b/2"), ("clip_09", "c/3"), ("abc", "d/4"), ("b", "e/5"), ("x", "f/6")]
    want = {}
    for k in lefts:
        held = [(abs(len(k) - len(r)), p.count("/"), p) for r, p in rights if k in r or r in k]
        want[k] = min(held)[2] if held else None
    got = composites.fuzzy_key_join(spark.createDataFrame([(k,) for k in lefts], "k string"), spark.createDataFrame(rights, "rk string, path string"), "k", "rk", "path")
    assert {r.k: r.path for r in got.collect()} == want


def test_ranks_without_windows_over_everything(spark):
    import random

    from meridian.operators import ranks

    rows = [(i, random.Random(i).randrange(50), random.Random(i + 1).choice([1, 2, None])) for i in range(400)]
    df = spark.createDataFrame(rows, "id int, k int, v int").repartition(7)
    order = sorted(rows, key=lambda r: (-r[1], r[0]))
    by = [F.col("k").desc(), F.col("id")]
    assert {r.id: r["rank"] for r in ranks.ranked(df, by).collect()} == {r[0]: n for n, r in enumerate(order)}
    sums, so_far = {}, 0
    for i, _, v in order:
        so_far += v or 0
        sums[i] = so_far
    assert {r.id: r.s for r in ranks.running_sum(df, by, F.col("v"), "s").collect()} == sums
    assert {r.id: r.nxt for r in ranks.followed(df, by, "id", "nxt").collect()} == {a[0]: b[0] if b else None for a, b in zip(order, [*order[1:], None])}
    for made in (ranks.ranked(df.limit(0), by), ranks.running_sum(df.limit(0), by, F.col("v"), "s"), ranks.followed(df.limit(0), by, "id", "nxt")):
        assert made.count() == 0


def test_kmeans_finds_separate_groups(spark):
    import random

    rng = random.Random(1)
    rows = [(i, [1000.0 * (i % 3) + rng.random(), -1000.0 * (i % 3) + rng.random()]) for i in range(90)] + [(900, [9000.0, 9000.0]), (901, [9000.1, 9000.0])]
    got = {r.id: r.cluster for r in vectors.kmeans(spark.createDataFrame(rows, "id int, embedding array<double>"), [2, 4, 6], least=5).collect()}
    assert got[900] is None and got[901] is None and len(got) == 92
    assert len({got[i] for i in range(90)}) == 3 and all(got[i] == got[i % 3] is not None for i in range(90))


def test_hashed_embedding_by_hand(spark):
    import struct

    import pytest

    xxhash = pytest.importorskip("xxhash")

    def brute(text, dims):
        out = [0.0] * dims
        for w in text.lower().split():
            h = xxhash.xxh64_intdigest(w.encode(), 42)
            signed = h - (1 << 64) if h >> 63 else h
            second = xxhash.xxh64_intdigest(struct.pack("<i", 1), h)
            out[signed % dims] += 1.0 if second % 2 == 0 else -1.0
        size = sum(x * x for x in out) ** 0.5
        return [x / size if size else x for x in out]

    texts = ["the quick brown fox", "The the THE", "", "a b c d e f g h"]
    got = spark.createDataFrame(list(enumerate(texts)), "id int, text string").select("id", composites.hashed_embedding(F.col("text"), 16).alias("v")).collect()
    assert all(max(abs(a - b) for a, b in zip(r.v, brute(texts[r.id], 16))) < 1e-12 for r in got)


def test_trajectory_vector_by_hand(spark):
    import cmath
    import math

    points = [("a", float(t), 2.0 * t, 5.0) for t in range(0, 120, 2)]  # a straight walk: positions are evenly spaced
    got = sequence.trajectory(spark.createDataFrame(points, "k string, t double, x double, y double"), ["k"], "t", "x", "y").first().embedding
    at = [118 * i / 59 for i in range(60)]
    xs, ys = [2 * t for t in at], [5.0] * 60
    speed = lambda v: [0.0, *[b - a for a, b in zip(v, v[1:])]]
    tone = lambda v, k: abs(sum(x * cmath.exp(-2j * math.pi * k * n / 60) for n, x in enumerate(v)))
    want = [tone(v, k) for v in (xs, ys, speed(xs), speed(ys)) for k in range(16)]
    size = math.sqrt(sum(w * w for w in want))
    assert len(got) == 64 and all(abs(a - b / size) < 1e-9 for a, b in zip(got, want))


def test_calendar_query_by_brute_force(spark, sf):
    from meridian.plans.catalogue import QUERIES

    parts = spark.read.parquet(f"{sf}/part.parquet").collect()
    want = {}
    for brand in {p.p_brand for p in parts}:
        own = [p for p in parts if p.p_brand == brand]
        stock = [(p.p_size, str(p.p_partkey), f"t{p.p_partkey % 7}") for p in own]
        for slot, topic in sorted((p.p_partkey, f"t{p.p_size % 5}") for p in own):
            pick = min((x for x in stock if x[2] == topic), default=None) or min(stock, default=None)
            want[slot] = pick[1] if pick else None
            if pick:
                stock.remove(pick)
    assert {r.slot: r.short for r in QUERIES["calendar_fill"](spark, sf).collect()} == want and len(want) == len(parts)


def test_queries_that_look_up_a_seed_on_empty_tables(spark, sf, tmp_path):
    from meridian.plans.catalogue import QUERIES

    for t in ("embeddings", "events", "part", "documents", "labels"):
        df = spark.read.parquet(f"{sf}/{t}.parquet").limit(0)
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    for name in ("kmeans_clusters", "seed_resolution", "coverage_report", "clip_to_window", "knn_topk", "recall_media", "rrf_hybrid"):
        rows = QUERIES[name](spark, str(tmp_path)).collect()
        assert not rows or name == "coverage_report"
