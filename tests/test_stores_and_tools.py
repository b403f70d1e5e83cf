"""Moves, stores, outbox, SQLite tables, hooks and query tools."""

import random
import sqlite3

import pytest
from meridian.functions import hooks
from meridian.operators import search, tools, upsert
from meridian.sources import sqlite, writers
from meridian.streaming import windows
from pyspark.sql import functions as F

FILES = "id int, path string, dst string, size long, hash string"


def moved(spark, rows, there, strategy):
    files, have = spark.createDataFrame(rows, FILES), spark.createDataFrame(there, "path string, size long, hash string")
    return {r.id: (r.action, r.final) for r in upsert.file_moves(files, have, strategy).collect()}


def test_moves_by_strategy(spark):
    rows = [(1, "s/a.txt", "d/a.txt", 5, "h"), (2, "t/a.txt", "d/a.txt", 5, "h"), (3, "s/b", "d/b", 1, None), (4, "d/c", "d/c", 1, "x"), (5, "s/n", "d/n", 1, "x"), (6, "s/e", "d/e", 7, "q")]
    there = [("d/a.txt", 5, "h"), ("d/b", 1, "z"), ("d/c", 1, "x"), ("d/e", 8, "q")]
    assert moved(spark, rows, there, "skip") == {1: ("duplicate", None), 2: ("duplicate", None), 3: ("duplicate", None), 4: ("same", None), 5: ("move", "d/n"), 6: ("exists", None)}
    assert moved(spark, rows, there, "overwrite")[1] == ("overwrite", "d/a.txt")
    assert moved(spark, rows[4:5], there, "fail") == {5: ("move", "d/n")}
    with pytest.raises(Exception, match="destination exists"):
        moved(spark, rows, there, "fail")
    with pytest.raises(ValueError):
        moved(spark, rows, there, "guess")


def test_renamed_names_are_free(spark):
    names = spark.createDataFrame([(1, "a.txt"), (2, "a.txt"), (3, "a_1.txt"), (4, ".bashrc"), (5, ".bashrc"), (6, "x/y.z/f"), (7, "x/y.z/f")], "id int, name string")
    got = {r.id: r.final for r in upsert.free_name(names, spark.createDataFrame([("a.txt",), ("a_2.txt",), ("a_03.txt",)], "name string")).collect()}
    assert got == {1: "a_3.txt", 2: "a_4.txt", 3: "a_1.txt", 4: ".bashrc", 5: ".bashrc_1", 6: "x/y.z/f", 7: "x/y.z/f_1"}
    rng = random.Random(2)
    pool = [f"{s}{n}.{e}" for s in ("a", "b") for n in ("", "_1", "_2", "_3", "_5", "_1_1") for e in ("t", "u")]
    asked, have = [(i, rng.choice(pool)) for i in range(60)], sorted(set(rng.choices(pool, k=8)))
    finals = [r.final for r in upsert.free_name(spark.createDataFrame(asked, "id int, name string"), spark.createDataFrame([(h,) for h in have], "name string")).collect()]
    assert len(set(finals)) == 60 and not set(finals) & set(have)


def test_versions_samples_and_links(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, "c", 2)], "id int, x string, schema_version int")
    got = upsert.normalised(df, 2, lambda rows: rows.withColumn("x", F.upper("x")))
    assert sorted(tuple(r) for r in got.collect()) == [(1, "A", 2), (2, "B", 2), (3, "c", 2)]
    many = spark.range(1000)
    one = {r.id for r in upsert.sample_of(many, 50, 7, ["id"]).collect()}
    assert len(one) == 50 and one == {r.id for r in upsert.sample_of(many.repartition(7), 50, 7, ["id"]).collect()} != {r.id for r in upsert.sample_of(many, 50, 8, ["id"]).collect()}
    left, right = spark.createDataFrame([(1, "p"), (2, "q")], "a int, l string"), spark.createDataFrame([(8, "x"), (9, "y")], "b int, r string")
    links = spark.createDataFrame([(1, 9, 0.9), (2, 8, 0.1), (3, 9, 1.0)], "a int, b int, score double")
    assert [(r.l, r.r) for r in upsert.linked(left, links, right, "a", "b", 0.5).collect()] == [("p", "y")]


@pytest.mark.parametrize("form", ["json", "csv", "parquet"])
def test_keyed_store(spark, tmp_path, form):
    path, kind = str(tmp_path / "store"), "short_id string, platform string, views long, likes long"
    writers.upsert_store(spark, path, spark.createDataFrame([("a", "y", 1, 5), ("b", "y", 2, None)], kind), ["short_id", "platform"], form)
    if form == "json":
        (tmp_path / "store" / "extra.json").write_text('not json\n')
    writers.upsert_store(spark, path, spark.createDataFrame([("a", "y", 10, None), ("a", "z", 3, 3), ("a", "y", 7, None)], kind), ["short_id", "platform"], form)
    rows = {(r.short_id, r.platform): (r.views, r.likes) for r in spark.read.schema(kind).option("mode", "DROPMALFORMED").option("header", "true").format(form).load(path).collect() if r.platform}
    assert rows == {("a", "y"): (10, 5), ("b", "y"): (2, None), ("a", "z"): (3, 3)} and not list(tmp_path.glob("store.*"))


def test_claims_by_rename(spark, tmp_path):
    (tmp_path / "job").write_text("x")
    assert writers.claim_file(spark, str(tmp_path / "job"), "w1") and not writers.claim_file(spark, str(tmp_path / "job"), "w2")
    assert (tmp_path / "job.w1").exists()


def test_index_follows_the_store(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, "b c")], "id int, text string")
    new = spark.createDataFrame([(2, "c c d"), (3, "a"), (4, None)], "id int, text string")
    got = writers.mirrored_index(search.inverted_index(docs), new)
    want = search.inverted_index(spark.createDataFrame([(1, "a b a"), (2, "c c d"), (3, "a")], "id int, text string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in want.select(*got.columns).collect())


def test_outbox(spark, tmp_path):
    box = writers.Outbox(spark, str(tmp_path / "box"))
    assert box.open().count() == 0 and box.replay() == {"seen": 0, "drained": 0, "failed": 0, "kept": 0}
    ops = spark.createDataFrame([("1", "put", "c", '{"k": 1}'), ("2", "put", "c", '{"k": 2}'), ("3", "put", "c", "{broken")], "op_id string, op_type string, correlation_id string, payload string")
    box.append(ops)
    box.around(ops.where("op_id = '1'").withColumn("op_id", F.lit("4")), lambda: None)
    with pytest.raises(OSError):
        box.around(ops.where("op_id = '1'").withColumn("op_id", F.lit("5")), lambda: (_ for _ in ()).throw(OSError("down")))
    assert {r.op_id: (r.tries, r.last_error) for r in box.open().collect()} == {"1": (0, ""), "2": (0, ""), "3": (0, ""), "5": (1, "down")}
    assert box.replay() == {"seen": 4, "drained": 0, "failed": 1, "kept": 3}
    assert box.replay(spark.createDataFrame([("2",), ("3",), ("9",)], "op_id string")) == {"seen": 4, "drained": 1, "failed": 1, "kept": 2}
    for _ in range(2):
        box.replay()
    assert {r.op_id: r.last_error for r in box.open().where("tries > 3").collect()} == {"3": "replay: bad payload"}
    box.replay()
    assert box.open().where("op_id = '3'").first().last_error == "replay: too many tries"


def test_upsert_sink_keeps_the_latest(spark, tmp_path):
    sink = windows.upsert_sink(spark, str(tmp_path / "t"), ["k"], "ts", 4)
    batch = lambda *rows: spark.createDataFrame(rows, "k string, ts int, v string")
    sink(batch(("a", 5, "x"), ("a", 7, "y"), ("b", 1, "z")), 0)
    before = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "t").glob("bucket=*")}
    for n in (1, 1, 2):  # a replayed batch changes nothing
        sink(batch(("a", 6, "late"), ("c", 1, "new")), n)
    sink(batch().limit(0), 3)
    rows = {r.k: (r.ts, r.v) for r in spark.read.parquet(str(tmp_path / "t")).collect()}
    assert rows == {"a": (7, "y"), "b": (1, "z"), "c": (1, "new")}
    after = {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in (tmp_path / "t").glob("bucket=*")}
    touched = {f"bucket={r.b}" for r in batch(("a", 0, ""), ("c", 0, "")).select(F.pmod(F.xxhash64("k"), F.lit(4)).alias("b")).collect()}
    assert all(after[name] == files for name, files in before.items() if name not in touched)


def test_sqlite_tables(spark, tmp_path):
    path = str(tmp_path / "a b.sqlite")
    with sqlite3.connect(path) as db:
        db.execute('CREATE TABLE "segs" (id INTEGER PRIMARY KEY, score REAL, note TEXT, raw BLOB)')
        db.executemany("INSERT INTO segs VALUES (?, ?, ?, ?)", [(i, i / 2, f"n{i}", bytes([i % 256])) for i in range(1, 500)])
        db.execute("INSERT INTO segs VALUES (9000, 'odd', NULL, NULL)")
        db.execute("CREATE TABLE empty (x INT)")
    rows = sqlite.read_sqlite(spark, path, "segs", 4)
    assert rows.count() == 500 and rows.rdd.getNumPartitions() == 4
    assert rows.where("id = 7").first().asDict() == {"id": 7, "score": 3.5, "note": "n7", "raw": bytearray([7])} and rows.where("id = 9000").first().score is None
    assert sqlite.read_sqlite(spark, path, "empty").count() == 0
    with pytest.raises(Exception):
        sqlite.read_sqlite(spark, path, "none").count()


def test_hooks(spark):
    df = spark.createDataFrame([(1, "two words"), (2, None), (3, "see a@b.org")], "id int, text string")
    hooks.EMBEDDERS["lengths"] = lambda: lambda texts: [[float(len(t)), 1.0] for t in texts]
    hooks.EXTRACTORS["capitals"] = lambda: lambda texts: [[("Word", w, 1.0) for w in t.split()] for t in texts]
    assert [r.embedding for r in hooks.embedded(df, "text", model="lengths", batch=2).orderBy("id").collect()] == [[9.0, 1.0], [0.0, 1.0], [11.0, 1.0]]
    assert len(hooks.embedded(df, "text", dims=8).first().embedding) == 8
    assert {(r.id, r.entity) for r in hooks.extracted(df, "id", "text", "capitals").collect()} == {(1, "two"), (1, "words"), (3, "see"), (3, "a@b.org")}
    assert [(r.label, r.entity) for r in hooks.extracted(df, "id", "text").collect()] == [("Email", "a@b.org")]
    with pytest.raises(KeyError):
        hooks.embedded(df, "text", model="none")


def test_query_tools(spark):
    spoken = spark.createDataFrame([(1, "the boat came", 100.0, "Harbour"), (2, "we walk", 5000.0, None), (3, "later boat", 90000.0, None)], "id int, text string, t double, place string").withColumn("ts", F.timestamp_seconds("t"))
    written = spark.createDataFrame([(9, "a note", 200.0)], "id int, text string, t double").withColumn("ts", F.timestamp_seconds("t"))
    concepts = spark.createDataFrame([(1, "ship news", 0.5), (3, "ship", 0.9), (2, "walking", 1.0)], "id int, concept string, score double")
    stays = spark.createDataFrame([(4000.0, "North Hill"), (6000.0, "North Hill"), (9.0, "Harbour")], "t double, place string")
    box = tools.personal_toolbox(spoken, written, concepts, stays)
    ids = lambda name, **kw: [r.id for r in box.call(name, **kw).collect()]
    assert ids("said_about", concept=" ship ") == [3, 1] and ids("said_about", concept="ship", limit=1) == [3]
    assert ids("said_at", place="Harbour") == [1] and ids("said_at", place="North") == [2] and ids("said_at", place="Nowhere") == []
    assert [(r.kind, r.id) for r in box.call("activity_on", day="1970-01-01").collect()] == [("said", 1), ("said", 2), ("wrote", 9)]
    assert ids("search_said", words="boat") == [3, 1] and [r.place for r in box.call("timeline").collect()] == ["North Hill", "Harbour"]
    assert box.call("help").count() == 6
    for bad in ({"concept": " "}, {}, {"place": "x"}):
        with pytest.raises(ValueError):
            box.call("said_about", **bad)
    with pytest.raises(KeyError):
        box.call("none")


def test_models_by_hook(spark):
    df = spark.createDataFrame([(1, "la la la", b"abc"), (2, None, None)], "id int, text string, raw binary")
    hooks.CLASSIFIERS["la"] = lambda: lambda texts, labels: [[t.count("la") / 10, 1 - t.count("la") / 10] for t in texts]
    got = {r.id: r.classes for r in hooks.classified(df, "text", ["song", "speech"], "la").collect()}
    assert got == {1: {"song": 0.3, "speech": 0.7}, 2: {"song": 0.0, "speech": 1.0}}
    hooks.WRITERS["loud"] = lambda: lambda texts: [t.upper() for t in texts]
    assert [r.summary for r in hooks.written(df, "text", "loud").orderBy("id").collect()] == ["LA LA LA", ""]
    long = spark.createDataFrame([("First one.  Second\none. " + "word " * 100,), ("x" * 50,), (None,)], "text string")
    assert [r.summary for r in hooks.written(long, "text", most=30).collect()] == ["First one. Second one.", "x" * 30, ""]
    hooks.SEGMENTERS["bytes"] = lambda: lambda contents: [[(0.0, float(len(c)), "music")] if c else [] for c in contents]
    assert [tuple(r) for r in hooks.segmented(df, "id", "raw", "bytes").collect()] == [(1, 0.0, 3.0, "music")]
    hooks.EMBEDDERS["raw"] = lambda: lambda contents: [[float(len(c))] for c in contents]
    assert [r.embedding for r in hooks.embedded(df, "raw", model="raw").orderBy("id").collect()] == [[3.0], [0.0]]
    items = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "k string, n int")
    cache = spark.createDataFrame([("a", 9.0)], "k string, v double")
    rows, fresh = hooks.cached(items, cache, "k", "v", lambda df: df.withColumn("v", F.col("n").cast("double") * 0))
    assert {(r.n, r.v) for r in rows.collect()} == {(1, 9.0), (2, 0.0), (3, 0.0), (4, 0.0)} and sorted(r.k for r in fresh.collect()) == ["b", "c"]


FEED = b"""<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom"><entry><id>http://x.org/abs/2401.1v1</id><title>A
 title</title><summary> About it </summary><published>2024-01-02T00:00:00Z</published><author><name>Ann</name></author><author><name>Bo</name></author></entry>
<entry><title>no id</title></entry></feed>"""
FOLDERS = {
    "https://h.org/cloud/remote.php/dav/me": ["/remote.php/dav/me/|dir", "/remote.php/dav/me/sub/|dir", "/remote.php/dav/me/a.mp4|5"],
    "https://h.org/cloud/remote.php/dav/me/sub": ["/remote.php/dav/me/sub|dir", "/remote.php/dav/me/sub/b.JPG|7", "/remote.php/dav/me/sub/c.exe|1", "/remote.php/dav/me/sub/locked/|dir"],
}


def fake_server():
    folders, feed = FOLDERS, FEED

    def answer(method, url):
        if method == "PROPFIND":
            if url not in folders:
                return 403, b""
            item = lambda path, what: f"<d:response><d:href>{path}</d:href><d:propstat><d:prop>{'<d:resourcetype><d:collection/></d:resourcetype>' if what == 'dir' else f'<d:getcontentlength>{what}</d:getcontentlength>'}</d:prop></d:propstat></d:response>"
            return 207, f"<d:multistatus xmlns:d='DAV:'>{''.join(item(*x.split('|')) for x in folders[url])}</d:multistatus>".encode()
        if "api/query" in url:
            return (200, feed) if "good" in url else (429, b"") if "busy" in url else (200, b"<broken")
        if url.endswith("b.JPG"):
            raise OSError("gone")
        return 200, url.rsplit("/", 1)[-1].encode()

    return answer  # a function of its own, which goes to the workers by value


def test_feeds(spark):
    from meridian.sources import remote

    rows = remote.arxiv(spark, ["good one", "busy", "bad"], request=fake_server(), wait=0.0).collect()
    assert [(r.arxiv_id, r.title, r.abstract, r.authors, r.published) for r in rows] == [("2401.1v1", "A  title", "About it", ["Ann", "Bo"], "2024-01-02T00:00:00Z")]
    urls = spark.createDataFrame([("u://api/query/busy",), (None,)], "url string")
    assert [(r.status, r.error) for r in remote.fetched(urls, fake_server(), wait=0.0).collect()] == [(429, "too many requests")]
    bomb = spark.createDataFrame([(b"<!DOCTYPE x [<!ENTITY a 'b'>]>" + FEED,)], "body binary")
    assert remote.atom_entries(bomb).count() == 0


def test_webdav(spark):
    from meridian.sources import remote

    files = remote.webdav_files(spark, "https://h.org/cloud/remote.php/dav/me/", fake_server())
    assert {(r.path, r.kind, r["size"]) for r in files.collect()} == {("a.mp4", "media", 5), ("sub/b.JPG", "media", 7), ("sub/c.exe", "other", 1)}
    got = {r.path: (r.content, r.error) for r in remote.webdav_pulled(files, fake_server()).collect()}
    assert got == {"a.mp4": (b"a.mp4", None), "sub/b.JPG": (None, "OSError: gone")}
    have = spark.createDataFrame([("a.mp4", 5), ("sub/b.JPG", 6)], "path string, size long")
    assert [r.path for r in remote.webdav_pulled(files, fake_server(), have).collect()] == ["sub/b.JPG"]


def test_written_queries(spark):
    spark.range(50).createOrReplaceTempView("numbers_of_test")
    fence = "```"
    said = iter(["", f"Here you are:\n{fence}sql\nSELECT id FROM numbers_of_test ORDER BY id; DROP TABLE x\n{fence}"])
    assert [r.id for r in tools.answered(spark, "which?", lambda q: next(said)).collect()] == list(range(20))
    with pytest.raises(PermissionError):
        tools.answered(spark, "which?", lambda q: "DROP TABLE numbers_of_test")
    for question, answer in ((" ", "SELECT 1"), ("which?", "")):
        with pytest.raises(ValueError):
            tools.answered(spark, question, lambda q, a=answer: a)
