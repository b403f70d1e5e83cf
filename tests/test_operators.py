"""Hand-computed cases of operators, expressions, readers, writers and streams. Expected results by definition."""

import math
import time

import pytest
from meridian.functions import exprs as X
from meridian.operators import graph, incremental, intervals, nearest, sequence, upsert, vectors
from meridian.sources import readers, writers
from meridian.streaming import detection, windows
from pyspark.sql import Row
from pyspark.sql import functions as F


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_geometry(spark):
    r = one(spark, X.haversine(0.0, 0.0, 1.0, 0.0), X.box_overlap_area(F.array(*map(F.lit, (0.0, 0.0, 10.0, 10.0))), F.array(*map(F.lit, (5.0, 5.0, 15.0, 15.0)))), X.xywh_to_xyxy(50.0, 50.0, 100.0, 100.0))
    assert abs(r.c0 - 111_195) < 1 and r.c1 == 25 and r.c2 == [0, 0, 100, 100]


def test_repaired_points(spark):
    box = (30, 40, -130, -110)  # Fixed values: results by definition.
    cases = [
        ((35.0, 120.0), None, (35.0, -120.0, ["FIXED_WEST"])),
        ((999.0, 0.0), None, (None, 0.0, [])),
        ((999.0, 120.0), None, (None, 120.0, [])),
        ((35.0, 5.0), None, (35.0, 5.0, [])),
        ((35.0, 171.0), None, (35.0, 171.0, [])),
        ((35.0, 5.0), box, (35.0, 5.0, [])),
        ((35.0, 120.0), box, (35.0, -120.0, ["FIXED_WEST"])),
        ((35.0, 100.0), box, (35.0, 100.0, [])),
        ((-80.0, 35.0), (30, 40, -90, -70), (35.0, -80.0, ["SWAPPED"])),
    ]
    got = one(spark, *[X.repaired_point(F.lit(la), F.lit(lo), box=b) for (la, lo), b, _ in cases])
    assert [(p.lat, p.lon, p.flags) for p in got] == [want for *_, want in cases]


def test_vectors_and_intervals(spark):
    v = F.array(F.lit(1.0), F.lit(2.0))
    z = F.array(F.lit(0.0), F.lit(0.0))
    r = one(spark, X.cosine(v, v), X.cosine(v, F.transform(v, lambda x: -x)), X.cosine(v, z), X.unit(z), X.overlap(0.0, 10.0, 5.0, 20.0), X.overlap(0.0, 5.0, 10.0, 20.0))
    assert (round(r.c0, 9), round(r.c1, 9), r.c2, r.c3, r.c4, r.c5) == (1, -1, 0, [0, 0], 5, 0)


def test_keys_and_times(spark):
    r = one(spark, X.file_key(F.lit("a/2025_0202_171732_medium_transcription_speakers.json")), X.clip_base_key(F.lit("k_FR")), X.any_time(F.lit("1700000000")), X.any_time(F.lit("1700000000000")), X.any_time(F.lit("garbage")), X.any_time(F.lit(None).cast("string")), X.key_time(F.lit("2025_0202_171732")), X.loose_date(F.lit("03/04/2024")))
    assert r.c0 == "2025_0202_171732" and r.c1 == "k" and r.c2 == r.c3 and r.c4 is None and r.c5 is None
    assert str(r.c6) == "2025-02-02 17:17:32" and str(r.c7) == "2024-03-04"


def test_srt_times_beyond_99_hours(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from meridian.plans.registry import ORACLES
    from meridian.plans.text_queries import srt_times

    assert tuple(one(spark, X.srt_time(F.lit(2261999.623)), X.srt_time(F.lit(360000.0)), X.srt_time(F.lit(359999.999)))) == ("628:19:59,623", "100:00:00,000", "99:59:59,999")
    path = str(tmp_path / "events.parquet")
    duckdb.sql(f"COPY (SELECT unnest([0, 1, 954906, 954907, 954908, 5999999]) AS event_id) TO '{path}'")
    want = duckdb.sql(ORACLES["srt_times"].replace("FROM events", f"FROM '{path}'")).fetchall()
    assert sorted(tuple(r) for r in srt_times(spark, str(tmp_path)).collect()) == sorted(want)


def test_topic_tags_as_in_sql(spark, tmp_path):
    duckdb = pytest.importorskip("duckdb")
    from meridian.plans.registry import ORACLES
    from meridian.plans.text_queries import topic_tags

    texts = ["itre\u00ea des\u00e8mentanc", "\u00ebthe", "the\u0308", "wander der\u00fc", "the_ 1the \u0663", "\u0301des", "A licen\u017fe LICENCE", "the\u00a0der", "the", "", None]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(path)
    want = duckdb.sql(ORACLES["topic_tags"].replace("FROM documents", f"FROM '{path}/*.parquet'")).fetchall()
    assert sorted(tuple(r) for r in topic_tags(spark, str(tmp_path)).collect()) == sorted(want)


def test_numbers_and_text(spark):
    r = one(spark, X.number(F.lit("1,200")), X.number(F.lit("40%")), X.fraction(F.lit("95.0%")), X.number(F.lit("x")), X.without_think(F.lit("<think>a\nb</think> yes")), X.first_json_object(F.lit('note {"a": {"b": 1}} end')), X.subtitle_text(F.lit("WEBVTT\n\n1\n00:00 --> 00:01\n<b>Hello</b>\nworld")), X.srt_time(F.lit(3661.5)))
    assert tuple(r) == (1200.0, 40.0, 0.95, None, "yes", '{"a": {"b": 1}}', "Hello world", "01:01:01,500")
    m = one(spark, X.mentions(F.lit("I went to my car")), X.mentions(F.lit("Let's meet on 2026-06-14 at 3:30pm")), X.mentions(F.lit("The weather was nice.")))
    assert m.c0.is_self and m.c1.dates == ["2026-06-14"] and m.c1.times == ["3:30pm"] and not m.c2.is_self and not m.c2.dates


def test_stamps_in_names(spark):
    keys = ["20250202171732_x", "a/20250202_171732.mp4", "2025-02-02_17-17-32", "2025_02_02_17_17_32_F", "/v/2025/02/02/cam_171732.mp4", "/v/2025/02/02/cam_1717320.mp4", "2025-02-02", "20259999999999 2025_0202_171732", ""]
    got = one(spark, *[X.key_time(F.lit(k)) for k in keys])
    assert [str(t) if t else None for t in got] == ["2025-02-02 17:17:32"] * 5 + [None, None, "2025-02-02 17:17:32", None]


def test_json_in_text(spark):
    cases = {
        '{"a":{"b":{"c":{"d":1}}}}': '{"a":{"b":{"c":{"d":1}}}}',
        '```json\n{"a": "}{"} {"b": 1}\n```': '{"a": "}{"}',
        'x } {"a": "\\"}"} y': '{"a": "\\"}"}',
        'a "quoted { brace" {"n": 1}': '{"n": 1}',
        '{"open": 1': None,
        '"never closed { }': None,
        "": None,
        "{" * 500 + "}" * 500: "{" * 500 + "}" * 500,
        '{"t": "' + "long " * 20000 + '"}': '{"t": "' + "long " * 20000 + '"}',
    }
    assert list(one(spark, *[X.first_json_object(F.lit(k)) for k in cases])) == list(cases.values())
    p = one(spark, X.payload(F.lit('{"tasks": [{"title": "' + "x" * 200 + '", "priority": "Urgent", "labels": [" a ", "a", ""], "agent": {"confidence": "7"}, "plan": [{"action": "go"}]}, {}]}')), X.payload(F.lit("no object")), X.payload(F.lit(None).cast("string")))
    t = p.c0.tasks[0]
    assert len(p.c0.tasks) == 1 and len(t.title) == 140 and (t.priority, t.labels, t.agent.confidence, t.plan[0].step, t.plan[0].tool) == ("urgent", ["a"], 1.0, 1, "")
    assert p.c0.version == "1.0" and p.c1 == p.c2 and p.c1.tasks == [] and p.c1.summary == ""


def test_python_literals_as_json(spark):
    import json

    cases = [{"a": "it's"}, {"a": 'say "no"'}, {"a": "both ' and \""}, {"True": [True, None, False], "n": -1.5}, {"a": "line\nend\\", "x": "\x00é🙂"}, {"a": "None of 'them'"}]
    got = one(spark, *[X.python_repr_to_json(F.lit(repr(c))) for c in cases])
    assert [json.loads(t) for t in got] == cases


def test_lyric_rules_by_definition(spark):
    import re
    from collections import Counter

    def brute(text):
        t = text.lower().strip()
        if not t:
            return (0.0,) * 6
        lines, words = [x.strip() for x in re.split(r"[\r\n]+", t) if x.strip()], re.findall("[a-z']+", t)
        pairs, ends = Counter(zip(words, words[1:])), Counter(x[-3:] for x in lines if len(x) >= 3)
        rep = min(1.0, 3 * sum(v for v in pairs.values() if v > 1) / max(1, len(words) - 1))
        rhyme = max(ends.values(), default=0) / max(1, len(lines))
        stop = max(0.0, 0.4 - sum(w in X.STOP_WORDS for w in words) / max(1, len(words))) / 0.4
        lala, breaks = float(bool(re.search(X.REFRAIN, t))), min(1.0, (len(lines) - 1) / max(1, len(t) / 80))
        return rep, rhyme, stop, lala, breaks, min(1.0, 0.25 * rep + 0.25 * rhyme + 0.2 * lala + 0.15 * breaks + 0.15 * stop)

    texts = ["", "  \n ", "La la la\nla la la\nyeah yeah", "The cat sat on the mat and the dog", "mañana\r\nlà-bas", "one two one two one two", "ab\ncd\nef", "oooh " * 40 + "\nend"]
    got = one(spark, *[X.lyric_features(F.lit(t)) for t in texts])
    for r, t in zip(got, texts):
        assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(r, brute(t))), (t, r, brute(t))


def test_mentions_by_definition(spark):
    # Results by definition.
    m = one(spark, X.mentions(F.lit("June 14, 2026 at 10:15:30 pm")), X.mentions(F.lit("Sept. 3 and sep 3, at 7:05")), X.mentions(F.lit("Mine is ours; myself too")), X.mentions(F.lit("in 12026-06-14")), X.mentions(F.lit(None).cast("string")))
    assert (m.c0.dates, m.c0.times) == (["June 14, 2026"], ["10:15:30 pm"]) and m.c1.dates == ["Sept. 3", "sep 3"] and m.c1.times == ["7:05"]
    assert m.c2.is_self and not m.c3.dates and not m.c4.is_self and m.c4.times == []


def test_sessions_differ(spark):
    df = spark.createDataFrame([("a", 1, 0.0, 100.0), ("a", 2, 10.0, 20.0), ("a", 3, 90.0, 95.0)], "k string, id int, start double, stop double")
    gap = {r.id: r.session for r in intervals.gap_sessions(df, ["k"], "start", "stop", 30).collect()}
    merged = {r.id: r.session for r in intervals.merged_sessions(df, ["k"], "start", "stop", 30).collect()}
    assert gap == {1: 0, 2: 0, 3: 1} and merged == {1: 0, 2: 0, 3: 0}
    line = spark.createDataFrame([("a", t, float(t)) for t in (0, 50, 100, 150)], "k string, id int, t double")
    assert {r.id: r.session for r in sequence.anchored_sessions(line, ["k"], "t", 100.0).collect()} == {0: 0, 50: 0, 100: 0, 150: 1}


def test_apportion(spark):
    pairs = spark.createDataFrame([(1, "A", 0.0, 10.0, 0.0, 4.0), (1, "B", 0.0, 10.0, 3.0, 10.0), (1, "C", 0.0, 10.0, 9.9, 10.0)], "seg int, label string, a0 double, a1 double, b0 double, b1 double")
    got = {r.label: r for r in intervals.apportion(pairs, ["seg"], "label", ("a0", "a1"), ("b0", "b1")).collect()}
    assert set(got) == {"A", "B"} and got["B"].dominant and math.isclose(got["A"].share, 4 / 11.1)


def test_fill_and_interpolate(spark):
    df = spark.createDataFrame([("a", i, v) for i, v in enumerate(["35.0000", "35.1", "0.0000"])], "k string, n int, lat string")
    got = [r.lat for r in sequence.forward_fill(df, ["k"], ["n"], ["lat"], lambda c: ~c.endswith(".0000")).orderBy("n").collect()]
    assert got == ["35.0000", "35.1", "35.1"]
    for values, want in (([10, None, None, 40], [10, 20, 30, 40]), ([None, 10, None], [10, 10, 10]), ([None, None], [0, 0]), ([10, None, 15], [10, 12, 15])):
        rows = spark.createDataFrame([("a", i, None if v is None else float(v)) for i, v in enumerate(values)], "k string, n int, v double")
        assert [r.filled for r in sequence.interpolate(rows, ["k"], ["n"], "v").orderBy("n").collect()] == want


def test_nearest_time_ties_and_edges(spark):
    left = spark.createDataFrame([(1, 10.0), (2, 100.0)], "id int, t double")
    right = spark.createDataFrame([(2, 8.0), (1, 12.0), (9, 105.0)], "rid int, t double")
    got = {r.id: (r.match_id, r.delta) for r in nearest.nearest_time(left, right, "id", "rid", "t", "t", 5.0).collect()}
    assert got == {1: (1, 2.0), 2: (9, 5.0)}
    c = one(spark, *[nearest.confidence(F.lit(float(x))) for x in (3600, 3601, 7200, 14400, 14401)])
    assert tuple(c) == (1.0, 0.8, 0.8, 0.6, 0.4)


def test_near_places_across_the_date_line(spark):
    p = spark.createDataFrame([(1, 10.0, 179.9995), (2, 60.0, 5.0), (3, -70.0, 0.0)], "pid int, lat double, lon double")
    q = spark.createDataFrame([(1, 10.0, -179.9995), (2, 60.001, 5.001), (3, -70.0, 0.01), (4, 61.0, 5.0)], "qid int, lat double, lon double")
    got = {(r.pid, r.qid) for r in nearest.near_places(p, q, "pid", "qid", 500.0).collect()}
    assert got == {(1, 1), (2, 2), (3, 3)}


def test_frames_tiers(spark):
    a = spark.createDataFrame([(1, "k", 100), (2, "k", 500)], "id int, key string, frame int")
    b = spark.createDataFrame([("k", 125), ("k", 90)], "key string, frame int")
    got = {r.id: (r.match_frame, r.tier) for r in nearest.nearest_frame(a, b, "id", "key", "frame", 10).collect()}
    assert got == {1: (90, 0), 2: (None, None)}


def test_components_and_clusters(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (7, 7), (200, 200)], "src long, dst long")
    got = {r.id: r.component for r in graph.connected_components(edges).collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 101: 100, 200: 200}
    members = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "d")], "label int, id string")
    pairs = spark.createDataFrame([("a", "b", 0.9), ("b", "c", 0.8)], "a string, b string, score double")
    done = {r["size"]: r for r in vectors.finished_clusters(members, pairs).collect()}
    assert done[3].confidence == 0.0 and done[3].status == "tentative" and done[1].status == "tentative"


def test_ranking(spark):
    from meridian.operators import search

    a = spark.createDataFrame([("x", 2.0), ("y", 1.0)], "id string, score double")
    b = spark.createDataFrame([("y", 2.0), ("z", 1.0)], "id string, score double")
    got = {r.id: r.score for r in search.fused({"a": a, "b": b}, 5).collect()}
    assert math.isclose(got["y"], 1 / 61 + 1 / 60) and math.isclose(got["x"], 1 / 60) and math.isclose(got["z"], 1 / 61)
    mine = spark.createDataFrame([(1, "a", 1), (1, "c", 2)], "q int, i string, r int")
    ref = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "q int, i string, r int")
    assert abs(vectors.retrieval_agreement(mine, ref, "q", "i", "r", 2).first().ndcg_agreement - 0.613147) < 1e-6


def test_upserts(spark):
    base = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 0)], "k int, v string, n int")
    delta = spark.createDataFrame([(2, None, 5), (3, "c", 7), (None, "m", 1)], "k int, v string, n int")
    got = {r.k: (r.v, r.n) for r in upsert.upsert(base, delta, ["k"], {"n": upsert.add}).collect()}
    assert got == {1: ("a", 1), 2: ("b", 7), 3: ("c", 7), None: ("m", 1)}
    files = spark.createDataFrame([("new", 5, 30.0), ("mid", 4, 20.0), ("old", 3, 10.0)], "path string, size long, mtime double")
    assert {r.path for r in upsert.retained(files, 9, 100.0, 40.0).collect()} == {"new", "mid"}


def test_leases(spark):
    jobs = spark.createDataFrame([("a", "", 0, "pending"), ("b", "x", 1000, "running"), ("c", "x", 90000, "running"), ("d", None, None, "pending")], "key string, owner string, claimed_at long, status string")
    got = {r.key: r.owner for r in incremental.claimed(jobs, jobs, "me", 100_000, 50_000).collect()}
    assert got == {"a": "me", "b": "me", "c": "x", "d": "me"}
    assert {r.key for r in incremental.live_claims(jobs, 100_000, 50_000).collect()} == {"c"}
    assert [r.owner for r in incremental.released(jobs, "c", "y").where("key = 'c'").collect()] == ["x"]
    stages = spark.createDataFrame([Row(key="a", status="running", stages={"one": True})])
    done = incremental.stage_done(stages, "a", "two", "two").first()
    assert done.status == "done" and done.stages == {"one": True, "two": True}


def test_detections_and_turns(spark, tmp_path):
    lines = spark.createDataFrame([("Key,vehicle_id,confidence,classification,xywh,xyxy,Frame",), ("k,id1,95.0%,car,[10 20 30 40],[10, 20, 40, 60],1",), ("k,id2,bus,0.5,[1 2 3 4],[1, 2, 3, 4],2",)], "value string")
    got = {r.vehicle_id: r for r in readers.parse_detections(lines).collect()}
    assert (got["id1"].name, got["id1"].confidence, got["id1"].xyxy) == ("car", 0.95, [10, 20, 40, 60])
    assert (got["id2"].name, got["id2"].confidence) == ("bus", 0.5)
    path = tmp_path / "2025_0202_171732_x.rttm"
    path.write_text("# note\nSPEAKER f 1 0.0 2.5 <NA> <NA> spk1 <NA> <NA>\nSPEAKER f 1 3.0 1.0 <NA> <NA> UNKNOWN <NA> <NA>\nSPEAKER f 1 4.0 0.0 <NA> <NA> spk1 <NA> <NA>\n")
    turns = [(r.start, r.end, r.speaker) for r in readers.read_rttm(spark, str(path)).orderBy("start").collect()]
    assert turns == [(0.0, 2.5, "spk1"), (3.0, 4.0, "UNKNOWN")]
    assert readers.Rules().adapter("x/yolo_detect.csv")[0] == "detections" and readers.Rules([("mine", r"\.csv$", None)]).adapter("a.csv")[0] == "mine"


def test_sources(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"segments": [{"start": 0, "end": 1, "text": "hi"}], "created_at": "1700000000"}')
    (tmp_path / "b.csv").write_text("start_time,stop,sentence,label\n0,1.5,hello,s1\n")
    (tmp_path / "c.md").write_text("intro\n# Title here\nbody")
    (tmp_path / "e.jsonl").write_text('{"a": 1}\nnot json\n{"a": 2}\n')
    t = readers.read_transcript_json(spark, str(tmp_path / "a.json")).first()
    assert t.text == "hi" and t.started_at is not None
    c = readers.read_segments_csv(spark, str(tmp_path / "b.csv")).first()
    assert (c.start, c.end, c.text, c.speaker) == (0.0, 1.5, "hello", "s1")
    assert readers.read_markdown(spark, str(tmp_path)).first().title == "Title here"
    kinds = {r.kind for r in readers.scan_files(spark, [str(tmp_path)]).collect()}
    assert {"json", "csv", "text"} <= kinds
    assert readers.read_rows(spark, str(tmp_path / "e.jsonl"), "jsonl").where("a is not null").count() == 2


def test_stage_tables(spark, tmp_path):
    root = str(tmp_path / "stages")
    rows = spark.createDataFrame([(1, "x")], "id int, v string")
    for _ in range(2):
        writers.write_stage(rows, root, "a/b__c", "segments")
        writers.write_stage(rows, root, "other", "segments")
    assert writers.read_stage(spark, root, "segments", "a/b__c").count() == 1 and writers.read_stage(spark, root, "segments").count() == 2


FRAMES = [("c", 0.0, 1), ("c", 0.02, 1), ("c", 0.5, 0), ("c", 1.2, 0), ("c", 1.5, 1), ("c", 1.6, 1), ("c", 3.0, 1), ("c", 3.1, 1)]


def test_detection_machine(spark):
    df = spark.createDataFrame(FRAMES, "camera_id string, ts double, n_detections int")
    got = [(r.start, r.last_seen) for r in detection.events(df).orderBy("start").collect()]
    assert got == [(0.02, 0.02), (3.0, 3.1)]  # positive frames count on through the cooldown
    assert detection.events(df, flush=False).count() == 1
    assert detection.events(df.limit(0)).count() == 0


def test_detection_machine_on_random_frames(spark):
    import random

    class Machine:
        """By definition: pending positives, an open event, the last close."""

        def __init__(self, rules):
            self.rules, self.pending, self.open, self.closed, self.out = rules, 0, None, None, []

        def frame(self, t, hit):
            self.pending = self.pending + 1 if hit else 0
            if self.open is None and hit and self.pending >= self.rules.persistence and not (self.closed is not None and t - self.closed < self.rules.cooldown):
                self.open = [t, t, 0]
            if self.open is not None and hit:
                self.open[1:] = t, self.open[2] + 1
            elif self.open is not None and t - self.open[1] > self.rules.merge:
                self.out.append(tuple(self.open))
                self.open, self.closed = None, t

    rng, rows, want = random.Random(3), [], []
    rules = detection.Rules(2, 1.5, 2.0)
    for camera in ("a", "b", "c"):
        t, machine = 0.0, Machine(rules)
        for _ in range(400):
            t = round(t + rng.choice([0.1, 0.5, 1.0, 3.0]), 3)
            n = int(rng.random() < 0.5)
            rows.append((camera, t, n))
            machine.frame(t, n > 0)
        want += [(camera, *e) for e in machine.out + ([tuple(machine.open)] if machine.open else [])]
    df = spark.createDataFrame(rows, "camera_id string, ts double, n_detections int").repartition(5)
    assert sorted(tuple(r) for r in detection.events(df, rules).collect()) == sorted(want) and len(want) > 30


def test_detection_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    spark.createDataFrame(FRAMES, "camera_id string, ts double, n_detections int").coalesce(1).write.mode("append").json(str(src))
    frames = windows.read_messages(spark, str(src), "camera_id string, ts double, n_detections int")
    query = detection.stream_events(frames, timeout_ms=100).writeStream.format("memory").queryName("found").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    rows, began = set(), time.time()
    while not rows and time.time() - began < 60 and query.isActive:  # timers keep such a query running
        time.sleep(0.5)
        rows = {(r.start, r.last_seen) for r in spark.table("found").collect()}
    query.stop()
    assert (0.02, 0.02) in rows


def test_windows_and_upsert_sink(spark, tmp_path):
    src = tmp_path / "in"
    for n, rows in enumerate(([("a", "2024-01-01T00:00:00", 1.0), ("a", "2024-01-01T00:00:00", 1.0)], [("a", "2024-01-01T00:30:00", 2.0), ("b", "2024-01-01T02:00:00", 3.0)])):
        spark.createDataFrame(rows, "k string, ts string, value double").coalesce(1).write.mode("append").json(str(src))
    stream = windows.read_messages(spark, str(src), "k string, ts timestamp, value double")
    sink = windows.upsert_sink(spark, str(tmp_path / "t"), ["k", "ts"], "ts")
    windows.run_available(stream, sink, str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    batch = spark.read.json(str(src), schema="k string, ts timestamp, value double")
    hours = {(r.k, r.n) for r in windows.tumbling(batch, "ts", "1 hour", "1 hour", ["k"]).collect()}
    assert hours == {("a", 3), ("b", 1)}
    out = windows.deduplicated(stream, ["k", "ts"], "ts", "1 hour").writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    out.awaitTermination()
    assert spark.table("once").count() == 3


@pytest.mark.parametrize("where", ["readme"])
def test_empty_inputs(spark, where):
    none = spark.createDataFrame([], "id long, t double, k string, start double, stop double")
    assert nearest.nearest_time(none, none.withColumnRenamed("id", "rid"), "id", "rid", "t", "t", 5.0).count() == 0
    assert intervals.gap_sessions(none, ["k"], "start", "stop", 1).count() == 0
    assert graph.connected_components(none.select(F.col("id").alias("src"), F.col("id").alias("dst"))).count() == 0
