"""Sets, lookups, points, inventories, scalars, sources, sinks and streams."""

import hashlib
import heapq
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from annolith.functions import pyfuncs, scalar
from annolith.operators import inventory, lookup, points, provider, rates, sets
from annolith.sources import outbox, readers, sinks
from annolith.streaming import control, follow


def test_rounding(spark):
    row = spark.createDataFrame([(0.5, 1.5, 2.5, 0.125, 0.005, -0.5, float("nan"), 1.2)], "a double,b double,c double,d double,e double,f double,g double,h double").select(*[scalar.half_even(c).alias(c) for c in "abcf"], *[scalar.two_decimal(c).alias(c) for c in "degh"]).first()
    assert (row.a, row.b, row.c, row.f) == (0.0, 2.0, 2.0, 0.0) and (row.d, row.e, row.g, row.h) == (0.13, 0.01, None, None)
    assert pyfuncs.three_digits(0.12345) == 0.123 and pyfuncs.three_digits(2.0) is None


def test_text(spark):
    row = spark.range(1).select(
        scalar.collapse(F.lit(" a \t b ")).alias("a"), scalar.skill_words(F.lit("PickUp_the-Ball")).alias("b"), scalar.skill_words(F.lit(None).cast("string")).alias("c"), scalar.progress_sentence(F.lit("Half done. Task not yet complete.")).alias("d"),
        scalar.event_name(F.lit(" pick "), F.lit("")).alias("e"), scalar.prompt_task_name(F.lit("x\nGlobal task context:\nuser: hi assistant: <think>n</think> stack cups")).alias("f"), scalar.response_text(F.lit('{"choices":[{"message":{"content":[{"text":"a"},{"text":"b"}]}}]}')).alias("g"),
        scalar.rate_kind(F.lit("TPM limit")).alias("h"), scalar.fatal_response(F.lit(500), F.lit("Billing")).alias("i"), scalar.media_rejection(F.lit(400), F.lit('{"error":{"code":"data_inspection_failed","message":"Input image bad"}}')).alias("j"), scalar.redact_urls(F.lit("see https://a/b?c 'x'")).alias("k"),
        scalar.shard_location(F.lit("train-000070.tar")).alias("l"), scalar.data_uri_size(F.lit("a/b"), F.lit(4)).alias("m"),
    ).first()
    assert row.a == "a b" and row.b == "pick up the ball" and row.c == "None" and row.d == "Half done; Task not yet complete." and row.e == "pick" and row.f == "stack cups" and row.g == "ab"
    assert row.h == "tpm" and row.i and row.j and row.k == "see [MEDIA_URL_REDACTED] 'x'" and row.l == "shards/06/train-000070.tar" and row.m == len("data:a/b;base64,") + 8


@pytest.mark.parametrize(
    "text,want",
    [
        ("Done. task NOT yet complete.", "Done. Task not yet complete."), ("The task is not complete because x.", "The task is not complete because x; Task not yet complete."), ("A. The task is not complete", "A. Task not yet complete."), ("All required tasks are complete!", "All required tasks are complete; Task complete."),
        ("If the task is complete", "If the task is complete"), ("The subtask is complete", "The subtask is complete"), ("The 'task' is complete", "The 'task' is complete"), ("Is the task is complete?", "Is the task is complete?"), ("", ""),
    ],
)
def test_completion(spark, text, want):
    assert spark.range(1).select(scalar.completion_suffix(F.lit(text))).first()[0] == want


def test_canonical_json():
    text = '{"b": 1, "a": [1, null, "é"]}'
    assert pyfuncs.canonical_text(text, "spaced") == '{"a": [1, null, "é"], "b": 1}' and pyfuncs.canonical_text(text, "compact") == '{"b":1,"a":[1,null,"é"]}'
    assert pyfuncs.canonical_text(text, "sorted-compact") == '{"a":[1,null,"é"],"b":1}' and "\\u00e9" in pyfuncs.canonical_text(text, "ascii")
    assert pyfuncs.first_object('x ```json {"k": 1} trailing {') == '{"k":1}' and pyfuncs.first_object("none") is None and pyfuncs.first_object("{bad") is None


def test_partition_properties(spark):
    u = spark.createDataFrame([(f"u{k}", k, k % 7 + 1) for k in range(200)], "uid string,pos int,size int")
    assert sets.cover_errors(sets.slotted(u, 5), u).count() == 0
    assert {r.error for r in sets.cover_errors(u.where("pos < 9").unionByName(u.where("pos = 3")), u.where("pos > 0")).collect()} == {"missing", "overlap", "not_in_source"}
    split = sets.longest_first_split(u, ["a", "b", "c"]).collect()
    loads, order = {"a": 0, "b": 0, "c": 0}, sorted(((r.size, r.uid) for r in u.collect()), key=lambda x: (-x[0], x[1]))
    want = {}
    for size, uid in order:
        owner = min(loads, key=lambda o: (loads[o], o))
        loads[owner] += size
        want[uid] = owner
    assert {r.uid: r.owner for r in split} == want
    assert sorted(r.pos for r in sets.even_pick(u.where("pos < 10"), 4, order="pos").collect()) == [k * 10 // 4 for k in range(4)]
    assert sets.even_pick(u, 0, order="pos").count() == 0 and sets.even_pick(u.where("pos < 3"), 9, order="pos").count() == 3
    assert sets.top_donor(spark.createDataFrame([(1, 5), (2, 5), (3, 4)], "slot int, remaining int")).first().slot == 2


def test_batches_count_before_filters(spark):
    u = spark.createDataFrame([(k, f"s{k % 3}") for k in range(20)], "pos int, source_key string")
    got = {r.pos: (r.batch, r.batch_source_key) for r in readers.batches(u, 7, order=("pos",)).where("pos % 2 = 0").collect()}
    assert got[8] == ("manifest-000001", "s1") and got[14] == ("manifest-000002", "s2") and len(got) == 10
    first, again = sets.conflict_checked_union(u.where("pos < 3"), u.withColumn("source_key", F.lit("s0")), key="pos", value="source_key")
    assert first.where("pos = 1").first().source_key == "s1" and sorted(r.pos for r in again.collect()) == [1, 2]


def test_numbering_in_ranges(spark):
    """Ranges cut at sampled keys give the same places as one sort would, ties and nulls included."""
    df = spark.createDataFrame([(f"f{k % 7}" if k % 50 else None, k // 3) for k in range(1000)], "file string, line int")
    got = sets.numbered(df, ["file", "line"], per_range=100).orderBy("row_index").collect()
    want = df.orderBy("file", "line").collect()
    assert [r.row_index for r in got] == list(range(1000)) and [(r.file, r.line) for r in got] == [(r.file, r.line) for r in want]
    assert sets.numbered(df.where("false"), ["line"]).count() == 0


def test_aliases(spark):
    rows = spark.createDataFrame([("u1", "s1", "/d/a.mp4", "r1"), ("u2", "s2", "/d/b.txt", "r2"), ("u3", None, "/e/a.mp4", "r3")], "uid string,source_uid string,path string,res string")
    index = lookup.aliases(rows)
    assert {r.alias for r in lookup.alias_conflicts(index, "res").collect()} == {"a.mp4", "a"}
    probe = lookup.aliases(spark.createDataFrame([("x", "s2", "/d/a.mp4"), ("y", None, "/z/q.mp4")], "uid string,source_uid string,path string"))
    assert {r.uid: (r.res, r.priority) for r in lookup.multi_key_lookup(probe, index, "res").collect()} == {"x": ("r2", 1), "y": (None, None)}


def test_points(spark):
    pairs = spark.createDataFrame([("u", "e", 0, [1.0, 2.0], [3.0, 4.0]), ("u", "e", 1, [1.0, 2.0], None), ("u", "e", 2, [1.0, 1001.0], [0.0, 0.0])], "uid string,event_id string,pair_index int,h_xy array<double>,o_xy array<double>")
    decisions = spark.createDataFrame([("u", "e", f"{p}{k}", not (p == "O" and k == 0)) for p in "HO" for k in range(3)], "uid string,event_id string,point_id string,accepted boolean")
    rows = points.point_rows(pairs).collect()
    assert {r.point_id: r.error for r in rows} == {"H0": None, "O0": None, "H1": None, "H2": "invalid_point", "O2": None}
    gate = points.contact_gate(pairs, decisions)
    got = {r.pair_index: r.reasons for r in gate.collect()}
    assert got == {0: ["O_contact_review_failed"], 1: ["O_missing_or_rejected_at_contact"], 2: []}
    again = points.contact_gate(gate.drop("reasons"), decisions)
    assert {r.pair_index: r.reasons for r in again.collect()} == got
    assert [r.pair_index for r in points.reviewed_pairs(pairs, decisions).collect()] == [2]
    labels = spark.createDataFrame([("u", "e", "H2", "left")], "uid string,event_id string,point_id string,hand_side string")
    assert {r.pair_index for r in points.contact_gate(pairs, decisions, labels, require_side=True).where("size(reasons) = 0").collect()} == {2}
    seen = spark.createDataFrame([("u", "e", 5, 2, "hand"), ("u", "e", 5, 2, "object"), ("u", "e", 5, 1, "hand")], "uid string,event_id string,query_frame int,pair_index int,role string")
    tracks = spark.createDataFrame([("u", "e", 5, 2, True, True), ("u", "e", 5, 1, True, None)], "uid string,event_id string,query_frame int,pair_index int,hand_visible boolean,object_visible boolean")
    checks = spark.createDataFrame([("u", "e", 5, 2, True, None, False, None)], "uid string,event_id string,query_frame int,pair_index int,hand_ok boolean,object_ok boolean,distance_ok boolean,more_reasons array<string>")
    drops = {r.pair_index: r.reasons for r in points.observation_gate(seen, gate, tracks, checks).collect()}
    assert drops == {2: ["pair_distance_review_failed"], 1: ["contact_pair_rejected", "H_or_O_missing_or_rejected_at_observation", "O_tracker_invisible_or_missing"]}


def test_inventory(spark):
    cup = ("red cup", None, "red", [0.0, 0.0, 10.5, 11.5], True)
    rows = [("u", 0, 0, *cup), ("u", 0, 1, "left hand", None, "x", [9.0, 0.0, 1.0, 1.0], True), ("u", 0, 2, "handle", "grip", "x", [1.0, 1.0, 2.0, 2.0], True), ("u", 0, 3, "plate", None, None, None, False), *[("u", 1, k, *cup) for k in range(5)], ("u", 2, 0, "box", None, None, [3.0, 3.0, 2.0, 9.0], True)]
    got = inventory.validated(spark.createDataFrame(rows, "uid string,frame int,pos int,name string,alternate_name string,color string,bbox array<double>,clearly_visible boolean"))
    by = {(r.frame, r.pos): (r.status, r.reason, r.box, r.center) for r in got.collect()}
    assert by[0, 0] == ("kept", None, [0, 0, 10, 12], [5, 6]) and by[0, 1][:2] == ("filtered", "forbidden_non_object_or_scene_entity") and by[0, 2][0] == "kept" and by[0, 3][1] == "not_clearly_visible"
    assert by[1, 0][1] == "too_many_objects" and by[2, 0][1] == "bbox_invalid"
    said = spark.createDataFrame([("u", 0, "the red cup (big)"), ("u", 0, "GRIP"), ("u", 0, "spoon"), ("u", 0, "N/A")], "uid string,frame int,reported string")
    assert {r.reported: (r.chosen, r.error) for r in inventory.first_object(said, got.where("status = 'kept'")).collect()} == {"the red cup (big)": ("red cup", None), "GRIP": ("handle", None), "spoon": (None, "not_in_inventory"), "N/A": (None, None)}


def test_rates(spark):
    df = spark.createDataFrame([("t", 0.0, 1, 0), ("t", 30.0, 1, 10), ("t", 90.0, 1, 40), ("t", 120.0, 2, 2), ("t", 2000.0, 2, 1), ("t", 2060.0, 2, 11)], "task string,t double,pid int,units int")
    got = {r.t: r.rate_per_minute for r in rates.trailing_rate(df).collect()}
    assert got[30.0] is None and abs(got[90.0] - 80 / 3) < 1e-9 and got[120.0] is None and got[2000.0] is None and got[2060.0] == 10.0


def test_manifest(spark, tmp_path):
    lines = [{"uid": " a ", "video_path": "v/a.mp4", "task_name": "n", "clip": {"duration_sec": 3.5}}, {"record_uid": "b", "video_path": "/abs/b.mp4", "source_key": "k", "actor": " "}, {"uid": "a", "video_path": "c.mp4"}, {"video_path": "d.mp4"}]
    (tmp_path / "m.jsonl").write_text("\n".join([*map(json.dumps, lines), "", "{bad"]))
    rows = {r.line: r for r in readers.manifest(spark, str(tmp_path / "m.jsonl")).collect()}
    assert rows[1].uid == "a" and rows[1].path.endswith("/v/a.mp4") and rows[1].duration == 3.5 and rows[1].source_key == "video_manifest" and rows[1].error is None
    assert rows[2].path == "/abs/b.mp4" and rows[2].actor is None and [rows[k].error for k in (3, 4, 6)] == ["duplicate_uid", "uid_missing", "invalid_json"]
    assert [r.uid for r in readers.manifest(spark, str(tmp_path / "m.jsonl"), sources=["k"]).where("error IS NULL").collect()] == ["b"]


def test_catalog_and_tar(spark, tmp_path):
    root = tmp_path / "d"
    spark.createDataFrame([("k1", "r1", "s", "n", None, '{"head_left":"k1.mp4","zz":"q"}', "train-000001.tar", 2_500_000_000), ("k2", "r2", "s", "n", "d", '{"b":"gone.mp4"}', "train-000001.tar", 0)], "key string,record_uid string,source_key string,task_name string,task_description string,video_members_json string,shard string,target_duration_ns bigint").write.parquet(f"{root}/samples.parquet")
    spark.createDataFrame([("train-000001.tar", "k1.mp4", 512, 9), ("train-000001.tar", "k1.txt", 1, 2)], "shard string,member string,data_offset bigint,length bigint").write.parquet(f"{root}/members.parquet")
    found, missing = readers.catalog(spark, str(root))
    row = found.first()
    assert (row.uid, row.view, row.offset, row.text_length, row.duration) == ("r1", "head_left", 512, 2, 2.5) and row.path.endswith("shards/01/train-000001.tar") and missing.first().record_uid == "r2"
    import io
    import tarfile

    with tarfile.open(tmp_path / "x.tar", "w") as archive:
        for name, data in (("a.json", json.dumps({"media": {"items": [{"member": "a.mp4", "type": "video"}]}}).encode()), ("a.mp4", b"12345"), ("other.bin", b"x"), ("b.json", b'{"media":{"items":[{"type":"text"}]}}')):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            archive.addfile(info, io.BytesIO(data))
    rows = readers.tar_records(spark, str(tmp_path / "x.tar")).collect()
    assert len(rows) == 1 and [m.member for m in rows[0].members] == ["a.mp4"]
    ranged = rows[0].members[0]
    (tmp_path / "p.txt").write_bytes(b"abc\nde\npartial")
    assert [(r.line, r.raw, r.partial_bytes) for r in readers.complete_lines(spark, str(tmp_path / "p.txt")).collect()] == [(1, "abc", 7), (2, "de", 7)]

    def read(path, offset, length):
        with open(path.removeprefix("file:"), "rb") as f:
            f.seek(offset)
            return f.read(length)

    wanted = spark.createDataFrame([("u", str(tmp_path / "x.tar"), ranged.offset, 5), ("v", str(tmp_path / "x.tar"), 10**9, 5)], "uid string,path string,offset bigint,length bigint")
    assert {r.key: (r.content and bytes(r.content), r.error) for r in readers.ranged_bytes(wanted, read).collect()} == {"u": (b"12345", None), "v": (None, "short_read")}


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", "a", "s", "b0", 1), ("t", "a", "s", "b0", 2), ("t", "c", "s", "b1", 3)], "task string,uid string,source_key string,batch string,v int")
    new = sinks.new_records(rows, None)
    sinks.write_shards(new, str(tmp_path / "out"))
    back = spark.read.json(str(tmp_path / "out"))
    assert back.count() == 2 and sinks.new_records(rows, back.select("task", "uid")).count() == 0
    units = spark.createDataFrame([("i", "u", "t", "k", "1"), ("i", "u", "t", "k", "1"), ("i", "u", "t", "j", "2")], "identity_sha256 string,uid string,task string,unit_key string,value string")
    merged, conflict = sinks.merge_units(units, units.withColumn("value", F.when(F.col("unit_key") == "j", "9").otherwise(F.col("value"))))
    assert merged.where("unit_key = 'k'").count() == 1 and [r.unit_key for r in conflict.collect()] == ["j"]
    assert sinks.write_uid_list(rows, rows.where("v > 5"), str(tmp_path / "u")) == 0 and sorted(r.value for r in spark.read.text(str(tmp_path / "u")).collect()) == ["a", "c"]
    assert sinks.write_uid_list(rows, rows.where("v > 2"), str(tmp_path / "w")) == 1 and not (tmp_path / "w").exists()


def test_provider(spark):
    asked = spark.createDataFrame([("t", "m", p) for p in ("good", "bad", "boom")], "task string,model string,prompt string").withColumn("request_hash", provider.request_hash("task", "model", "prompt"))

    def call(task, model, prompt):
        if prompt == "boom":
            raise RuntimeError(prompt)
        return 'say {"a": 1} end' if prompt == "good" else "no object"

    cache = asked.where("prompt = 'bad'").select("request_hash", F.lit('{"a": 5}').alias("raw"))
    every, new = provider.through_cache(asked, cache, call)
    assert new.count() == 2 and every.count() == 2
    parsed = {r.a: r.error for r in provider.parsed_answers(every, "struct<a:int>").select("value.a", "error").collect()}
    assert parsed == {1: None, 5: None}
    assert {r.prompt: r.error for r in provider.replayed(asked, cache).collect()} == {"good": "not_recorded", "bad": None, "boom": "not_recorded"}
    lines = spark.createDataFrame([(k, f"l{k}") for k in range(5)], "id bigint, line string")
    out = provider.rewrite_in_batches(lines.coalesce(1), lambda chunk: [x.upper() for x in chunk] if len(chunk) <= 2 else chunk[:-1], size=4)
    assert {r.id: r.rewritten for r in out.collect()} == {k: f"L{k}" for k in range(5)}


def test_streams(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/1.txt").write_text("a\nb\n\na\n")
    for _ in range(2):
        follow.follow_ledger(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
        (tmp_path / "in/2.txt").write_text("b\nc\n")
    assert sorted(r.uid for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b", "c"]
    uids = lambda *x: spark.createDataFrame([(v,) for v in x], "uid string")
    ready, waiting, missing = follow.waits(uids("a", "b"), uids("a"), sealed=False)
    assert (ready.count(), waiting.count(), missing.count()) == (1, 1, 0) and follow.waits(uids("a", "b"), uids("a"), sealed=True)[2].count() == 1
    source = tmp_path / "f"
    spark.createDataFrame([("k", float(t)) for t in (0, 1, 2, 100)], "key string, t double").coalesce(1).write.parquet(str(source))
    stream = spark.readStream.schema("key string, t double").parquet(str(source))
    query = follow.sticky_backoff(stream, 3, 5.0).writeStream.format("memory").queryName("sticky").option("checkpointLocation", str(tmp_path / "cp2")).trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted((r.t, r.conservative) for r in spark.table("sticky").collect()) == [(0.0, False), (1.0, False), (2.0, True), (100.0, True)]


def test_turns_are_the_greedy_rule():
    for seed in range(500):
        r = random.Random(seed)
        load = [r.randint(0, r.choice([3, 500])) for _ in range(r.randint(1, 6))]
        size, n = r.randint(0, 9), r.randint(0, 400)
        heap, want, got = [(x, k) for k, x in enumerate(load)], [], []
        heapq.heapify(heap)
        for _ in range(n):
            at, k = heapq.heappop(heap)
            want.append(k)
            heapq.heappush(heap, (at + size, k))
        runs = sets._turns(load, size, n)
        for count, group in runs:
            got += [group[k % len(group)] for k in range(count)]
        assert got == want and sorted(heap) == sorted((x, k) for k, x in enumerate(load)) and len(runs) <= 2 * len(load) + 1


def test_dispatch(spark, tmp_path):
    folder = tmp_path / "clips"
    folder.mkdir()
    (folder / "a.mp4").write_bytes(b"x")
    assert readers.input_kind(spark, str(folder)) == "videos" and readers.input_kind(spark, str(folder / "a.mp4")) == "video"
    assert readers.load(spark, str(folder)).count() == readers.load(spark, str(folder / "a.mp4")).count() == 1
    (folder / "TAR_INDEX.jsonl").write_text("{}")
    assert readers.input_kind(spark, str(folder)) == "tar"
    (tmp_path / "m.jsonl").write_text('{"uid":"a","video_path":"v.mp4"}')
    assert readers.load(spark, str(tmp_path / "m.jsonl")).first().uid == "a"
    with pytest.raises(ValueError):
        readers.input_kind(spark, str(tmp_path / "nothing"))
    root = tmp_path / f"release{readers.PHYSICAL_SUFFIX}"
    (tmp_path / "release").mkdir()
    spark.createDataFrame([("k", "r", "s", "n", None, '{"ego":"k.mp4"}', "train-000001.tar", 1)], "key string,record_uid string,source_key string,task_name string,task_description string,video_members_json string,shard string,target_duration_ns bigint").write.parquet(f"{root}/catalog/samples.parquet")
    spark.createDataFrame([("train-000001.tar", "k.mp4", 512, 9)], "shard string,member string,data_offset bigint,length bigint").write.parquet(f"{root}/catalog/members.parquet")
    (root / "shards").mkdir()
    (root / "RELEASE.json").write_text('{"schema": "other"}')
    assert readers.input_kind(spark, str(tmp_path / "release")) == "videos"
    (root / "RELEASE.json").write_text('{"schema": "%s"}' % readers.RELEASE_SCHEMA)
    assert readers.input_kind(spark, str(tmp_path / "release")) == "catalog"
    assert readers.load(spark, str(tmp_path / "release"))[0].first().uid == "r"


def test_complete_lines_of_odd_files(spark, tmp_path):
    for name, data in (("a", b"x\n\ny\n"), ("b", b"only"), ("c", "é\r\nü".encode())):
        (tmp_path / f"{name}.txt").write_bytes(data)
    got = {}
    for r in readers.complete_lines(spark, str(tmp_path)).collect():
        got.setdefault(r.file[-5], []).append((r.line, r.raw, r.partial_bytes))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {"a": [(1, "x", 0), (2, "", 0), (3, "y", 0)], "b": [(None, None, 4)], "c": [(1, "é", 2)]}
    assert readers.repaired_lines(spark, str(tmp_path))[1].count() == 2


def test_reads_are_tried_again(spark):
    def read(path, offset, length):
        n = int(open(path).read() or 0) if os.path.exists(path) else 0
        with open(path, "w") as f:
            f.write(str(n + 1))
        if n == 0:
            raise TimeoutError
        return b"abc"

    path = f"/tmp/annolith-tries-{os.getpid()}"
    rows = spark.createDataFrame([(path,), (path,)], "path string")
    got = readers.objects(rows, read, backoff=0.01).collect()
    os.remove(path)
    assert [(bytes(r.content), r.attempts, r.error) for r in got] == [(b"abc", 2, None)]


def test_outbox(spark, tmp_path):
    held = spark.createDataFrame([("p0", "old")], "path string, value string").selectExpr("path", "value", "sha2(value, 256) AS sha256", "octet_length(value) AS bytes")
    rows = spark.createDataFrame([("p0", "new"), ("p1", "a"), ("p1", "a"), ("p2", "bcd")], "path string, value string")
    fresh, bad = outbox.enqueue(held, rows)
    assert sorted(r.path for r in fresh.collect()) == ["p1", "p2"] and [r.path for r in bad.collect()] == ["p0"]
    assert outbox.totals(fresh).first() == (2, 4) and outbox.totals(fresh.where("false")).first() == (0, 0)
    queue = fresh.withColumn("lane", F.lit("l"))
    assert {r.path: r.admitted for r in outbox.admitted(queue, files=5, size=3).collect()} == {"p1": True, "p2": False}
    fresh.write.parquet(str(tmp_path / "outbox"))
    for _ in range(2):
        stream = spark.readStream.schema(fresh.schema).parquet(str(tmp_path / "outbox"))
        outbox.publish_stream(stream, str(tmp_path / "target"), str(tmp_path / "ledger"), str(tmp_path / "check")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "target")).count() == 2 and outbox.pending(fresh, spark.read.parquet(str(tmp_path / "ledger"))).count() == 0


def test_packs_and_rewrites(spark):
    lines = spark.createDataFrame([(f"u{k}", "t", "s", "b", f"v{k}") for k in range(50)], "uid string, task string, source_key string, batch string, value string")
    one = outbox.packs(lines, size=10)
    two = outbox.packs(lines.orderBy(F.desc("uid")), size=10)
    assert one.select("pack").distinct().count() > 3 and one.exceptAll(two.select(one.columns)).count() == 0
    found, lost = outbox.expanded_packs(one, spark.createDataFrame([("u1",), ("zz",)], "uid string"))
    assert found.first().value == "v1" and lost.first().uid == "zz"
    shard = spark.createDataFrame([("a", 1, "x"), ("a", 2, "y"), ("b", 1, "x"), ("c", 1, "q")], "shard string, line int, value string")
    before = outbox.shard_digest(shard)
    changed = shard.withColumn("value", F.when(F.col("shard") == "c", "r").otherwise(F.col("value")))
    good, refused = outbox.audited_rewrite(changed, changed.where("NOT (shard = 'b')").select("shard", "line"), before)
    assert {r.shard for r in good.collect()} == {"a"} and {r.shard: r.reason for r in refused.collect()} == {"b": "unreviewed_lines", "c": "input_changed"}
    rows, seen = outbox.observed(shard, "figures", n=F.count("*"))
    rows.collect()
    assert seen.get["n"] == 4


def test_rejections(spark):
    rows = spark.createDataFrame([("u", "grd", "dashscope", "m", "c", "bad"), ("u", "sta", "dashscope", "m", "c", "bad")], "uid string, task string, provider string, model string, contract_id string, reason string")
    saved = outbox.rejections(rows)
    want = hashlib.sha256(json.dumps({"uid": "u", "task": "grd", "provider": "dashscope", "model": "m", "contract_id": "c"}, sort_keys=True).encode()).hexdigest()
    assert [r.identity for r in saved.collect()] == [want] and outbox.not_rejected(rows, saved).first().task == "sta"


def test_circuit_and_pace(spark, tmp_path):
    c = control.Circuit()
    for t in range(3):
        c = control.after_outcome(c, t, 0, False, "service_error", threshold=3, cooldown=10)
    assert c.mode == "open" and c.generation == 1 and c.until == 12
    assert control.after_outcome(c, 3, 0, False, "success").stale == 1 and control.admitted(c, 11).mode == "open"
    half = control.admitted(c, 12)
    assert half.mode == "half_open" and control.after_outcome(half, 13, 1, True, "success").mode == "closed" and control.after_outcome(half, 13, 1, True, "other").until == 73
    assert control.after_outcome(control.Circuit(), 5, 9, False, "service_error", 100).until == 105
    p = control.Cohort(1.0, 0.0)
    for t in range(9):
        p = control.after_response(p, 2.0 * t, 0.0, t == 3, floor=0.1, ceiling=9)
    assert p.interval == 1.25 and p.decisions == 1 and control.after_response(p, 99, 1.0, True, floor=0.1, ceiling=9).stale == p.stale + 1
    rows = spark.createDataFrame([("k", float(t), 0, False, "service_error", 0.0) for t in range(4)], "key string, t double, generation int, probe boolean, result string, retry_after double")
    rows.coalesce(1).write.parquet(str(tmp_path / "o"))
    stream = control.circuit_states(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "o")), threshold=3)
    query = stream.writeStream.format("memory").queryName("circuits").outputMode("append").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "c")).start()
    query.awaitTermination()
    got = spark.table("circuits").orderBy("t").collect()
    assert [r["mode"] for r in got] == ["closed", "closed", "open", "open"] and got[3].stale == 1


def test_answers(spark):
    texts = ['```json\n[{"a": 1}]\n```', '{"subtasks": [], "steps": [{"a": 2}]}', '[]', '[1]', 'x', '{"subtasks": [{"b": 1}, {"c": 2}]}', None]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, raw string").orderBy("k").select(provider.fenced_steps("raw")).collect()]
    assert [None if g is None else [json.loads(x) for x in g] for g in got] == [[{"a": 1}], [{"a": 2}], None, None, None, [{"b": 1}, {"c": 2}], None]
    good = {"scene_description": "s", "task_progress": "p", "atomic_action": "a", "current_subtask": dict.fromkeys(("subtask", "action", "object", "source", "target"), "x")}
    answers = [good, good | {"more": 1}, good | {"atomic_action": "x" * 241}, good | {"task_progress": 5}, good | {"current_subtask": {"subtask": ""}}]
    rows = spark.createDataFrame([(k, json.dumps(a)) for k, a in enumerate(answers)], "k int, a string").orderBy("k").select(provider.schema_errors("a")).collect()
    assert [r[0] for r in rows] == [[], ["additional:more"], ["atomic_action"], ["task_progress"], [f"current_subtask.{f}" for f in ("subtask", "action", "object", "source", "target")]]
    assert provider.response_schema()["schema"]["properties"]["current_subtask"]["properties"]["target"] == {"type": "string", "minLength": 1, "maxLength": 160}
