import hashlib
import json
import random

from pyspark.sql import functions as F

from annolith.functions import pyfuncs
from annolith.operators import events

PROPOSAL = "uid string,step_id string,pos int,event_id string,contact_time_seconds double,agent_role string,object_name string,contact_verb string"
REVIEW = "uid string,step_id string,pos int,event_id string,accepted boolean,valid_contact boolean,contact_time_seconds double,agent_role string,object_name string,contact_verb string"


def test_alignment(spark):
    p = spark.createDataFrame([("u", "1", k, f"e{k}", float(k), "r", "cup", "pick") for k in range(5)], PROPOSAL)
    r = spark.createDataFrame(
        [("u", "1", 0, "e0", True, True, 0.5, None, "mug", None), ("u", "1", 1, "zz", True, True, 1.5, "x", None, None), ("u", "1", 2, "e2", False, True, 2.0, None, None, None), ("u", "1", 3, "e3", True, False, 3.0, None, None, None), ("u", "2", 0, "q", True, True, 9.0, "r", "jar", "put")], REVIEW
    )
    got = {(x.step_id, x.event_id): (x.verdict, x.contact_time_seconds, x.proposed_event_id, x.object_name, x.by_place) for x in events.align(p, r).collect()}
    assert got == {
        ("1", "e0"): ("accepted", 0.5, None, "mug", False), ("1", "zz"): ("accepted", 1.5, "e1", "cup", True), ("1", "e2"): ("rejected", 2.0, None, "cup", False), ("1", "e3"): ("rejected", 3.0, None, "cup", False),
        ("1", "e4"): ("unreviewed", 4.0, None, "cup", False), ("2", "q"): ("accepted", 9.0, None, "jar", False),
    }


def test_inheritance(spark):
    p = spark.createDataFrame([("u", "1", 0, "e0", 1.0, "r", "cup", "pick")], PROPOSAL).withColumn("contact_media_index", F.lit(7))
    r = spark.createDataFrame([("u", "1", 0, None, True, True, None, None, "mug", None)], REVIEW).withColumn("contact_media_index", F.lit(None).cast("int"))
    x = events.inherit_missing(events.inherit_ids(r, p), p).first()
    assert (x.event_id, x.contact_time_seconds, x.object_name, x.contact_media_index) == ("e0", 1.0, "mug", 7)
    assert x.inherited == ["contact_time_seconds", "contact_media_index", "agent_role", "contact_verb"]


def test_previous_is_strict_beyond_the_tolerance(spark):
    df = spark.createDataFrame([("u", 1.0), ("u", 1.0 + 5e-7), ("u", 1.0 + 3e-6), ("u", 2.0)], "uid string, t double")
    got = [r.previous_t for r in sorted(events.previous_event(df).collect(), key=lambda r: r.t)]
    assert got[:2] == [None, None] and got[2] == 1.0 + 5e-7 and got[3] == 1.0 + 3e-6


EVENT = "uid string,pos int,event_id string,t double,contact_frame int,fps double,frame_count int,step_start_s double,step_end_s double,step_id string"


def test_sampling(spark):
    rows = [("u", 0, "a", 1.0, None, 30.0, 100, 0.0, 3.0, "1"), ("u", 1, "b", 1.5, 44, 30.0, 100, 0.0, 3.0, "1"), ("u", 2, "c", 1.5000001, None, 30.0, 100, 0.0, 3.0, "1"), ("u", 3, "d", 1.55, None, 30.0, 100, 0.0, 3.0, "1"), ("v", 0, "z", 0.0, None, 30.0, 100, 0.0, 3.0, "1")]
    out = {r.event_id: r for r in events.observations(events.observation_intervals(spark.createDataFrame(rows, EVENT)), count=3, seed=7, hashed=True).collect()}
    assert (out["a"].first_frame, out["a"].last_frame) == (0, 29) and out["b"].first_frame == 31 and out["b"].last_frame == 43
    assert out["d"].previous_t == 1.5000001 and out["d"].eligible == 0 and out["d"].sampled == [] and out["z"].eligible == 0
    eligible = [f for f in range(31, 44) if f not in (30, 44, 45, 46)]
    seed = json.dumps([7, "u", 1, "b", 44, 1.5], separators=(",", ":"))
    want = sorted(random.Random(int(hashlib.sha256(seed.encode()).hexdigest()[:16], 16)).sample(eligible, 3))
    assert out["b"].sampled == want and len(out["b"].sampled_hash) == 3


def test_seeded_sample():
    assert pyfuncs.seeded_ranks(0, 3, "x") == [] and pyfuncs.seeded_ranks(2, 5, "x") == [0, 1] and pyfuncs.seeded_ranks(1, 0, "x") == []
    a = pyfuncs.seeded_ranks(100, 10, "[1]")
    assert a == pyfuncs.seeded_ranks(100, 10, "[1]") and len(set(a)) == 10 and a == sorted(a)


def test_remap(spark):
    steps = spark.createDataFrame([("u", "1", 1, 0.0, 2.0), ("u", "2", 2, 2.0, 5.0), ("u", "3", 3, 5.0, 9.0)], "uid string,step_id string,pos int,start_s double,end_s double")
    rows = [("a", 1.0, "1", 0.0, 2.0), ("b", 2.3, "1", 0.0, 2.0), ("c", 3.0, "1", 0.0, 2.0), ("d", 5.1, "1", 0.0, 2.0), ("e", 99.0, "3", 5.0, 9.0)]
    df = spark.createDataFrame([("u", e, t, s, a, b, 10.0, 90) for e, t, s, a, b in rows], "uid string,event_id string,t double,step_id string,step_start_s double,step_end_s double,fps double,frame_count int")
    got = {r.event_id: r.error for r in events.remap_to_view(df, steps).collect()}
    assert got == {"a": None, "b": None, "c": "subtask_mismatch", "d": "subtask_mismatch", "e": "outside_target_view"}


def test_identity(spark):
    a = spark.createDataFrame([("u", "1", "x", 1.0, 5, None), ("u", "1", "y", 2.0, 6, None), ("u", "1", "w", None, 1, None)], "uid string,step_id string,event_id string,contact_time_seconds double,contact_source_frame_index int,contact_media_index int")
    assert events.identity_errors(a, a).count() == 0
    b = spark.createDataFrame([("u", "1", "x", 1.0 + 5e-7, 5, None), ("u", "1", "y", 2.0, 7, None), ("u", "1", "w", 3.0, 1, None), ("u", "1", "q", 1.0, 1, None)], a.schema)
    assert {r.event_id: r.error for r in events.identity_errors(a, b).collect()} == {"y": "contact_source_frame_index_mismatch", "w": "contact_time_mismatch", "q": "event_set_mismatch"}
