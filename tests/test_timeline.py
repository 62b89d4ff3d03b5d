import itertools

import numpy as np
from pyspark.sql import functions as F

from annolith.functions import pyfuncs, scalar
from annolith.operators import grids, timeline

STEP = "uid string,pos int,subtask string,action string,object string,source string,target string,start_s double,end_s double"


def steps(spark, *rows):
    return spark.createDataFrame([(u, p, s, "a", "o", "s", "t", a, b) for u, p, s, a, b in rows], STEP)


def test_contiguity_tolerance(spark):
    rows = timeline.contiguity(steps(spark, ("u", 1, "a", 0.0, 1.0), ("u", 2, "b", 1.00009, 2.0), ("u", 3, "c", 2.0002, 3.0))).collect()
    assert [r.contiguous for r in sorted(rows, key=lambda r: r.pos)] == [True, True, False]


def test_merge_collapses_white_space_and_case(spark):
    merged = timeline.merge_adjacent(steps(spark, ("u", 1, " Pick  Up", 0.0, 1.0), ("u", 5, "pick up", 1.0, 2.0), ("u", 6, "put", 2.0, 3.0), ("v", 4, "x", 0.0, 1.0)))
    got = sorted((r.uid, r.pos, r.subtask, r.end_s, r.merged) for r in merged.collect())
    assert got == [("u", 1, " Pick  Up", 2.0, 2), ("u", 2, "put", 3.0, 1), ("v", 4, "x", 1.0, 1)]


def test_merge_folds_case(spark):
    rows = steps(spark, ("u", 1, "Straße", 0.0, 1.0), ("u", 2, "STRASSE", 1.0, 2.0))
    assert timeline.merge_adjacent(rows).count() == 1


def test_casefold_is_unicodes(spark):
    """Letters that fold alike in Python fold alike here, and no others, over the first planes' letters in turn."""
    letters = [chr(k) for k in range(32, 0x2E80) if chr(k).isalpha()]
    got = dict(spark.createDataFrame([(x, f"a{x}b") for x in letters], "x string, y string").select("x", scalar.casefold("y").alias("z")).collect())
    fold = lambda pairs: sorted(sorted(xs) for xs in _groups(pairs).values())
    here, there = fold([(x, got[x]) for x in letters]), fold([(x, f"a{x}b".casefold()) for x in letters])
    assert [g for g in here if g not in there] == [] and scalar is not None


def _groups(pairs):
    found = {}
    for x, key in pairs:
        found.setdefault(key, []).append(x)
    return found


SEG = "uid string,pos int,start double,description string,skill string,has_video boolean,media_count int,duration double"


def test_segments(spark):
    df = spark.createDataFrame(
        [("u", 1, 5.0, "B", "Xy", True, 0, 10.0), ("u", 2, 0.5, "a  a", None, True, 0, 10.0), ("u", 3, 5.0000005, "C", "k", True, 0, 10.0), ("u", 4, 12.0, "late", "k", True, 0, 10.0), ("w", 1, 1.0, "  ", "k", True, 0, 10.0), ("n", 1, float("nan"), "x", "k", True, 0, 10.0), ("i", 1, 0.0, "p", "k", False, 5, 4.0), ("i", 2, 2.0, "q", "k", False, 5, 4.0)], SEG
    )
    got = sorted(((r.uid, r.pos, r.subtask, r.start_s, r.end_s, r.start_i, r.end_i, r.error) for r in timeline.segments_to_steps(df).collect()), key=str)
    assert ("u", 1, "a a", 0.0, 5.0000005, None, None, None) in got and ("u", 2, "c", 5.0000005, 10.0, None, None, None) in got
    assert ("i", 1, "p", None, None, 0, 2, None) in got and ("i", 2, "q", None, None, 2, 4, None) in got
    assert [r[-1] for r in got if r[0] in "wn"] == ["start_invalid", "description_empty"] and len(got) == 6


def test_validation_codes(spark):
    base = steps(spark, ("ok", 1, "a", 0.0, 5.0), ("late", 1, "a", 0.5, 5.0), ("end", 1, "a", 0.0, 4.4), ("near", 1, "a", 0.0, 4.6), ("blank", 1, " ", 0.0, 5.0), ("gap", 1, "a", 0.0, 1.0), ("gap", 2, "b", 1.2, 5.0), ("bad", 1, "a", 3.0, 2.0))
    rows = timeline.validate(base.withColumns({"has_video": F.lit(True), "media_count": F.lit(0), "duration": F.lit(5.0), "start_i": F.lit(None).cast("int"), "end_i": F.lit(None).cast("int")}))
    got = {r.uid: r.errors for r in rows.collect()}
    assert got["ok"] == got["near"] == [] and got["late"] == ["subtask_first_start_not_zero"] and got["end"] == ["subtask_final_end_mismatch"]
    assert got["blank"] == ["subtask_invalid"] and got["gap"] == ["subtask_noncontiguous"] and "subtask_invalid_bounds" in got["bad"]


def test_points_at_the_edges(spark):
    spans = steps(spark, ("u", 1, "a", 0.0, 2.0), ("u", 2, "b", 2.0, 5.0))
    points = spark.createDataFrame([("u", 0.0), ("u", 2.0), ("u", 5.0), ("u", 5.1), ("u", -1.0), ("x", 1.0)], "uid string, t double")
    for width in (0.5, 3.0, 100.0):
        hit = timeline.points_in_intervals(points, spans.select("uid", "pos", "start_s", "end_s"), width=width, how="left")
        assert {(r.uid, r.t): r.pos for r in hit.collect()} == {("u", 0.0): 1, ("u", 2.0): 2, ("u", 5.0): 2, ("u", 5.1): None, ("u", -1.0): None, ("x", 1.0): None}


def test_image_indices_are_inclusive(spark):
    spans = spark.createDataFrame([("u", 1, 0, 3), ("u", 2, 3, 5)], "uid string,pos int,start_s int,end_s int")
    points = spark.createDataFrame([("u", k) for k in range(7)], "uid string, t int")
    hit = timeline.points_in_intervals(points, spans, width=2.0, closed=True, how="left")
    assert [r.pos for r in sorted(hit.collect(), key=lambda r: r.t)] == [1, 1, 1, 1, 2, 2, None]


def test_chunk_merge(spark):
    rows = [("u", 0, 1, "a", 0.0, 5.0, 10.0, 0.0, 20.0), ("u", 0, 2, "f", 5.0, 10.0, 10.0, 0.0, 20.0), ("u", 1, 1, "f", 0.0, 10.0, 20.0, 20.0, 20.0), ("u", 1, 2, "z", 10.0, 19.0, 20.0, 20.0, 20.0)]
    df = spark.createDataFrame([(u, c, p, s, "b", "c", "d", "e", a, b, ld, cs, sp, 40.0) for u, c, p, s, a, b, ld, cs, sp in rows], "uid string,chunk int,pos int,subtask string,action string,object string,source string,target string,start_s double,end_s double,local_duration double,chunk_start double,span double,duration double")
    got = sorted((r.pos, r.subtask, r.start_s, r.end_s, r.merged) for r in timeline.merge_chunks(df).collect())
    assert got == [(1, "a", 0.0, 10.0, 1), (2, "f", 10.0, 30.0, 2), (3, "z", 30.0, 40.0, 1)]


def test_anchor_edges(spark):
    df = steps(spark, ("u", 1, "on", 1.0, 2.0), ("u", 2, "after", 1.01, 1.4), ("u", 3, "past", 3.0, 9.0)).withColumn("duration", F.lit(4.0))
    got = {}
    for r in grids.anchors(df).collect():
        got.setdefault(r.pos, []).append(r.anchor_frame)
    assert got == {1: [2, 3], 3: [6, 7]}


def test_empty_ranges(spark):
    row = spark.range(1).select(grids.int_range(F.lit(0), F.lit(0)).alias("a"), grids.int_range(F.lit(2), F.lit(0)).alias("b"), grids.int_range(F.lit(0), F.lit(2)).alias("c")).first()
    assert (row.a, row.b, row.c) == ([], [], [0, 1])


def _bounded(first, last, important, maximum):
    if last < first:
        return []
    if last - first < maximum:
        return list(range(first, last + 1))
    chosen = sorted({x for x in important if first <= x <= last})
    have = set(chosen[:maximum]) | ({int(round(x)) for x in np.linspace(first, last, maximum - len(chosen))} if len(chosen) < maximum else set())
    rest = (x for x in range(first, last + 1) if x not in have)
    return sorted([*have, *itertools.islice(rest, maximum - len(have))])[:maximum]


def test_bounded(spark):
    cases = [(0, 9, [], 24), (3, 2, [], 4), (0, 100, [5, 6, 7, 400], 2), (0, 100, [50, 51], 10), (0, 47, [0, 47, 23], 24), (10, 95, [11, 12, 13], 5), (0, 30, [], 8), (7, 60, [8], 2), (0, 25, [1, 2, 3, 24, 25], 24), (0, 1000, [999, 3], 3)]
    for maximum in {c[3] for c in cases}:
        some = [c for c in cases if c[3] == maximum]
        df = spark.createDataFrame([(k, *c[:3]) for k, c in enumerate(some)], "k int, a int, b int, i array<int>")
        got = dict(df.select("k", grids.bounded(F.col("a"), F.col("b"), F.col("i"), maximum)).collect())
        assert [got[k] for k in range(len(some))] == [_bounded(*c) for c in some]


def test_history():
    assert pyfuncs.history(0, 30, 30.0) == [0, 6, 12, 18, 24, 30] and pyfuncs.history(4, 4, 30.0) == [4]
    assert pyfuncs.history(0, 10, 4.0) is None and pyfuncs.history(5, 3, 30.0) is None
