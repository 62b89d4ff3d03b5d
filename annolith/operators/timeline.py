"""Interval algebra on exploded step tables.

A step table has one row per step: uid, pos (order in its episode), the five semantic fields, and bounds:
start_s and end_s in seconds (half-open), or start_i and end_i as image indices (inclusive).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions.scalar import casefold, collapse, half_even, skill_words

SEMANTIC = ("subtask", "action", "object", "source", "target")
GAP_S, SAME_START_S, CHUNK_S, WHOLE_S = 1e-4, 1e-6, 295.0, 300.0


def _by(uid: str, pos: str):
    return W.partitionBy(uid).orderBy(pos)


def contiguity(steps: DataFrame, *, uid: str = "uid", pos: str = "pos", start: str = "start_s", end: str = "end_s", tolerance: float = GAP_S) -> DataFrame:
    """Adds gap (start less the previous end; null for the first step) and contiguous."""
    gap = F.col(start) - F.lag(end).over(_by(uid, pos))
    return steps.withColumn("gap", gap).withColumn("contiguous", F.coalesce(F.abs("gap") <= tolerance, F.lit(True)))


def folded_signature(fields: tuple[str, ...] = SEMANTIC) -> Column:
    """The semantic fields with white space collapsed and case folded, as an array."""
    return F.array(*[casefold(collapse(F.coalesce(F.col(f), F.lit("")))) for f in fields])


def islands(rows: DataFrame, signature: Column, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Adds island: the running number of runs of equal neighbours."""
    by = _by(uid, pos)
    marked = rows.withColumn("_sig", signature).withColumn("_new", F.coalesce((F.col("_sig") != F.lag("_sig").over(by)).cast("int"), F.lit(1)))
    return marked.withColumn("island", F.sum("_new").over(by)).drop("_sig", "_new")


def merge_adjacent(steps: DataFrame, *, uid: str = "uid", pos: str = "pos", end_columns: tuple[str, ...] = ("end_s", "end_i"), signature: Column | None = None) -> DataFrame:
    """Runs of equal neighbours become one step: the first row's values, the last row's end; adds merged (rows in it).

    pos is renumbered from 1 only in episodes where something was merged.
    """
    marked = islands(steps, folded_signature() if signature is None else signature, uid=uid, pos=pos)
    ends = [c for c in end_columns if c in steps.columns]
    keep = [c for c in steps.columns if c not in (uid, *ends)]
    out = marked.groupBy(uid, "island").agg(
        F.min_by(F.struct(*keep), F.col(pos)).alias("_first"), *[F.max_by(F.struct(c), F.col(pos))[c].alias(c) for c in ends], F.count("*").alias("merged")
    )
    whole = W.partitionBy(uid)
    flat = out.select(uid, "_first.*", *ends, "merged", "island").withColumn("_any", F.max("merged").over(whole) > 1)
    return flat.withColumn(pos, F.when(F.col("_any"), F.col("island").cast(steps.schema[pos].dataType)).otherwise(F.col(pos))).select(*steps.columns, "merged")


def adjacent_duplicates(steps: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """For each episode how many steps repeat their predecessor."""
    marked = steps.withColumn("_sig", folded_signature())
    return marked.withColumn("_same", F.col("_sig") == F.lag("_sig").over(_by(uid, pos))).groupBy(uid).agg(F.count_if("_same").alias("adjacent_identical"))


def segments_to_steps(segments: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Provider segments (uid, pos, start, description, skill, has_video, media_count, duration) to contiguous steps.

    Starts are clamped and sorted; of starts within 1e-6 the last wins; each step ends where the next begins;
    empty ones go; the first begins at zero and the last ends with the source.  error is set, and the bounds
    null, for an episode with an empty description or a start that is no finite number.
    """
    text = collapse(F.coalesce("description", F.lit("")))
    bad = (text == "") | F.col("start").isNull() | F.isnan("start") | (F.abs("start") == float("inf"))
    whole = W.partitionBy(uid)
    rows = segments.select(
        uid, F.col(pos).alias("_p"), text.alias("_text"), F.coalesce(F.nullif(F.trim("skill"), F.lit("")), F.lit("None")).alias("_skill"), "has_video", "media_count", "duration", bad.alias("_bad"),
        F.least(F.col("duration"), F.greatest(F.lit(0.0), F.col("start"))).alias("_start"),
    ).withColumn("_error", F.max(F.when(F.col("_bad"), F.when(F.col("_text") == "", "description_empty").otherwise("start_invalid"))).over(whole))
    good = rows.where(F.col("_error").isNull())
    order = W.partitionBy(uid).orderBy("_start", "_p")
    # A chain of starts, each within the tolerance of the one before, keeps its last row.
    last_of_chain = F.lead("_start").over(order).isNull() | (F.lead("_start").over(order) - F.col("_start") > SAME_START_S)
    kept = good.withColumn("_stay", last_of_chain).where("_stay")
    order = W.partitionBy(uid).orderBy("_start", "_p")
    following, is_last = F.lead("_start").over(order), F.lead("_start").over(order).isNull()
    top = F.greatest(F.lit(0), F.col("media_count") - 1)
    end = F.when(F.col("has_video"), F.when(is_last, F.col("duration")).otherwise(following)).otherwise(F.when(is_last, top).otherwise(half_even(top * following / F.col("duration"))).cast("double"))
    bounded = kept.withColumn("_end", end).withColumn("_reach", F.max("_end").over(order.rowsBetween(W.unboundedPreceding, -1)))
    bounded = bounded.withColumn("_from", F.coalesce("_reach", F.lit(0.0))).withColumn("_to", F.greatest("_end", "_from"))
    solid = bounded.where(F.when(F.col("has_video"), F.col("_to") > F.col("_from")).otherwise(F.col("_to") >= F.col("_from")))
    n, count = F.row_number().over(order), F.count("*").over(whole)
    first, final = n == 1, n == count
    steps = solid.select(
        uid, n.alias(pos), F.lower("_text").alias("subtask"), F.when(F.col("_skill") == "None", "None").otherwise(F.lower("_skill")).alias("action"),
        *[F.lit("None").alias(f) for f in SEMANTIC[2:]],
        F.when(F.col("has_video"), F.when(first, 0.0).otherwise(F.col("_from"))).alias("start_s"),
        F.when(F.col("has_video"), F.when(final, F.col("duration")).otherwise(F.col("_to"))).alias("end_s"),
        F.when(~F.col("has_video"), F.when(first, 0).otherwise(F.col("_from"))).cast("int").alias("start_i"),
        F.when(~F.col("has_video"), F.when(final, top).otherwise(F.col("_to"))).cast("int").alias("end_i"),
        F.lit(None).cast("string").alias("error"),
    )
    failed = rows.where(F.col("_error").isNotNull()).select(uid, "_error").distinct()
    return steps.unionByName(failed.select(uid, F.col("_error").alias("error")), allowMissingColumns=True)


def provider_frames_to_steps(items: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Provider frame ranges (uid, pos, start_frame, end_frame, description, skill, has_video, frame_count, duration) to steps.

    Ends are rescaled to the provider's outer range and clamped; a step that does not advance is dropped.
    """
    by, whole = _by(uid, pos), W.partitionBy(uid).orderBy(pos).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    low, high = F.first("start_frame").over(whole), F.last("end_frame").over(whole)
    top = F.when(F.col("has_video"), F.col("duration")).otherwise(F.greatest(F.lit(0), F.col("frame_count") - 1).cast("double"))
    is_last = F.lead(pos).over(by).isNull()
    part = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (F.col("end_frame") - low) / (high - low)))
    raw = F.when(is_last, top).otherwise(top * part)
    rows = items.withColumn("_top", top).withColumn("_ok", high > low).withColumn("_end", F.when(F.col("has_video"), raw).otherwise(half_even(raw)))
    rows = rows.withColumn("_before", F.coalesce(F.max("_end").over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0.0)))
    advances = F.when(F.col("has_video"), F.col("_end") > F.col("_before") + SAME_START_S).otherwise(F.col("_end") >= F.col("_before"))
    kept = rows.where(F.col("_ok") & advances)
    n = F.row_number().over(by)
    final = F.lead(pos).over(by).isNull()
    return kept.select(
        uid, n.alias(pos), F.lower(F.trim("description")).alias("subtask"), skill_words("skill").alias("action"), *[F.lit("None").alias(f) for f in SEMANTIC[2:]],
        F.when(F.col("has_video"), F.col("_before")).alias("start_s"), F.when(F.col("has_video"), F.when(final, F.col("_top")).otherwise(F.col("_end"))).alias("end_s"),
        F.when(~F.col("has_video"), F.col("_before")).cast("int").alias("start_i"), F.when(~F.col("has_video"), F.when(final, F.col("_top")).otherwise(F.col("_end"))).cast("int").alias("end_i"),
        "start_frame", "end_frame",
    )


def chunk_ranges(durations: DataFrame, *, uid: str = "uid", duration: str = "duration", chunk: float = CHUNK_S, whole: float = WHOLE_S) -> DataFrame:
    """Equal spans of long sources (uid, chunk, start, span); the last takes what is left; short sources stay whole."""
    n = F.when(F.col(duration) <= whole, F.lit(1)).otherwise(F.greatest(F.lit(2), F.ceil(F.col(duration) / chunk))).cast("int")
    rows = durations.select(uid, F.col(duration).alias("_d"), n.alias("_n")).select(uid, "_d", "_n", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)).alias("chunk"))
    start = F.col("chunk") * (F.col("_d") / F.col("_n"))
    return rows.select(uid, "chunk", start.alias("start"), F.when(F.col("chunk") == F.col("_n") - 1, F.col("_d") - start).otherwise(F.col("_d") / F.col("_n")).alias("span"))


def merge_chunks(steps: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Steps of independent chunks (uid, chunk, pos, start_s, end_s, local_duration, chunk_start, span, duration) on one timeline.

    Each chunk is stretched to its span and pinned to its edges; exactly equal neighbours merge; starts are
    stitched to the previous end; the ends of the episode are pinned.
    """
    inside = W.partitionBy(uid, "chunk").orderBy("pos")
    scale = F.when(F.col("local_duration") > 0, F.col("span") / F.col("local_duration")).otherwise(F.lit(1.0))
    lead, lag = F.lead("pos").over(inside), F.lag("pos").over(inside)
    mapped = steps.select(
        uid, "chunk", "pos", *SEMANTIC, "duration",
        F.when(lag.isNull(), F.col("chunk_start")).otherwise(F.col("chunk_start") + F.col("start_s") * scale).alias("start_s"),
        F.when(lead.isNull(), F.col("chunk_start") + F.col("span")).otherwise(F.col("chunk_start") + F.col("end_s") * scale).alias("end_s"),
    ).withColumn("_order", F.row_number().over(W.partitionBy(uid).orderBy("chunk", "pos")))
    merged = merge_adjacent(mapped, uid=uid, pos="_order", end_columns=("end_s",), signature=F.array(*[F.col(f) for f in SEMANTIC]))
    by = W.partitionBy(uid).orderBy("_order")
    start = F.when(F.lag("end_s").over(by).isNull(), F.lit(0.0)).otherwise(F.lag("end_s").over(by))
    end = F.when(F.lead("end_s").over(by).isNull(), F.col("duration")).otherwise(F.col("end_s"))
    return merged.select(uid, F.row_number().over(by).alias("pos"), F.col("chunk").alias("provider_chunk"), *SEMANTIC, start.alias("start_s"), end.alias("end_s"), "merged")


def validate(steps: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Errors of each episode's steps (uid, errors), in the order of the checks; an empty array if there are none.

    Steps have has_video, media_count and duration besides their bounds.
    """
    by, whole = _by(uid, pos), W.partitionBy(uid)
    start = F.when(F.col("has_video"), F.col("start_s")).otherwise(F.col("start_i").cast("double"))
    end = F.when(F.col("has_video"), F.col("end_s")).otherwise(F.col("end_i").cast("double"))
    rows = steps.withColumn("_s", start).withColumn("_e", end).withColumn("_n", F.row_number().over(by)).withColumn("_count", F.count("*").over(whole)).withColumn("_before", F.lag("_e").over(by))
    bad_bounds = F.col("_s").isNull() | F.col("_e").isNull() | (F.col("_s") < 0) | F.when(F.col("has_video"), F.col("_e") <= F.col("_s")).otherwise(F.col("_e") < F.col("_s"))
    off_end = F.when(F.col("has_video"), F.abs(F.col("_e") - F.col("duration")) > 0.5).otherwise(F.col("_e") != F.col("media_count") - 1)
    checks = (
        ("subtask_invalid", F.coalesce(F.trim("subtask"), F.lit("")) == ""),
        ("subtask_invalid_bounds", bad_bounds),
        ("subtask_noncontiguous", F.abs(F.col("_s") - F.col("_before")) > GAP_S),
        ("subtask_first_start_not_zero", (F.col("_n") == 1) & (F.abs("_s") > GAP_S)),
        ("subtask_final_end_mismatch", (F.col("_n") == F.col("_count")) & off_end),
    )
    found = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in checks]))
    return rows.groupBy(uid).agg(F.flatten(F.collect_list(found)).alias("_all")).select(uid, F.array_distinct(F.filter(F.array(*[F.lit(n) for n, _ in checks]), lambda n: F.array_contains("_all", n))).alias("errors"))


def normalised(steps: DataFrame) -> DataFrame:
    """Semantic fields trimmed and in lower case; blanks become 'None', which keeps its capital."""
    for f in SEMANTIC[1:]:
        t = F.coalesce(F.nullif(F.trim(f), F.lit("")), F.lit("None"))
        steps = steps.withColumn(f, F.when(t == "None", t).otherwise(F.lower(t)))
    return steps.withColumn("subtask", F.lower(F.trim("subtask")))


def points_in_intervals(points: DataFrame, intervals: DataFrame, *, key: str = "uid", at: str = "t", start: str = "start_s", end: str = "end_s", pos: str = "pos", width: float = 60.0, closed: bool = False, how: str = "inner") -> DataFrame:
    """Each point with the first interval of its key that holds it.

    An equi-join on key and time bucket: an interval stands in every bucket that it touches, so neither a
    cross product nor a scan of all of a key's intervals is needed.  Intervals are half-open and the last of
    a key is closed; ``closed`` closes all of them (image indices).  Points need a unique row id only if equal
    points must stay apart; ties between intervals go to the smallest pos.  Choose ``width`` near the usual
    length of an interval: longer intervals are replicated once for each bucket.
    """
    is_last = F.lead(pos).over(W.partitionBy(key).orderBy(pos)).isNull()
    left = points.withColumn("_id", F.monotonically_increasing_id()).withColumn("_b", F.floor(F.col(at) / width))
    spans = intervals.withColumn("_last", F.lit(True) if closed else is_last)
    spans = spans.withColumn("_b", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor(F.greatest(start, end) / width)))).withColumnsRenamed({key: "_key", pos: "_pos"})
    inside = (F.col(at) >= F.col(start)) & ((F.col(at) < F.col(end)) | (F.col("_last") & (F.col(at) == F.col(end))))
    hit = left.join(spans, (left[key] == spans["_key"]) & (left["_b"] == spans["_b"]) & inside, how).drop(spans["_b"])
    first = F.row_number().over(W.partitionBy("_id").orderBy(F.col("_pos").asc_nulls_last()))
    return hit.withColumn("_rank", first).where("_rank = 1").withColumn(pos, F.col("_pos")).drop("_id", "_b", "_key", "_pos", "_last", "_rank")


def timeline(steps: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """One row for each episode with its steps as an array, in order."""
    fields = [c for c in (pos, "subtask", "start_s", "end_s", "start_i", "end_i") if c in steps.columns]
    return steps.groupBy(uid).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("subtasks"))
