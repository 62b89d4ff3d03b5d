"""Contact events: alignment of proposals and reviews, inheritance, as-of joins and observation sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions import pyfuncs
from annolith.functions.scalar import finite

from .grids import FUTURE_FPS, int_range

CLOSE_S, SAME_S = 1e-6, 1e-6
INHERITED = ("contact_time_seconds", "contact_media_index", "agent_role", "object_name", "contact_verb")


def inherit_ids(reviews: DataFrame, proposals: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id")) -> DataFrame:
    """Reviews without an event_id take the id of the proposal in the same place."""
    of = proposals.select(*keys, "pos", F.col("event_id").alias("_proposed"))
    return reviews.join(of, [*keys, "pos"], "left").withColumn("event_id", F.coalesce("event_id", "_proposed")).drop("_proposed")


def matched(reviews: DataFrame, proposals: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id")) -> DataFrame:
    """Each review with its proposal as a struct: by event_id, else, only if that fails, by place.

    Two equi-joins; the second runs for the reviews that the first left over.
    """
    fields = [c for c in proposals.columns if c not in keys]
    of = proposals.select(*keys, F.struct(*fields).alias("proposal"))
    by_id = of.where(F.col("proposal.event_id").isNotNull()).select(*keys, F.col("proposal.event_id").alias("event_id"), F.col("proposal").alias("_by_id"))
    last = W.partitionBy(*keys, "event_id").orderBy(F.desc("_by_id.pos"))
    by_id = by_id.withColumn("_k", F.row_number().over(last)).where("_k = 1").drop("_k")
    by_pos = of.select(*keys, F.col("proposal.pos").alias("pos"), F.col("proposal").alias("_by_pos"))
    return reviews.join(by_id, [*keys, "event_id"], "left").join(by_pos, [*keys, "pos"], "left").withColumn("proposal", F.coalesce("_by_id", "_by_pos")).withColumn("by_place", F.col("_by_id").isNull() & F.col("_by_pos").isNotNull()).drop("_by_id", "_by_pos")


def align(proposals: DataFrame, reviews: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id")) -> DataFrame:
    """Final events: verdict 'accepted', 'rejected' or 'unreviewed', with review values over the proposal's.

    reviews: event_id, pos, accepted, valid_contact, contact_time_seconds, ...; a review is accepted if it says
    so, its exact frame is valid and it has a time.  Proposals that no review took by id, nor by place, are
    'unreviewed'.
    """
    pairs = matched(reviews, proposals, keys=keys)
    ok = F.coalesce(F.col("accepted") & F.col("valid_contact"), F.lit(False)) & finite("contact_time_seconds")
    pick = lambda f: F.coalesce(F.col(f), F.col(f"proposal.{f}")).alias(f)
    final = pairs.select(
        *keys, "pos", F.when(ok, F.col("event_id")).otherwise(F.coalesce("proposal.event_id", "event_id")).alias("event_id"), F.when(ok, "accepted").otherwise("rejected").alias("verdict"),
        F.when(ok, F.col("contact_time_seconds")).otherwise(F.coalesce("proposal.contact_time_seconds", "contact_time_seconds")).alias("contact_time_seconds"),
        F.when(ok, F.col("proposal.contact_time_seconds")).alias("proposed_time_seconds"),
        F.when(ok & ~F.col("proposal.event_id").eqNullSafe(F.col("event_id")), F.col("proposal.event_id")).alias("proposed_event_id"),
        pick("agent_role"), pick("object_name"), pick("contact_verb"), "by_place",
    )
    taken = pairs.select(*keys, F.explode(F.array_distinct(F.array_compact(F.array("event_id", "proposal.event_id")))).alias("event_id")).distinct()
    left = proposals.join(taken, [*keys, "event_id"], "left_anti").select(*keys, "pos", "event_id", F.lit("unreviewed").alias("verdict"), "contact_time_seconds", "agent_role", "object_name", "contact_verb", F.lit(False).alias("by_place"))
    return final.unionByName(left, allowMissingColumns=True)


def verdict_counts(aligned: DataFrame, *, uid: str = "uid") -> DataFrame:
    return aligned.groupBy(uid).agg(F.count_if(F.col("verdict") == "accepted").alias("accepted"), F.count_if(F.col("verdict") != "accepted").alias("rejected"))


def inherit_missing(reviews: DataFrame, proposals: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id"), fields: tuple[str, ...] = INHERITED) -> DataFrame:
    """Null review fields are filled from the proposal; inherited lists which."""
    pairs = matched(reviews, proposals, keys=keys)
    took = F.array_compact(F.array(*[F.when(F.col(f).isNull() & F.col(f"proposal.{f}").isNotNull(), F.lit(f)) for f in fields]))
    out = pairs.withColumn("inherited", took)
    for f in fields:
        out = out.withColumn(f, F.coalesce(F.col(f), F.col(f"proposal.{f}")))
    return out.drop("proposal", "by_place")


def identity_errors(left: DataFrame, right: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id", "event_id"), time: str = "contact_time_seconds", exact: tuple[str, ...] = ("contact_source_frame_index", "contact_media_index")) -> DataFrame:
    """Rows on which two results disagree (keys, error); no rows mean that they are the same."""
    a = left.select(*keys, *[F.col(c).alias(f"_l_{c}") for c in (time, *exact)], F.lit(True).alias("_in_l"))
    b = right.select(*keys, *[F.col(c).alias(f"_r_{c}") for c in (time, *exact)], F.lit(True).alias("_in_r"))
    both = a.join(b, list(keys), "full_outer")
    l, r = F.col(f"_l_{time}"), F.col(f"_r_{time}")
    far = F.coalesce(F.abs(l - r) > SAME_S, l.isNull() != r.isNull())
    error = F.when(F.col("_in_l").isNull() | F.col("_in_r").isNull(), "event_set_mismatch").when(far, "contact_time_mismatch")
    for c in exact:
        error = error.when(~F.col(f"_l_{c}").eqNullSafe(F.col(f"_r_{c}")), f"{c}_mismatch")
    return both.withColumn("error", error).where(F.col("error").isNotNull()).select(*keys, "error")


def _earlier(uid: str, time: str, tolerance: float) -> str:
    """A window of rows earlier by more than the tolerance; in SQL, where a range may be bounded by a double."""
    return f"PARTITION BY {uid} ORDER BY {time} RANGE BETWEEN UNBOUNDED PRECEDING AND {tolerance * (1 + 1e-9)!r}D PRECEDING"


def previous_event(events: DataFrame, *, uid: str = "uid", time: str = "t", tolerance: float = CLOSE_S, condition: Column | None = None) -> DataFrame:
    """Adds previous_t: the latest time of the same uid that is earlier by more than the tolerance.

    A range frame, so one sort per uid.  The frame's end is inclusive; just beyond the tolerance it is
    strict, as the next smaller double bounds it.  condition says which rows count as events.
    """
    source = F.col(time) if condition is None else F.when(condition, F.col(time))
    return events.withColumn("_t", source).withColumn("previous_t", F.expr(f"max(_t) OVER ({_earlier(uid, time, tolerance)})")).drop("_t")


def previous_index(events: DataFrame, *, uid: str = "uid", index: str = "contact_media_index") -> DataFrame:
    frame = W.partitionBy(uid).orderBy(index).rangeBetween(W.unboundedPreceding, -1)
    return events.withColumn("previous_index", F.max(index).over(frame))


def without_contacts(candidates: DataFrame, contacts: DataFrame, *, uid: str = "uid", frame: str = "frame") -> DataFrame:
    """Candidate frames that are no contact frame anywhere in the episode."""
    return candidates.join(contacts.select(uid, frame).distinct(), [uid, frame], "left_anti")


def observation_intervals(events: DataFrame, *, lookback: float = 1.0, gap: float = 0.0) -> DataFrame:
    """Adds first_frame and last_frame from which observations of each contact are drawn.

    events: uid, step_start_s, step_end_s, event_id, t, contact_frame (null: from t), fps, frame_count.
    After the previous contact (by time and by its own frame), inside the step, before the contact.
    """
    fps = F.col("fps")
    rows = events.withColumn("_own", F.col("contact_frame")).withColumn("contact_frame", F.greatest(F.lit(0), F.least(F.col("frame_count") - 1, F.coalesce("contact_frame", F.bround(F.col("t") * fps)))).cast("int"))
    # Of equal latest times the first in order counts, and only a stated frame moves the bound.
    before = F.expr(f"max(named_struct('t', t, '_first', -pos, 'frame', _own)) OVER ({_earlier('uid', 't', CLOSE_S)})")
    rows = rows.withColumn("_before", before)
    low = F.greatest(F.col("step_start_s"), F.col("t") - lookback)
    first = F.greatest(F.lit(0), F.ceil(low * fps - 1e-9), F.floor(F.col("_before.t") * fps + 1e-9) + 1, F.col("_before.frame") + 1)
    last = F.least(F.col("frame_count") - 1, F.col("contact_frame") - 1, F.floor((F.col("t") - gap) * fps + 1e-9), F.ceil(F.col("step_end_s") * fps - 1e-9) - 1)
    return rows.withColumn("previous_t", F.col("_before.t")).withColumn("first_frame", first.cast("int")).withColumn("last_frame", last.cast("int")).drop("_before", "_own")


def image_intervals(events: DataFrame, *, lookback: float = 1.0, gap: float = 0.0, fps: float = FUTURE_FPS) -> DataFrame:
    """The same for image lists: uid, start_i, end_i, contact_media_index, media_count."""
    back, least = F.greatest(F.lit(1), F.bround(F.lit(lookback * fps))), F.greatest(F.lit(1), F.ceil(F.lit(gap * fps)))
    rows = previous_index(events)
    first = F.greatest(F.lit(0), F.col("start_i"), F.col("contact_media_index") - back, F.col("previous_index") + 1)
    last = F.least(F.col("media_count") - 1, F.col("end_i"), F.col("contact_media_index") - least)
    return rows.withColumn("first_frame", first.cast("int")).withColumn("last_frame", last.cast("int"))


def observations(intervals: DataFrame, *, count: int = 3, seed: int = 0, hashed: bool = False) -> DataFrame:
    """A seeded sample of eligible frames for each event: frames between the bounds that are no contact's.

    Adds eligible (how many) and sampled (an array).  Only the number of eligible frames and the seed go to Python, whose
    generator draws places; a place becomes a frame by stepping over the contact frames before it.  hashed adds
    sampled_hash, a draw that column functions alone can make: the ``count`` frames with the smallest hash of seed and
    frame (another choice, as well mixed).
    """
    contacts = intervals.groupBy("uid").agg(F.array_sort(F.collect_set("contact_frame")).alias("_contacts"))
    inside = F.filter("_contacts", lambda c: c.between(F.col("first_frame"), F.col("last_frame")))
    rows = intervals.join(contacts, "uid").withColumn("_inside", inside).drop("_contacts")
    rows = rows.withColumn("eligible", F.greatest(F.lit(0), F.col("last_frame") - F.col("first_frame") + 1) - F.size("_inside"))
    quoted = lambda c: F.coalesce(F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2), F.lit("null"))
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    parts = F.concat(F.lit(f"[{seed},"), F.concat_ws(",", quoted("uid"), text("step_id"), quoted("event_id"), text("contact_frame"), F.col("t").cast("string")), F.lit("]"))
    frame = lambda rank: F.aggregate("_inside", F.col("first_frame") + rank, lambda f, c: f + (c <= f).cast("int"))
    out = rows.withColumn("_ranks", pyfuncs.sampled_ranks("eligible", F.lit(count), parts)).withColumn("sampled", F.transform("_ranks", frame))
    if hashed:
        free = F.array_except(int_range(F.col("first_frame"), F.col("last_frame") + 1), "_inside")
        ranked = F.array_sort(F.transform(free, lambda f: F.struct(F.xxhash64(F.lit(seed), F.col("uid"), F.col("event_id"), f).alias("h"), f.alias("f"))))
        out = out.withColumn("sampled_hash", F.array_sort(F.transform(F.slice(ranked, 1, count), lambda x: x["f"])))
    return out.drop("_inside", "_ranks")


def exploded_observations(sampled: DataFrame) -> DataFrame:
    """A row for each sampled frame with its time and the time to contact; error if another contact lies between."""
    rows = sampled.select("uid", "event_id", "t", "fps", "previous_t", "step_start_s", F.posexplode("sampled").alias("sample", "frame"))
    at = F.col("frame") / F.col("fps")
    return rows.select("uid", "event_id", "sample", "frame", F.bround(at, 6).alias("time_seconds"), F.bround(at - F.col("step_start_s"), 6).alias("clip_time_seconds"), F.bround(F.col("t") - at, 6).alias("time_to_contact_seconds"), F.when(F.col("previous_t") > at, "intervening_contact").alias("error"))


def observation_counts(requested: Column, grounded: Column) -> Column:
    """Observations that were asked for and not seen, never below zero."""
    return F.greatest(F.lit(0), requested - grounded)


def event_errors(events: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id"), require_time: bool = True) -> DataFrame:
    """Adds errors of a segment's events: ids present and unique, and a usable time or index unless rejected."""
    same = F.count("*").over(W.partitionBy(*keys, "event_id"))
    untimed = ~(finite("contact_time_seconds") & (F.col("contact_time_seconds") >= 0)) if require_time else F.col("contact_media_index").isNull() & F.col("contact_time_seconds").isNull()
    checks = (("empty_event_id", F.coalesce(F.trim("event_id"), F.lit("")) == ""), ("duplicate_event_id", (same > 1) & F.col("event_id").isNotNull()), ("invalid_contact_time", untimed & ~F.col("accepted").eqNullSafe(F.lit(False))))
    return events.withColumn("errors", F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks])))


def remap_to_view(events: DataFrame, steps: DataFrame, *, end_tolerance: float = 1.5, edge_tolerance: float = 0.5) -> DataFrame:
    """Contact times mapped to the nearest frame of another view (fps, frame_count of that view on the event).

    A frame may land in the same step, or in a neighbour if it is within the tolerance of the step's edge.
    Adds target_frame, target_s, target_step and error.
    """
    fps, n = F.col("fps"), F.col("frame_count")
    frame = F.greatest(F.lit(0), F.least(n - 1, F.bround(F.col("t") * fps))).cast("int")
    rows = events.withColumn("target_frame", frame).withColumn("target_s", F.bround(frame / fps, 6))
    from .timeline import points_in_intervals

    of = steps.select(F.col("uid"), F.col("step_id").alias("target_step"), "start_s", "end_s", F.col("pos"))
    hit = points_in_intervals(rows, of, at="target_s", how="left").drop("start_s", "end_s", "pos")
    edge = F.greatest(F.lit(edge_tolerance), 0.5 / fps + 1e-3)
    near = (F.abs(F.col("target_s") - F.col("step_start_s")) <= edge) | (F.abs(F.col("target_s") - F.col("step_end_s")) <= edge)
    neighbour = F.coalesce(F.abs(F.col("target_step").cast("int") - F.col("step_id").cast("int")) == 1, F.lit(False))
    outside = (F.col("t") < 0) | (F.col("t") > (n - 1) / fps + F.greatest(F.lit(end_tolerance), 0.5 / fps))
    return hit.withColumn("error", F.when(outside, "outside_target_view").when(~F.col("target_step").eqNullSafe(F.col("step_id")) & ~(near & neighbour), "subtask_mismatch"))
