"""Reuse of earlier stages: which record serves a source, what of it is still valid, and exact contact frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions.scalar import primary_uid, rounded_box

from .sets import coverage_errors, keep_first

#: Where a record may lie, in the order in which places count.
PLACES = ("exact", "width", "cache", "pack")


def located(sources: DataFrame, stored: DataFrame, *, uid: str = "uid") -> DataFrame:
    """For each source (uid, subtask_sha) the record to reuse, by its uid or its primary view's; else the last error.

    stored: uid, place, record, contract_ok, authority, subtask_sha.  One equi-join and a minimum; no probing
    of paths.  Of valid records the first place counts, then the smallest digest.
    """
    of = stored.select(F.col(uid).alias("_key"), "place", "record", "contract_ok", "authority", F.col("subtask_sha").alias("_sha"))
    joined = sources.withColumn("_key", primary_uid(uid)).join(of, "_key", "left")
    error = F.when(F.col("record").isNull(), "not_found").when(~F.coalesce("contract_ok", F.lit(False)), "contract_invalid").when(~F.col("authority").eqNullSafe(F.lit("cpa_final")), "wrong_authority").when(~F.col("_sha").eqNullSafe(F.col("subtask_sha")), "subtask_differs")
    rank = F.struct(error.isNotNull().alias("bad"), F.coalesce(F.array_position(F.array(*[F.lit(p) for p in PLACES]), F.col("place")), F.lit(99)).alias("place"), F.sha2(F.coalesce("record", F.lit("")), 256).alias("sha"))
    best = joined.withColumn("_error", error).groupBy(uid).agg(F.min_by(F.struct("record", "place", F.col("_error").alias("error")), rank).alias("_b"))
    return best.select(uid, F.when(F.col("_b.error").isNull(), F.col("_b.record")).alias("record"), "_b.place", "_b.error", (F.col(uid) == primary_uid(uid)).alias("primary_view"))


def seed(events: DataFrame, responses: DataFrame, steps: DataFrame, *, keys: tuple[str, ...] = ("uid", "step_id")) -> tuple[DataFrame, DataFrame]:
    """(events with the box that a recorded response gives back, errors where the steps of both sides differ)."""
    box = responses.select(*keys, "event_id", rounded_box("bbox").alias("box")).where("box IS NOT NULL")
    box = keep_first(box, [*keys, "event_id"], F.to_json(F.struct("box")))
    return events.join(box, [*keys, "event_id"], "left"), coverage_errors(events.select(*keys).distinct(), steps, list(keys))


def exact_frames(selections: DataFrame) -> DataFrame:
    """Adds valid and reason: the chosen candidate must exist and agree with the requested and the answered step.

    selections: candidates (array of struct<media_index, subtask_id, source_frame>), selected_index,
    requested_step, answered_step, says_valid.
    """
    chosen = F.get(F.filter("candidates", lambda c: c["media_index"] == F.col("selected_index")), F.lit(0))
    rows = selections.withColumn("_c", chosen)
    step = F.col("_c.subtask_id").cast("string")
    reason = (
        F.when(~F.col("says_valid").eqNullSafe(F.lit(True)), "not_valid_contact")
        .when(F.col("_c").isNull(), "selected_index_invalid")
        .when(~step.eqNullSafe(F.col("requested_step").cast("string")), "candidate_in_other_step")
        .when(~F.col("answered_step").cast("string").eqNullSafe(F.col("requested_step").cast("string")), "answer_names_other_step")
    )
    return rows.withColumn("reason", reason).withColumn("valid", F.col("reason").isNull()).withColumn("contact_frame", F.when(F.col("valid"), F.col("_c.source_frame"))).drop("_c")


def observation_boxes(answers: DataFrame) -> DataFrame:
    """Adds box and error: an object said to be invisible has neither; else four finite numbers, rounded."""
    hidden = F.col("target_visible").eqNullSafe(F.lit(False))
    box = F.when(~hidden, rounded_box("bbox"))
    return answers.withColumn("box", box).withColumn("error", F.when(~hidden & F.col("box").isNull(), "sta_bbox_invalid"))


def regrouped(observations: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id"), order: str = "sample") -> DataFrame:
    """Answers back in the order in which they were asked, one array for each event, with the counts."""
    rows = observations.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(F.col("box").isNotNull(), F.struct(order, "frame", "box")))).alias("observations"), F.count("*").alias("selected"))
    return rows.withColumn("grounded", F.size("observations")).withColumn("invisible", F.greatest(F.lit(0), F.col("selected") - F.col("grounded")))


def owner_hours(assigned: DataFrame, *, owner: str = "owner", nanoseconds: str = "duration_ns") -> DataFrame:
    """Episodes and hours of each owner."""
    return assigned.groupBy(owner).agg(F.count("*").alias("episodes"), (F.sum(nanoseconds) / 3.6e12).alias("hours"))


def generation_manifest(master: DataFrame, available: DataFrame, completed: DataFrame, excluded: DataFrame, eligible: DataFrame, scheduled: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Sizes of the sets of one scheduling round, one row for each."""
    out = None
    for name, frame in (("master", master), ("available", available), ("completed", completed), ("excluded", excluded), ("eligible", eligible), ("scheduled", scheduled)):
        row = frame.agg(F.count_distinct(uid).alias("n")).select(F.lit(name).alias("figure"), "n")
        out = row if out is None else out.unionByName(row)
    return out


def exhausted(attempts: DataFrame, limit: int) -> DataFrame:
    """uids out of attempts, to be excluded from the next round."""
    return attempts.where(F.col("attempts") >= limit)


def rebalanced(assigned: DataFrame, done: DataFrame, donor: str, owners: list[str], *, uid: str = "uid", size: str = "size") -> DataFrame:
    """What the donor has not finished, split anew over some owners."""
    from .sets import longest_first_split

    left = assigned.where(F.col("owner") == donor).join(done.select(uid).distinct(), uid, "left_anti").drop("owner")
    return longest_first_split(left, owners, uid=uid, size=size)


def latest_first(rows: DataFrame, *, key: str, order: str, n: int) -> DataFrame:
    """The n latest rows of each key."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))).where(F.col("_n") <= n).drop("_n")
