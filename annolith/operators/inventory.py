"""Object inventories of a frame: validation, the choice of the first object, reviews and their partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions.scalar import box_center, collapse, rounded_box, tokens

MAX_OBJECTS = 4
#: Words that name no object to ground.
FORBIDDEN = ("arm", "arms", "background", "counter", "counters", "desk", "desks", "floor", "floors", "gripper", "grippers", "hand", "hands", "human", "humans", "people", "person", "table", "tables", "wall", "walls")
NO_OBJECT = ("", "null", "none", "n/a")


def validated(objects: DataFrame, *, keys: tuple[str, ...] = ("uid", "frame")) -> DataFrame:
    """Objects (pos, name, alternate_name, color, bbox, clearly_visible) with status, reason, box and center.

    status: 'kept', 'filtered' or 'error'.  The limit counts objects before any is filtered; boxes of filtered
    objects are not looked at.  A frame with an error has it on all of its rows.
    """
    from pyspark.sql import Window as W

    whole = W.partitionBy(*keys)
    name = F.trim("name")
    box = rounded_box("bbox")
    forbidden = F.arrays_overlap(tokens(name), F.array(*[F.lit(w) for w in FORBIDDEN]))
    gone = F.when(~F.col("clearly_visible").eqNullSafe(F.lit(True)), "not_clearly_visible").when(forbidden, "forbidden_non_object_or_scene_entity")
    error = F.when(F.count("*").over(whole) > MAX_OBJECTS, "too_many_objects").when(F.coalesce(name, F.lit("")) == "", "object_invalid").when(gone.isNull() & box.isNull(), "bbox_invalid")
    rows = objects.withColumn("_gone", gone).withColumn("_own", error).withColumn("frame_error", F.max("_own").over(whole))
    return rows.select(
        *keys, "pos", name.alias("name"), F.coalesce(F.nullif(F.trim("alternate_name"), F.lit("")), name).alias("alternate_name"), F.coalesce(F.nullif(F.trim("color"), F.lit("")), F.lit("unknown")).alias("color"),
        F.when(F.col("_gone").isNull(), box).alias("box"), F.when(F.col("_gone").isNull(), box_center(box)).alias("center"),
        F.when(F.col("frame_error").isNotNull(), "error").when(F.col("_gone").isNotNull(), "filtered").otherwise("kept").alias("status"), F.coalesce("frame_error", "_gone").alias("reason"),
    )


def _phrase(c: Column) -> Column:
    return F.array_join(tokens(c), " ")


def first_object(reported: DataFrame, objects: DataFrame, *, keys: tuple[str, ...] = ("uid", "frame")) -> DataFrame:
    """The inventory object that a reported name means: chosen, or error if there is no single one.

    An equal name or alternate name counts first; else the label that contains, or is contained in, the
    reported phrase, with most shared words, then most words; both must single out one name.  The join is on
    the frame, which has at most four objects.
    """
    said = F.lower(collapse(F.coalesce("reported", F.lit(""))))
    kept = objects.select(*keys, "name", "alternate_name", "color")
    pairs = reported.withColumn("_said", said).join(kept, list(keys), "left")
    equal = (F.lower(collapse("name")) == F.col("_said")) | (F.lower(collapse("alternate_name")) == F.col("_said"))
    phrase, words = _phrase(F.col("_said")), tokens(F.col("_said"))
    labels = F.array("name", "alternate_name", F.concat_ws(" ", "color", "name"), F.concat_ws(" ", "color", "alternate_name"))
    touching = F.filter(labels, lambda x: (_phrase(x) != "") & (phrase.contains(_phrase(x)) | _phrase(x).contains(phrase)))
    score = F.array_max(F.transform(touching, lambda x: F.struct(F.size(F.array_intersect(tokens(x), words)).alias("common"), F.size(tokens(x)).alias("n"))))
    pairs = pairs.withColumn("_equal", equal).withColumn("_score", score)
    best = pairs.groupBy(*keys, "reported", "_said").agg(F.collect_set(F.when(F.col("_equal"), F.col("name"))).alias("_same"), F.max("_score").alias("_top"), F.collect_list(F.struct("_score", "name")).alias("_all"))
    loose = F.array_distinct(F.transform(F.filter("_all", lambda x: x["_score"] == F.col("_top")), lambda x: x["name"]))
    none = F.col("_said").isin(*NO_OBJECT)
    chosen = F.when(none, F.lit(None).cast("string")).when(F.size("_same") == 1, F.get("_same", F.lit(0))).when((F.size("_same") == 0) & (F.size(loose) == 1), F.get(loose, F.lit(0)))
    return best.withColumn("chosen", chosen).select(*keys, "reported", "chosen", F.when(F.col("chosen").isNull() & ~none, "not_in_inventory").alias("error"))


def all_pairs(objects: DataFrame, *, keys: tuple[str, ...] = ("uid", "frame"), index: str = "pos") -> DataFrame:
    """Every unordered pair of a frame's objects, made within the row of the frame (at most four objects)."""
    whole = objects.groupBy(*keys).agg(F.array_sort(F.collect_list(index)).alias("_o"))
    pairs = F.flatten(F.transform("_o", lambda a: F.transform(F.filter("_o", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return whole.select(*keys, F.inline(pairs))


def pair_review_errors(objects: DataFrame, reviews: DataFrame, *, keys: tuple[str, ...] = ("uid", "frame")) -> DataFrame:
    """Pairs that lack a review, have several, or are unknown."""
    from .sets import coverage_errors

    given = reviews.select(*keys, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return coverage_errors(given, all_pairs(objects, keys=keys), [*keys, "a", "b"])


def name_edit_errors(objects: DataFrame, edits: DataFrame, *, keys: tuple[str, ...] = ("uid", "frame")) -> DataFrame:
    """Edits of names (pos, name, alternate_name) against objects with editable: one for each, others unchanged."""
    e = edits.select(*keys, "pos", F.col("name").alias("_n"), F.col("alternate_name").alias("_a"))
    counts = e.groupBy(*keys, "pos").agg(F.count("*").alias("_c"), F.first("_n").alias("_n"), F.first("_a").alias("_a"))
    both = objects.withColumn("_in", F.lit(True)).join(counts, [*keys, "pos"], "full_outer")
    blank = (F.coalesce(F.trim("_n"), F.lit("")) == "") | (F.coalesce(F.trim("_a"), F.lit("")) == "")
    changed = ~F.col("editable") & ((F.col("_n") != F.col("name")) | (F.col("_a") != F.coalesce("alternate_name", "name")))
    error = F.when(F.col("_in").isNull(), "invalid_object_index").when(F.col("_c").isNull(), "incomplete_coverage").when(F.col("_c") > 1, "invalid_object_index").when(blank, "empty_name").when(changed, "changed_unaffected_object")
    return both.withColumn("error", error).where("error IS NOT NULL").select(*keys, "pos", "error")


def partitioned(frames: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Accepted and rejected frames of each record (registered, model); error unless one model reviewed them all."""
    out = frames.groupBy(uid).agg(F.count("*").alias("total_frames"), F.count_if(F.col("registered")).alias("accepted_frames"), F.count_if(~F.col("registered")).alias("rejected_frames"), F.min("model").alias("model"), F.max("model").alias("_m"))
    return out.withColumn("error", F.when(F.col("model") != F.col("_m"), "mixed_review_models")).drop("_m")


def learner_view(record: Column) -> Column:
    """A result without what only the review needs."""
    return record.dropFields("rejected_subtask_results", "inventory_review_summary")
