"""Reasoning records: parsing of model answers, frame records and reviews of inventories by digest."""

from __future__ import annotations

import hashlib
import itertools
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions import pyfuncs
from annolith.functions.scalar import collapse, completion_suffix, leaked_phrase, progress_sentence, sentence

from .contracts import REVIEW_MODELS, REVIEW_POLICY, atomic_action_ok

FIELDS = ("subtask", "action", "object", "source", "target")
TOP = ("scene_description", "task_progress", "current_subtask", "atomic_action")
NOTHING_LEFT = "no further subtask remains."
PARSED = "struct<scene_description:string,task_progress:string,current_subtask:struct<subtask:string,action:string,object:string,source:string,target:string>,atomic_action:string>"
#: By which provider a review model answers.
REVIEW_PROVIDERS = {REVIEW_MODELS[0]: ("ark", "las"), REVIEW_MODELS[1]: ("ark", "las"), REVIEW_MODELS[2]: ("dashscope",)}
#: Fields that a review may change.
MUTABLE = ("objects", "task_first_object", "task_first_object_selection")


def _keys_are(text: Column, names: tuple[str, ...]) -> Column:
    return F.coalesce(F.sort_array(F.json_object_keys(text)) == F.array(*[F.lit(n) for n in sorted(names)]), F.lit(False))


def parse(answers: DataFrame, *, value: str = "value") -> DataFrame:
    """Adds parsed (a struct of PARSED) and error, the code of the first check that fails.

    Texts are collapsed; a sentence without any end mark gets a full stop; the progress takes the canonical
    ending; the step is in lower case and single; completion and an empty step go together; nothing may
    mention context that the learner does not have.
    """
    raw = F.from_json(value, PARSED)
    step = F.get_json_object(value, "$.current_subtask")
    rows = answers.withColumn("_r", raw).withColumn("_progress", progress_sentence(completion_suffix(F.coalesce(F.col("_r.task_progress"), F.lit("")))))
    rows = rows.withColumn("_scene", sentence(F.coalesce(F.col("_r.scene_description"), F.lit(""))))
    goal = collapse(F.coalesce(F.col("_r.current_subtask.subtask"), F.lit("")))
    goal = F.lower(sentence(F.when((goal != "") & ~goal.rlike("[.!?]$"), F.concat(goal, F.lit("."))).otherwise(goal)))
    part = lambda f: collapse(F.coalesce(F.col(f"_r.current_subtask.{f}"), F.lit("")))
    low = lambda c: F.when(c == "None", c).otherwise(F.lower(c))
    rows = rows.withColumn("_goal", goal).withColumn("_parts", F.struct(*[low(part(f)).alias(f) for f in FIELDS[1:]]))
    action = F.col("_r.atomic_action")
    rows = rows.withColumn("_action", collapse(F.when(action == "None", action).otherwise(F.lower(action))))
    rows = rows.withColumn("_leak", leaked_phrase(F.concat_ws(" ", "_scene", "_progress", "_goal", "_action")))
    empty = F.col("_goal") == NOTHING_LEFT
    blank = F.lit(False)
    for f in FIELDS[1:]:
        empty = empty & (F.col(f"_parts.{f}") == "None")
        blank = blank | (F.col(f"_parts.{f}") == "")
    ended = F.col("_progress").endswith("Task complete.") | F.col("_progress").endswith("Task not yet complete.")
    error = (
        F.when(~_keys_are(F.col(value), TOP), "ecot_top_level_fields_invalid")
        .when(F.col("_scene").isNull() | F.col("_progress").isNull(), "ecot_empty_text")
        .when(~ended, "ecot_completion_judgment_missing")
        .when(~_keys_are(step, FIELDS), "ecot_subtask_fields_invalid")
        .when(F.col("_goal").isNull(), "ecot_empty_text")
        .when(blank, "ecot_subtask_semantic_invalid")
        .when(F.col("_progress").endswith("Task complete.") != empty, "ecot_subtask_completion_mismatch")
        .when(F.col("_goal").rlike(r"\bthen\b|\bafter that\b|;"), "ecot_subtask_not_single_goal")
        .when(~atomic_action_ok(F.col("_action")), "ecot_atomic_action_invalid_phrase")
        .when(F.col("_leak").isNotNull(), F.concat(F.lit("ecot_privileged_context_leak:"), "_leak"))
    )
    good = F.struct(F.col("_scene").alias("scene_description"), F.col("_progress").alias("task_progress"), F.struct(F.col("_goal").alias("subtask"), *[F.col(f"_parts.{f}").alias(f) for f in FIELDS[1:]]).alias("current_subtask"), F.col("_action").alias("atomic_action"))
    out = rows.withColumn("error", error).withColumn("parsed", F.when(F.col("error").isNull(), good))
    return out.drop("_r", "_progress", "_scene", "_goal", "_parts", "_action", "_leak")


def frame_records(frames: DataFrame, question: str) -> DataFrame:
    """Learner rows of parsed frames: binding, target and the two messages."""
    content = F.to_json(F.array(F.struct(F.lit("image").alias("type"), F.col("image"), F.lit(None).cast("string").alias("text")), F.struct(F.lit("text").alias("type"), F.lit(None).cast("string").alias("image"), F.lit(question).alias("text"))))
    target = F.to_json("parsed")
    messages = F.array(F.struct(F.lit("user").alias("role"), content.alias("content")), F.struct(F.lit("assistant").alias("role"), target.alias("content")))
    return frames.where("error IS NULL").select("uid", "sampled_frame", (F.col("sampled_frame") / 2).alias("sampled_s"), "source_frame", "parsed.*", F.struct("task_instruction", "image").alias("training_input"), target.alias("training_target"), messages.alias("messages"))


def _digest(value) -> str:
    return hashlib.sha256(json.dumps(value, **pyfuncs.FORMS["sorted-compact"]).encode()).hexdigest()


def _frame_digest(frame: dict) -> str:
    return _digest({k: v for k, v in frame.items() if k not in ("inventory_review", "registered")})


def _pairs_of(review: dict, n: int) -> list[dict] | None:
    """The reviewed pairs in order, if every pair of n objects stands there once, with a decision and a reason."""
    found = {}
    for p in review.get("pairs") if isinstance(review.get("pairs"), list) else [None]:
        if not isinstance(p, dict) or not isinstance(p.get("object_indices"), list) or len(p["object_indices"]) != 2:
            return None
        key = tuple(sorted(p["object_indices"]))
        if key in found or type(p.get("distinguishable")) is not bool or not str(p.get("reason") or "").strip():
            return None
        found[key] = {"object_indices": list(key), "distinguishable": p["distinguishable"], "reason": p["reason"].strip()}
    return [found[k] for k in sorted(found)] if set(found) == set(itertools.combinations(range(n), 2)) else None


def review_holds(text: str | None, model: str | None = None) -> bool:
    """Whether a frame's review is by the present policy and model, of this very frame, and changed names only."""
    try:
        frame = json.loads(text or "")
        review = frame["inventory_review"]
        before, after, stages = review["original_frame"], review["final_frame"], review.get("stages", [])
        identity = review["policy"] == REVIEW_POLICY and review.get("provider") in REVIEW_PROVIDERS.get(review["model"], ()) and model in (None, review["model"])
        digests = review["frame_sha256"] == _frame_digest(frame) == _frame_digest(after) and review["input_frame_sha256"] == _frame_digest(before)
        rest = lambda f, names: {k: v for k, v in f.items() if k not in names}
        same = rest(before, MUTABLE) == rest(after, MUTABLE) and len(before["objects"]) == len(after["objects"])
        same = same and all(rest(a, ("name", "alternate_name")) == rest(b, ("name", "alternate_name")) for a, b in zip(before["objects"], after["objects"], strict=True))
        pairs = _pairs_of(review, len(frame["objects"]))
        if not (identity and digests and same) or pairs is None:
            return False
        if len(frame["objects"]) > 1:
            names = [s.get("stage") for s in stages]
            head = ["initial_language_review"] + (["name_correction", "post_correction_language_review"] if stages and stages[0].get("accepted") is False else [])
            language = [s for s in stages if str(s.get("stage")).endswith("language_review")]
            if names[: len(head)] != head or names[len(head) :] not in ([], ["first_object_reselection"]) or not language or language[-1].get("pairs") != pairs:
                return False
        verdict = all(p["distinguishable"] for p in pairs)
        return review["accepted"] is verdict and frame["registered"] is verdict
    except (ValueError, KeyError, TypeError, AttributeError):
        return False


def _holds(text, model):
    return str(review_holds(text, model)).lower()


def review_current(frame: Column | str, model: Column | str) -> Column:
    """Column form of ``review_holds`` over a frame's JSON."""
    return pyfuncs._typed(_holds, "string")(frame, model) == "true"


def reviewed(records: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Adds is_reviewed to records (frames: array of frame JSON, model): all frames of a uid hold; true without frames."""
    each = records.select(uid, F.explode("frames").alias("frame"), "model").withColumn("ok", review_current("frame", "model"))
    return records.join(each.groupBy(uid).agg(F.bool_and("ok").alias("_ok")), uid, "left").withColumn("is_reviewed", F.coalesce("_ok", F.lit(True))).drop("_ok")
