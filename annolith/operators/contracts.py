"""Contract checks of stage results as columns: an array with the name of every failure, repeated as often as it occurs.

Results are parsed with explicit schemas.  A field of another JSON type parses to null (a boolean is no
number, a fraction no index), which the checks treat as wrong, as a validator of the raw JSON would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions.scalar import box_center, casefold, collapse, event_name, finite, sha_pattern, valid_box

from .grids import FUTURE_FPS, FUTURE_S, TARGET_FPS, TEACHER_FPS, int_range
from .inventory import MAX_OBJECTS

#: Contract ids, versions, stages and media kinds that records carry, and, below, the names of failures.
CONTRACT_IDS = {
    "subtask": ("vqa-anno-raw-subtask/v2",),
    "ecot": ("vqa-anno-raw-ecot-privileged-teacher-0.5fps-atomic/v3", "vqa-anno-raw-ecot-privileged-2fps-atomic/v2"),
    "grd": ("vqa-anno-raw-grd-2fps-inventory-future-first-object/v3",),
    "sta": ("vqa-anno-raw-sta-cpa-final-random-event-bbox/v5",),
    "cpa": ("vqa-anno-cpa-object-only-two-decimal/v13",),
}
ECOT_SCHEMA, ECOT_SAMPLES = "privileged_video_ecot_atomic_v2", "uniform_2fps_interval"
STA_POLICY, STA_SAMPLING = "cpa_final_no_intervening_contact_random_event_bbox_v1", "cpa_final_no_intervening_contact_random_v1"
REVIEW_POLICY = "grd-inventory-review-repair-review/v2"
REVIEW_MODELS = ("doubao-seed-2-1-pro-260628", "doubao-seed-2-1-turbo-260628", "qwen3.8-max")

STEP = "struct<id:string,subtask:string,action:string,object:string,source:string,target:string,start_time_seconds:double,end_time_seconds:double>"
SUBTASK_RESULT = f"struct<subtasks:array<{STEP}>>"
REQUESTS = "array<struct<stage:string,media_kind:string,parent_cpa_result_sha256:string>>"
FIELDS = "struct<subtask:string,action:string,object:string,source:string,target:string>"
ECOT_RESULT = (
    "struct<task_instruction_source:string,ecot_interval:int,sampled_frame_count:int,ecot_sample_type:string,sampling_fps:double,"
    "annotation_contract:struct<schema:string,one_teacher_request_per_selected_frame:boolean,teacher_receives_complete_2fps_video:boolean,"
    "teacher_receives_complete_0_5fps_video:boolean,teacher_sampling_fps:double,target_sampling_fps:double,training_excludes_privileged_video:boolean>,"
    "frames:array<struct<sampled_frame_index:int,sampled_time_seconds:double,structured_ecot:string,scene_description:string,task_progress:string,"
    "current_subtask:string,atomic_action:string,messages:array<struct<role:string,content:string>>,training_input:string,training_target:string>>>"
)
FRAME = (
    "struct<media_index:int,timestamp_seconds:double,registered:boolean,objects:array<struct<name:string,bbox_xyxy_1000:array<double>,center_xy_1000:array<int>,clearly_visible:boolean>>,"
    "task_first_object:string,task_first_object_selection:struct<task_first_object:string>,inventory_review:struct<policy:string,model:string,accepted:boolean>>"
)
GRD_SEGMENT = (
    f"struct<subtask:{STEP},task_instruction_source:string,task_instruction:string,media_scope:struct<kind:string,anchor_frame_index:int,anchor_time_seconds:double,"
    "grounding_media:struct<kind:string,sampling_fps:double>,first_object_media:struct<fps:double,encoded_duration_seconds:double,maximum_future_seconds:double,anchor_fps:double>>,"
    f"result:struct<frames:array<{FRAME}>>>"
)
GRD_RESULT = f"struct<task_instruction_source:string,subtask_result_sha256:string,subtask_results:array<{GRD_SEGMENT}>,rejected_subtask_results:array<{GRD_SEGMENT}>,inventory_review_summary:struct<policy:string,model:string,total_frames:int,accepted_frames:int,rejected_frames:int>>"
OBSERVATION = "struct<bbox_xyxy_1000:array<double>,bbox_source:string,contact_frame_source:string,no_intervening_cpa_final_contact:boolean,contact_event_name:string,next_contact_noun:string,next_contact_verb:string,time_seconds:double,time_to_contact_seconds:double>"
EVENT = (
    "struct<event_id:string,accepted:boolean,contact_frame_source:string,contact_frame_selection:struct<valid_contact:boolean,requested_subtask_id:string,selected_candidate:struct<subtask_id:string>>,"
    "contact_subtask_id:string,contact_time_seconds:double,contact_event_name:string,object_name:string,contact_verb:string,"
    f"observation_sampling:struct<version:string,no_intervening_cpa_final_contact:boolean,selected_frame_count:int,grounded_observation_count:int,invisible_observation_count:int,previous_contact_time_seconds:double>,observations:array<{OBSERVATION}>>"
)
STA_SEGMENT = f"struct<subtask:{STEP},task_instruction_source:string,task_instruction:string,result:struct<contact_frame_authority:string,parent_cpa_segment_sha256:string,contact_events:array<{EVENT}>,rejected_contact_event_proposals:array<string>>>"
STA_RESULT = (
    "struct<task_instruction_source:string,subtask_result_sha256:string,contact_frame_authority:string,parent_cpa_result_sha256:string,"
    "sta_observation_policy:struct<version:string,contact_frame_authority:string,bbox_input:string,observations_per_contact:int>,"
    f"subtask_results:array<{STA_SEGMENT}>,contact_frame_summary:struct<accepted:int,rejected:int>>"
)
PARENT = f"struct<subtasks:array<{STEP}>,_source_duration_seconds:double,provider_output:struct<source_duration_seconds:double,boundary_mapping:struct<source_duration_seconds:double>>>"

Check = tuple[str, Column]


def _n(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _not(condition: Column) -> Column:
    """Not true, null included."""
    return ~F.coalesce(condition, F.lit(False))


def _many(rows: Column, condition) -> Column:
    """How many elements meet a condition; 0 for no array."""
    return F.coalesce(F.size(F.filter(rows, lambda x: F.coalesce(condition(x), F.lit(False)))), F.lit(0))


def _let(body, *steps, **have: Column) -> Column:
    """body over columns that are each computed once a row: a step names some, from those of the steps before."""
    if not steps:
        return body(**have)
    named = steps[0](**have)
    once = F.array(F.struct(*[c.alias(name) for name, c in named.items()]))
    return F.get(F.transform(once, lambda v: _let(body, *steps[1:], **have, **{name: v[name] for name in named})), F.lit(0))


def _list(checks: list[Check]) -> Column:
    return F.flatten(F.array(*[F.array_repeat(F.lit(name), n) for name, n in checks]))


def _is(c: Column, value) -> Column:
    return c.eqNullSafe(F.lit(value))


def _close(a: Column, b: Column, tolerance: float) -> Column:
    return finite(a) & finite(b) & (F.abs(a - b) <= tolerance)


def _step_signature(s: Column) -> Column:
    return F.array(*[casefold(collapse(F.coalesce(s[f], F.lit("")))) for f in ("subtask", "action", "object", "source", "target")])


def subtask_failures(result: Column) -> Column:
    steps = result["subtasks"]
    empty = F.coalesce(F.size(steps), F.lit(0)) <= 0
    repeats = F.size(F.filter(steps, lambda s, k: (k > 0) & s.isNotNull() & F.coalesce(_step_signature(s) == _step_signature(F.get(steps, k - 1)), F.lit(False))))
    return F.when(empty, F.array(F.lit("invalid_subtasks"))).otherwise(_list([("invalid_subtask", _many(steps, lambda s: s.isNull())), ("adjacent_identical_subtask", repeats)]))


def _segment_checks(segments: Column) -> list[Check]:
    return [
        ("invalid_subtask_result_entry", _many(segments, lambda s: s.isNull())),
        ("invalid_segment_subtask", _many(segments, lambda s: s.isNotNull() & s["subtask"]["id"].isNull())),
        ("empty_segment_subtask_instruction", _many(segments, lambda s: s.isNotNull() & (F.coalesce(F.trim(s["subtask"]["subtask"]), F.lit("")) == ""))),
        ("wrong_segment_instruction_source", _many(segments, lambda s: s.isNotNull() & ~_is(s["task_instruction_source"], "subtask"))),
        ("wrong_segment_task_instruction", _many(segments, lambda s: s.isNotNull() & ~s["task_instruction"].eqNullSafe(s["subtask"]["subtask"]))),
        ("invalid_segment_result", _many(segments, lambda s: s.isNotNull() & s["result"].isNull())),
    ]


def _ending(text: Column) -> Column:
    return F.coalesce(text.endswith("Task complete.") | text.endswith("Task not yet complete."), F.lit(False))


def atomic_action_ok(text: Column) -> Column:
    """'None', or a lower-case phrase of up to 240 characters without control characters."""
    t = collapse(text)
    return F.coalesce((t == "None") | ((F.lower(t) != "none") & (t != "") & (t == F.lower(t)) & (F.length(t) <= 240) & ~t.rlike(r"[\x00-\x1f]")), F.lit(False))


#: Checks of one frame, in the order in which failures are listed.
ECOT_FRAME_CHECKS = (
    "invalid_ecot_frame_index", "ecot_frame_time_index_mismatch", "invalid_structured_ecot", "ecot_scene_description_mismatch", "invalid_ecot_atomic_action", "ecot_task_progress_mismatch",
    "ecot_current_subtask_mismatch", "ecot_atomic_action_mismatch", "invalid_ecot_training_messages", "ecot_training_message_target_mismatch", "invalid_ecot_training_message_target",
    "ecot_training_message_input_mismatch", "invalid_ecot_task_progress", "invalid_ecot_current_subtask", "ecot_training_input_leaks_or_is_invalid", "ecot_training_target_mismatch",
)


def _ecot_frame_checks(f: Column) -> Column:
    """A struct that says for each check whether a frame fails; every JSON text is parsed once."""
    names, fields, inputs = (F.array(*map(F.lit, sorted(x))) for x in (("atomic_action", "current_subtask", "scene_description", "task_progress"), ("subtask", "action", "object", "source", "target"), ("image", "task_instruction")))
    keys = lambda text: F.sort_array(F.json_object_keys(text))
    canonical = lambda text: F.from_json(text, f"struct<scene_description:string,task_progress:string,current_subtask:{FIELDS},atomic_action:string>")
    turn = lambda k: F.get(f["messages"], F.lit(k))
    index_ok = F.coalesce(f["sampled_frame_index"] >= 0, F.lit(False))
    assistant = _is(turn(1)["role"], "assistant")

    def read() -> dict[str, Column]:
        return {
            "whole": F.coalesce(keys(f["structured_ecot"]) == names, F.lit(False)),
            **{name: F.get_json_object(f["structured_ecot"], f"$.{name}") for name in ("scene_description", "task_progress", "current_subtask", "atomic_action")},
            "content": F.from_json(turn(0)["content"], "array<struct<type:string,image:string,text:string>>"),
            "ecot": canonical(f["structured_ecot"]),
            "two": F.coalesce(F.size(f["messages"]) == 2, F.lit(False)),
            # What cannot be read ends the look at the messages: a role or content that is missing, an answer that is no JSON.
            "no_target": turn(1)["role"].isNull() | (assistant & F.try_parse_json(turn(1)["content"]).isNull()),
            "no_input": turn(0)["content"].isNull() | turn(0)["role"].isNull(),
        }

    def checks(whole, scene_description, task_progress, current_subtask, atomic_action, content, ecot, two, no_target, no_input) -> Column:
        part = lambda k: F.get(content, F.lit(k))
        target_ok = assistant & canonical(turn(1)["content"]).eqNullSafe(ecot)
        types = F.transform(content, lambda x: x["type"])
        input_ok = _is(turn(0)["role"], "user") & F.coalesce(types == F.array(F.lit("image"), F.lit("text")), F.lit(False)) & part(0)["image"].eqNullSafe(F.get_json_object(f["training_input"], "$.image")) & F.coalesce(part(1)["text"].contains("atomic_action"), F.lit(False))
        failed = {
            "invalid_ecot_frame_index": ~index_ok,
            "ecot_frame_time_index_mismatch": index_ok & _not(_close(f["sampled_time_seconds"], f["sampled_frame_index"] / TARGET_FPS, 1e-6)),
            "invalid_structured_ecot": ~whole,
            "ecot_scene_description_mismatch": whole & ~f["scene_description"].eqNullSafe(scene_description),
            "invalid_ecot_atomic_action": whole & ~atomic_action_ok(atomic_action),
            "ecot_task_progress_mismatch": whole & ~f["task_progress"].eqNullSafe(task_progress),
            "ecot_current_subtask_mismatch": whole & ~f["current_subtask"].eqNullSafe(current_subtask),
            "ecot_atomic_action_mismatch": whole & ~f["atomic_action"].eqNullSafe(atomic_action),
            "invalid_ecot_training_messages": whole & ~two,
            "ecot_training_message_target_mismatch": whole & two & ~no_target & ~target_ok,
            "invalid_ecot_training_message_target": whole & two & (no_target | no_input),
            "ecot_training_message_input_mismatch": whole & two & ~no_target & ~no_input & ~input_ok,
            "invalid_ecot_task_progress": whole & ~_ending(task_progress),
            "invalid_ecot_current_subtask": whole & _not(keys(current_subtask) == fields),
            "ecot_training_input_leaks_or_is_invalid": whole & _not(keys(f["training_input"]) == inputs),
            "ecot_training_target_mismatch": whole & ~canonical(f["training_target"]).eqNullSafe(ecot),
        }
        return F.struct(*[failed[name].alias(name) for name in ECOT_FRAME_CHECKS])

    return _let(checks, read)


def ecot_failures(result: Column, requests: Column) -> Column:
    r, c, frames = result, result["annotation_contract"], result["frames"]
    common = _is(c["schema"], ECOT_SCHEMA) & _is(c["one_teacher_request_per_selected_frame"], True) & _is(c["training_excludes_privileged_video"], True)
    legacy = F.coalesce(common & _is(c["teacher_receives_complete_2fps_video"], True), F.lit(False))
    current = F.coalesce(common & _is(c["teacher_receives_complete_0_5fps_video"], True) & _is(c["teacher_sampling_fps"], TEACHER_FPS) & _is(c["target_sampling_fps"], TARGET_FPS), F.lit(False))
    interval = F.when(r["ecot_interval"] >= 1, r["ecot_interval"]).otherwise(F.lit(1))
    count = F.when(r["sampled_frame_count"] >= 1, r["sampled_frame_count"]).otherwise(F.lit(0))
    expected = F.filter(int_range(F.lit(0), count), lambda i: i % interval == 0)
    real = F.filter(frames, lambda f: f.isNotNull())
    index_ok = lambda f: F.coalesce(f["sampled_frame_index"] >= 0, F.lit(False))
    actual = F.transform(F.filter(real, index_ok), lambda f: f["sampled_frame_index"])
    teacher = F.filter(requests, lambda q: _is(q["stage"], "privileged_complete_video_ecot"))
    kind = F.when(legacy, "complete_2fps_episode_video_plus_target_image").otherwise("complete_0.5fps_episode_video_plus_target_image")
    before: list[Check] = [
        ("wrong_ecot_instruction_source", _n(~_is(r["task_instruction_source"], "global_task"))),
        ("wrong_ecot_sample_type", _n(~_is(r["ecot_sample_type"], ECOT_SAMPLES))),
        ("wrong_ecot_sampling_fps", _n(~_is(r["sampling_fps"], TARGET_FPS))),
        ("invalid_ecot_interval", _n(_not(r["ecot_interval"] >= 1))),
        ("invalid_ecot_sampled_frame_count", _n(_not(r["sampled_frame_count"] >= 1))),
        ("invalid_ecot_annotation_contract", _n(~(legacy | current))),
    ]
    after = lambda found: [
        ("invalid_ecot_frame", _many(frames, lambda f: f.isNull())),
        *[(name, _many(found, lambda f, name=name: f[name])) for name in ECOT_FRAME_CHECKS],
        ("ecot_frame_selection_coverage_mismatch", _n(actual != expected)),
        ("invalid_request_audit_list", _n(requests.isNull())),
        ("ecot_request_count_mismatch", _n(F.size(teacher) != F.size(frames))),
        ("wrong_ecot_request_media_kind", _n(F.exists(teacher, lambda q: ~q["media_kind"].eqNullSafe(kind)))),
    ]
    return F.when(frames.isNull(), _list([*before, ("invalid_ecot_frames", F.lit(1))])).otherwise(_let(lambda found: _list(before + after(found)), lambda: {"found": F.transform(real, _ecot_frame_checks)}))


def parent_duration(parent: Column) -> Column:
    options = F.array(parent["_source_duration_seconds"], parent["provider_output"]["source_duration_seconds"], parent["provider_output"]["boundary_mapping"]["source_duration_seconds"])
    return F.get(F.filter(options, lambda x: finite(x) & (x > 0)), F.lit(0))


def expected_anchors(steps: Column, duration: Column, fps: float = TARGET_FPS) -> Column:
    """(id, frame) of every tick inside the steps, as an array."""

    def of(s: Column) -> Column:
        stop = F.least(s["end_time_seconds"], F.coalesce(duration, s["end_time_seconds"]))
        ticks = int_range(F.greatest(F.lit(0), F.ceil(s["start_time_seconds"] * fps - 1e-9)), F.ceil(stop * fps - 1e-9))
        return F.transform(F.filter(ticks, lambda i: i / fps < stop), lambda i: F.struct(s["id"].alias("id"), i.alias("frame")))

    return F.flatten(F.transform(steps, of))


def grd_failures(result: Column, requests: Column, parent: Column) -> Column:
    r, summary, accepted = result, result["inventory_review_summary"], result["subtask_results"]
    reviewed = summary.isNotNull()
    rejected = F.when(reviewed, F.coalesce(r["rejected_subtask_results"], F.array().cast(f"array<{GRD_SEGMENT}>"))).otherwise(F.array().cast(f"array<{GRD_SEGMENT}>"))
    current = lambda s, want: F.coalesce((F.size(s["result"]["frames"]) == 1) & _is(F.get(s["result"]["frames"], F.lit(0))["registered"], want) & _is(F.get(s["result"]["frames"], F.lit(0))["inventory_review"]["policy"], REVIEW_POLICY) & F.get(s["result"]["frames"], F.lit(0))["inventory_review"]["model"].eqNullSafe(summary["model"]) & _is(F.get(s["result"]["frames"], F.lit(0))["inventory_review"]["accepted"], want), F.lit(False))
    good_summary = lambda segments: _is(summary["policy"], REVIEW_POLICY) & (summary["total_frames"] == F.size(segments)) & (summary["accepted_frames"] == F.size(accepted)) & (summary["rejected_frames"] == F.size(rejected))
    scope = lambda s: s["media_scope"]
    scoped = lambda s: _is(scope(s)["kind"], "grounding_frame")
    index = lambda s: F.when(scoped(s), scope(s)["anchor_frame_index"])
    time = lambda s: F.when(scoped(s), scope(s)["anchor_time_seconds"])
    still = lambda s: F.when(scoped(s), _is(scope(s)["grounding_media"]["kind"], "single_current_image") & _is(scope(s)["grounding_media"]["sampling_fps"], TARGET_FPS))
    clip = lambda s: F.when(scoped(s), _is(scope(s)["first_object_media"]["fps"], FUTURE_FPS) & _is(scope(s)["first_object_media"]["encoded_duration_seconds"], FUTURE_S) & _is(scope(s)["first_object_media"]["maximum_future_seconds"], FUTURE_S) & _is(scope(s)["first_object_media"]["anchor_fps"], TARGET_FPS))
    one = lambda s: F.coalesce((F.size(s["result"]["frames"]) == 1) & F.get(s["result"]["frames"], F.lit(0)).isNotNull(), F.lit(False))
    frame = lambda s: F.get(s["result"]["frames"], F.lit(0))
    objects_of = lambda single: F.flatten(F.transform(single, lambda s: F.coalesce(frame(s)["objects"], F.array().cast("array<struct<name:string,bbox_xyxy_1000:array<double>,center_xy_1000:array<int>,clearly_visible:boolean>>"))))
    named = lambda o: F.coalesce(F.trim(o["name"]) != "", F.lit(False))
    names = lambda s: F.transform(F.filter(F.coalesce(frame(s)["objects"], F.array().cast("array<struct<name:string,bbox_xyxy_1000:array<double>,center_xy_1000:array<int>,clearly_visible:boolean>>")), named), lambda o: F.trim(o["name"]))
    chosen = lambda s: frame(s)["task_first_object"]
    found_in = lambda segments: F.transform(F.filter(segments, lambda s: s["subtask"]["id"].isNotNull() & index(s).isNotNull()), lambda s: F.struct(s["subtask"]["id"].alias("id"), index(s).alias("frame")))
    observed = lambda segments: F.transform(F.filter(segments, lambda s: s["subtask"]["id"].isNotNull()), lambda s: s["subtask"])
    steps_of = lambda segments: F.when(F.coalesce(F.size(parent["subtasks"]), F.lit(0)) > 0, parent["subtasks"]).otherwise(observed(segments))
    timed = lambda steps: (F.size(steps) > 0) & F.forall(steps, lambda s: finite(s["start_time_seconds"]) & finite(s["end_time_seconds"]))
    covers = lambda found, wanted: (F.size(F.array_except(wanted, found)) == 0) & (F.size(F.array_except(found, wanted)) == 0)
    now = F.filter(requests, lambda q: _is(q["stage"], "current_frame_inventory"))
    later = F.filter(requests, lambda q: _is(q["stage"], "future_first_object_selection"))
    before: list[Check] = [("wrong_result_instruction_source", _n(~_is(r["task_instruction_source"], "subtask"))), ("invalid_subtask_result_hash", _n(~sha_pattern(r["subtask_result_sha256"])))]
    after = lambda segments, single, found, steps, objects, wanted, real: [
        ("invalid_grd_review_model", _n(reviewed & _not(summary["model"].isin(*REVIEW_MODELS)))),
        ("invalid_grd_rejected_segments", _n(reviewed & r["rejected_subtask_results"].isNull())),
        ("invalid_grd_inventory_review", F.when(reviewed, _many(accepted, lambda s: ~current(s, True)) + _many(rejected, lambda s: ~current(s, False))).otherwise(0)),
        ("invalid_grd_review_summary", _n(reviewed & _not(good_summary(segments)))),
        ("empty_subtask_results", _n(F.size(segments) == 0)),
        *_segment_checks(segments),
        ("invalid_grd_media_scope", _many(segments, lambda s: ~scoped(s))),
        ("invalid_grd_current_image_contract", _many(segments, lambda s: _not(still(s)))),
        ("invalid_grd_future_video_contract", _many(segments, lambda s: _not(clip(s)))),
        ("invalid_grd_anchor_index", _many(segments, lambda s: _not(index(s) >= 0))),
        ("invalid_grd_anchor_time", _many(segments, lambda s: _not(finite(time(s)) & (time(s) >= 0)))),
        ("grd_anchor_time_index_mismatch", _many(segments, lambda s: index(s).isNotNull() & finite(time(s)) & (F.abs(time(s) - index(s) / TARGET_FPS) > 1e-6))),
        ("grd_requires_exactly_one_output_frame", _many(segments, lambda s: ~one(s))),
        ("grd_frame_anchor_index_mismatch", _many(single, lambda s: ~frame(s)["media_index"].eqNullSafe(index(s)))),
        ("grd_frame_anchor_time_mismatch", _many(single, lambda s: _not(_close(frame(s)["timestamp_seconds"], time(s), 1e-6)))),
        ("invalid_grd_inventory", _many(single, lambda s: frame(s)["objects"].isNull())),
        ("grd_inventory_over_four_objects", _many(single, lambda s: F.size(frame(s)["objects"]) > MAX_OBJECTS)),
        ("invalid_grd_inventory_object", _many(objects, lambda o: ~named(o))),
        ("invalid_grd_inventory_bbox", _many(real, lambda o: ~valid_box(o["bbox_xyxy_1000"]))),
        ("invalid_grd_inventory_center", _many(real, lambda o: valid_box(o["bbox_xyxy_1000"]) & ~o["center_xy_1000"].eqNullSafe(box_center(o["bbox_xyxy_1000"])))),
        ("grd_inventory_contains_nonvisible_object", _many(real, lambda o: ~_is(o["clearly_visible"], True))),
        ("grd_first_object_not_in_inventory", _many(single, lambda s: chosen(s).isNotNull() & ~F.array_contains(names(s), chosen(s)))),
        ("invalid_grd_first_object_selection", _many(single, lambda s: frame(s)["task_first_object_selection"].isNull() | ~frame(s)["task_first_object_selection"]["task_first_object"].eqNullSafe(chosen(s)))),
        ("duplicate_grd_anchor", _n(F.size(found) != F.size(F.array_distinct(found)))),
        ("grd_anchor_coverage_mismatch", _n(timed(steps) & ~covers(found, wanted))),
        ("invalid_request_audit_list", _n(requests.isNull())),
        ("grd_current_request_count_mismatch", _n(F.size(now) != F.size(segments))),
        ("grd_future_request_count_mismatch", _n(F.size(later) != F.size(segments))),
        ("wrong_grd_current_request_media_kind", _n(F.exists(now, lambda q: ~_is(q["media_kind"], "single_current_image")))),
        ("wrong_grd_future_request_media_kind", _n(F.exists(later, lambda q: ~_is(q["media_kind"], "future_video_3fps_4s")))),
    ]
    bound = [
        lambda: {"segments": F.concat(accepted, rejected)},
        lambda segments: {"single": F.filter(segments, one), "found": found_in(segments), "steps": steps_of(segments)},
        lambda segments, single, found, steps: {"objects": objects_of(single), "wanted": F.array_distinct(expected_anchors(steps, parent_duration(parent)))},
        lambda objects, **_: {"real": F.filter(objects, named)},
    ]
    return F.when(accepted.isNull(), _list([*before, ("invalid_subtask_results", F.lit(1))])).otherwise(_let(lambda **c: _list(before + after(**c)), *bound))


def sta_failures(result: Column, requests: Column, parent: Column) -> Column:
    r, p, segments = result, result["sta_observation_policy"], result["subtask_results"]
    policy_ok = _is(p["version"], STA_POLICY) & _is(p["contact_frame_authority"], "cpa_final") & _is(p["bbox_input"], "single_observation_image_plus_contact_event_name") & F.coalesce(p["observations_per_contact"] >= 1, F.lit(False))
    no_events = F.array().cast(f"array<{EVENT}>")
    events_of = lambda s: F.coalesce(s["result"]["contact_events"], no_events)
    tagged_of = lambda: F.flatten(F.transform(segments, lambda s: F.transform(events_of(s), lambda e: F.struct(s["subtask"]["id"].alias("step"), e.alias("e")))))
    ident = lambda e: F.coalesce(e["event_id"], F.lit(""))
    ids = lambda s: F.transform(F.filter(events_of(s), lambda e: e.isNotNull()), ident)
    bad_ids = F.coalesce(F.aggregate(F.transform(segments, lambda s: F.size(ids(s)) - F.size(F.filter(F.array_distinct(ids(s)), lambda i: i != ""))), F.lit(0), lambda a, b: a + b), F.lit(0))
    sampling = lambda x: x["e"]["observation_sampling"]
    sampled = lambda x: _is(sampling(x)["version"], STA_SAMPLING) & _is(sampling(x)["no_intervening_cpa_final_contact"], True)
    chosen = lambda x: x["e"]["contact_frame_selection"]
    valid = lambda x: _is(chosen(x)["valid_contact"], True)
    step = lambda x: F.coalesce(x["step"], F.lit("None"))
    no_obs = F.array().cast(f"array<{OBSERVATION}>")
    observed_of = lambda real: F.flatten(F.transform(real, lambda x: F.transform(F.coalesce(x["e"]["observations"], no_obs), lambda o: F.struct(x["e"].alias("e"), sampled(x).alias("ok"), o.alias("o")))))
    when, contact = (lambda y: y["o"]["time_seconds"]), (lambda y: y["e"]["contact_time_seconds"])
    timed = lambda y: finite(when(y)) & finite(contact(y))
    previous = lambda y: F.when(y["ok"], y["e"]["observation_sampling"]["previous_contact_time_seconds"])
    counts = lambda x: [F.when(sampled(x), sampling(x)[f]) for f in ("selected_frame_count", "grounded_observation_count", "invisible_observation_count")]
    count_ok = lambda x: (counts(x)[0] >= 0) & (counts(x)[1] >= 0) & (counts(x)[2] >= 0) & (counts(x)[1] == F.size(F.coalesce(x["e"]["observations"], no_obs))) & (counts(x)[1] + counts(x)[2] == counts(x)[0])
    times_of = lambda real: F.transform(F.filter(real, lambda x: finite(x["e"]["contact_time_seconds"])), lambda x: x["e"]["contact_time_seconds"])
    before_t = lambda x, times: F.array_max(F.filter(times, lambda t: t < x["e"]["contact_time_seconds"] - 1e-9))
    said = lambda x: sampling(x)["previous_contact_time_seconds"]
    wrong_previous = lambda x, times: finite(x["e"]["contact_time_seconds"]) & _let(lambda last: F.when(last.isNull(), said(x).isNotNull()).otherwise(_not(_close(said(x), last, 2e-6))), lambda: {"last": before_t(x, times)})
    rejected_total = F.coalesce(F.aggregate(F.transform(segments, lambda s: F.coalesce(F.size(s["result"]["rejected_contact_event_proposals"]), F.lit(0))), F.lit(0), lambda a, b: a + F.greatest(b, F.lit(0))), F.lit(0))
    selected_total = lambda real: F.coalesce(F.aggregate(F.transform(real, lambda x: F.coalesce(sampling(x)["selected_frame_count"], F.lit(0))), F.lit(0), lambda a, b: a + b), F.lit(0))
    parent_ids = F.transform(parent["subtasks"], lambda s: F.coalesce(s["id"], F.lit("None")))
    segment_ids = F.transform(segments, lambda s: F.coalesce(s["subtask"]["id"], F.lit("None")))
    sync = F.filter(requests, lambda q: _is(q["stage"], "cpa_final_random_sta_observation_sync"))
    boxes = F.filter(requests, lambda q: _is(q["stage"], "cpa_final_random_observation_bbox"))
    before: list[Check] = [
        ("wrong_result_instruction_source", _n(~_is(r["task_instruction_source"], "subtask"))),
        ("invalid_subtask_result_hash", _n(~sha_pattern(r["subtask_result_sha256"]))),
        ("sta_contact_frame_not_cpa_final", _n(~_is(r["contact_frame_authority"], "cpa_final"))),
        ("invalid_sta_parent_cpa_hash", _n(~sha_pattern(r["parent_cpa_result_sha256"]))),
        ("invalid_sta_observation_policy", _n(_not(policy_ok))),
    ]

    def after(tagged: Column, real: Column, observed: Column, times: Column, seen: Column) -> list[Check]:
        obs = lambda name, bad: (name, _many(seen, bad))
        return [
            ("empty_subtask_results", _n(F.size(segments) == 0)),
            *_segment_checks(segments),
            ("sta_segment_contact_frame_not_cpa_final", _many(segments, lambda s: ~_is(s["result"]["contact_frame_authority"], "cpa_final"))),
            ("invalid_sta_parent_cpa_segment_hash", _many(segments, lambda s: ~sha_pattern(s["result"]["parent_cpa_segment_sha256"]))),
            ("invalid_sta_contact_events", _many(segments, lambda s: s["result"]["contact_events"].isNull())),
            ("invalid_sta_rejected_contact_events", _many(segments, lambda s: s["result"]["rejected_contact_event_proposals"].isNull())),
            ("invalid_sta_contact_event", _many(tagged, lambda x: x["e"].isNull())),
            ("invalid_or_duplicate_sta_event_id", bad_ids),
            ("sta_contains_nonaccepted_contact_event", _many(real, lambda x: ~_is(x["e"]["accepted"], True))),
            ("sta_event_contact_frame_not_cpa_final", _many(real, lambda x: ~_is(x["e"]["contact_frame_source"], "cpa_final"))),
            ("invalid_sta_contact_frame_selection", _many(real, lambda x: ~valid(x))),
            ("sta_requested_subtask_mismatch", _many(real, lambda x: valid(x) & ~F.coalesce(chosen(x)["requested_subtask_id"], F.lit("None")).eqNullSafe(step(x)))),
            ("sta_selected_subtask_mismatch", _many(real, lambda x: valid(x) & (chosen(x)["selected_candidate"].isNull() | ~F.coalesce(chosen(x)["selected_candidate"]["subtask_id"], F.lit("None")).eqNullSafe(step(x))))),
            ("sta_contact_subtask_mismatch", _many(real, lambda x: ~F.coalesce(x["e"]["contact_subtask_id"], F.lit("None")).eqNullSafe(step(x)))),
            ("invalid_sta_contact_time", _many(real, lambda x: ~finite(x["e"]["contact_time_seconds"]))),
            ("wrong_sta_contact_event_name", _many(real, lambda x: ~x["e"]["contact_event_name"].eqNullSafe(event_name(x["e"]["contact_verb"], x["e"]["object_name"])))),
            ("invalid_sta_observation_sampling", _many(real, lambda x: _not(sampled(x)))),
            ("invalid_sta_observations", _many(real, lambda x: x["e"]["observations"].isNull())),
            ("sta_observation_count_mismatch", _many(real, lambda x: _not(count_ok(x)))),
            ("invalid_sta_observation", _many(observed, lambda y: y["o"].isNull())),
            obs("invalid_sta_observation_bbox", lambda y: ~valid_box(y["o"]["bbox_xyxy_1000"])),
            obs("wrong_sta_bbox_source", lambda y: ~_is(y["o"]["bbox_source"], "single_image_vlm_event_name_grounding")),
            obs("sta_observation_contact_frame_not_cpa_final", lambda y: ~_is(y["o"]["contact_frame_source"], "cpa_final")),
            obs("sta_observation_allows_intervening_contact", lambda y: ~_is(y["o"]["no_intervening_cpa_final_contact"], True)),
            obs("sta_observation_event_name_mismatch", lambda y: ~y["o"]["contact_event_name"].eqNullSafe(y["e"]["contact_event_name"])),
            obs("sta_observation_noun_mismatch", lambda y: ~y["o"]["next_contact_noun"].eqNullSafe(y["e"]["object_name"])),
            obs("sta_observation_verb_mismatch", lambda y: ~y["o"]["next_contact_verb"].eqNullSafe(y["e"]["contact_verb"])),
            obs("sta_observation_not_before_contact", lambda y: timed(y) & (when(y) >= contact(y))),
            obs("sta_observation_not_after_previous_contact", lambda y: timed(y) & finite(previous(y)) & (when(y) <= previous(y))),
            obs("sta_observation_ttc_mismatch", lambda y: timed(y) & _not(_close(y["o"]["time_to_contact_seconds"], contact(y) - when(y), 2e-6))),
            ("sta_subtask_segment_coverage_mismatch", _n((F.size(parent_ids) > 0) & (segment_ids != parent_ids))),
            ("sta_contact_frame_summary_mismatch", _n(_not((r["contact_frame_summary"]["accepted"] == F.size(real)) & (r["contact_frame_summary"]["rejected"] == rejected_total)))),
            ("sta_previous_contact_mismatch", _many(real, lambda x: wrong_previous(x, times))),
            ("invalid_request_audit_list", _n(requests.isNull())),
            ("invalid_sta_cpa_sync_request", _n(requests.isNotNull() & _not((F.size(sync) == 1) & F.get(sync, F.lit(0))["parent_cpa_result_sha256"].eqNullSafe(r["parent_cpa_result_sha256"])))),
            ("sta_bbox_request_count_mismatch", _n(F.size(boxes) != selected_total(real))),
            ("wrong_sta_bbox_request_media_kind", _n(F.exists(boxes, lambda q: ~_is(q["media_kind"], "single_random_pre_contact_image")))),
        ]

    bound = [
        lambda: {"tagged": tagged_of()},
        lambda tagged: {"real": F.filter(tagged, lambda x: x["e"].isNotNull())},
        lambda tagged, real: {"observed": observed_of(real), "times": times_of(real)},
        lambda observed, **_: {"seen": F.filter(observed, lambda y: y["o"].isNotNull())},
    ]
    return F.when(segments.isNull(), _list([*before, ("invalid_subtask_results", F.lit(1))])).otherwise(_let(lambda **c: _list(before + after(**c)), *bound))


def _once(rows: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once a row.

    As the output of a generator they are out of reach for the optimizer, which else puts their expressions in place of
    each use in a later filter; exploding an array adds such a filter.
    """
    return rows.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def failures(task: str, rows: DataFrame, *, result: str = "result", requests: str = "requests", parent: str | None = None) -> DataFrame:
    """Adds failures for rows whose result and requests (and perhaps the parent's steps) are JSON text.

    Every object passes for 'cpa', which has no result contract.  The parsed columns are dropped again.
    """
    schema = {"subtask": SUBTASK_RESULT, "ecot": ECOT_RESULT, "grd": GRD_RESULT, "sta": STA_RESULT}.get(task)
    missing = F.array(F.lit("missing_result"))
    is_object = F.coalesce(F.ltrim(F.col(result)).startswith("{"), F.lit(False))
    if schema is None:
        return rows.withColumn("failures", F.when(is_object, F.array().cast("array<string>")).otherwise(missing))
    parsed = _once(rows, _o=is_object, _r=F.from_json(result, schema), _q=F.from_json(requests, REQUESTS), _p=F.from_json(F.col(parent) if parent else F.lit(None).cast("string"), PARENT))
    r, q, p = F.col("_r"), F.col("_q"), F.col("_p")
    found = {"subtask": lambda: subtask_failures(r), "ecot": lambda: ecot_failures(r, q), "grd": lambda: grd_failures(r, q, p), "sta": lambda: sta_failures(r, q, p)}[task]()
    return _once(parsed.drop("failures"), failures=F.when(F.col("_o") & r.isNotNull(), found).otherwise(missing)).drop("_o", "_r", "_q", "_p")
