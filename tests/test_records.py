import copy
import json

import pytest

from annolith.operators import contracts, records

STEP = {"id": 1, "subtask": "pick", "start_time_seconds": 0.0, "end_time_seconds": 1.0}


def grd():
    def segment(i):
        frame = {"media_index": i, "timestamp_seconds": i / 2, "objects": [{"name": "cup", "bbox_xyxy_1000": [0, 0, 11, 10], "center_xy_1000": [6, 5], "clearly_visible": True}], "task_first_object": "cup", "task_first_object_selection": {"task_first_object": "cup"}}
        scope = {"kind": "grounding_frame", "anchor_frame_index": i, "anchor_time_seconds": i / 2, "grounding_media": {"kind": "single_current_image", "sampling_fps": 2.0}, "first_object_media": {"fps": 3.0, "encoded_duration_seconds": 4.0, "maximum_future_seconds": 4.0, "anchor_fps": 2.0}}
        return {"subtask": dict(STEP), "task_instruction_source": "subtask", "task_instruction": "pick", "media_scope": scope, "result": {"frames": [frame]}}

    requests = [{"stage": "current_frame_inventory", "media_kind": "single_current_image"}, {"stage": "future_first_object_selection", "media_kind": "future_video_3fps_4s"}] * 2
    return {"task_instruction_source": "subtask", "subtask_result_sha256": "a" * 64, "subtask_results": [segment(0), segment(1)]}, requests


def sta():
    observation = {"bbox_xyxy_1000": [0, 0, 5, 5], "bbox_source": "single_image_vlm_event_name_grounding", "contact_frame_source": "cpa_final", "no_intervening_cpa_final_contact": True, "contact_event_name": "pick cup", "next_contact_noun": "cup", "next_contact_verb": "pick", "time_seconds": 0.5, "time_to_contact_seconds": 0.5}
    event = {
        "event_id": "e1", "accepted": True, "contact_frame_source": "cpa_final", "contact_frame_selection": {"valid_contact": True, "requested_subtask_id": 1, "selected_candidate": {"subtask_id": 1}}, "contact_subtask_id": 1, "contact_time_seconds": 1.0, "contact_event_name": "pick cup",
        "object_name": "cup", "contact_verb": "pick", "observations": [observation],
        "observation_sampling": {"version": contracts.STA_SAMPLING, "no_intervening_cpa_final_contact": True, "selected_frame_count": 1, "grounded_observation_count": 1, "invisible_observation_count": 0, "previous_contact_time_seconds": None},
    }
    segment = {"subtask": dict(STEP), "task_instruction_source": "subtask", "task_instruction": "pick", "result": {"contact_frame_authority": "cpa_final", "parent_cpa_segment_sha256": "c" * 64, "contact_events": [event], "rejected_contact_event_proposals": []}}
    result = {
        "task_instruction_source": "subtask", "subtask_result_sha256": "a" * 64, "contact_frame_authority": "cpa_final", "parent_cpa_result_sha256": "b" * 64, "subtask_results": [segment], "contact_frame_summary": {"accepted": 1, "rejected": 0},
        "sta_observation_policy": {"version": contracts.STA_POLICY, "contact_frame_authority": "cpa_final", "bbox_input": "single_observation_image_plus_contact_event_name", "observations_per_contact": 3},
    }
    return result, [{"stage": "cpa_final_random_sta_observation_sync", "parent_cpa_result_sha256": "b" * 64}, {"stage": "cpa_final_random_observation_bbox", "media_kind": "single_random_pre_contact_image"}]


def ecot():
    target = {"scene_description": "A cup.", "task_progress": "Half; Task not yet complete.", "current_subtask": {"subtask": "pick.", "action": "None", "object": "None", "source": "None", "target": "None"}, "atomic_action": "move left"}

    def frame(i):
        messages = [{"role": "user", "content": [{"type": "image", "image": "i"}, {"type": "text", "text": "give atomic_action"}]}, {"role": "assistant", "content": json.dumps(target)}]
        return json.loads(json.dumps({"sampled_frame_index": i, "sampled_time_seconds": i / 2, "structured_ecot": target, **target, "messages": messages, "training_input": {"task_instruction": "t", "image": "i"}, "training_target": target}))

    contract = {"schema": contracts.ECOT_SCHEMA, "one_teacher_request_per_selected_frame": True, "teacher_receives_complete_0_5fps_video": True, "teacher_sampling_fps": 0.5, "target_sampling_fps": 2.0, "training_excludes_privileged_video": True}
    result = {"task_instruction_source": "global_task", "ecot_interval": 4, "sampled_frame_count": 5, "ecot_sample_type": "uniform_2fps_interval", "sampling_fps": 2.0, "annotation_contract": contract, "frames": [frame(0), frame(4)]}
    return result, [{"stage": "privileged_complete_video_ecot", "media_kind": "complete_0.5fps_episode_video_plus_target_image"}] * 2


def at(value, path):
    for k in path[:-1]:
        value = value[k]
    return value, path[-1]


F0, S0, E0 = ("subtask_results", 0, "result", "frames", 0), ("subtask_results", 0), ("subtask_results", 0, "result", "contact_events", 0)
O0 = (*F0, "objects", 0)
B0 = (*E0, "observations", 0)
BREAKS = {
    "grd": [
        (("task_instruction_source",), "x", "wrong_result_instruction_source"), (("subtask_result_sha256",), "A" * 64, "invalid_subtask_result_hash"), (("subtask_results",), None, "invalid_subtask_results"), (("subtask_results",), [], "empty_subtask_results"),
        ((*S0, "subtask", "id"), None, "invalid_segment_subtask"), ((*S0, "subtask", "subtask"), " ", "empty_segment_subtask_instruction"), ((*S0, "task_instruction_source"), "x", "wrong_segment_instruction_source"), ((*S0, "task_instruction"), "x", "wrong_segment_task_instruction"),
        ((*S0, "result"), 5, "invalid_segment_result"), ((*S0, "media_scope", "kind"), "x", "invalid_grd_media_scope"), ((*S0, "media_scope", "grounding_media", "sampling_fps"), 3.0, "invalid_grd_current_image_contract"), ((*S0, "media_scope", "first_object_media", "fps"), True, "invalid_grd_future_video_contract"),
        ((*S0, "media_scope", "anchor_frame_index"), -1, "invalid_grd_anchor_index"), ((*S0, "media_scope", "anchor_time_seconds"), -1, "invalid_grd_anchor_time"), ((*S0, "media_scope", "anchor_time_seconds"), 0.1, "grd_anchor_time_index_mismatch"), ((*S0, "result", "frames"), [], "grd_requires_exactly_one_output_frame"),
        ((*F0, "media_index"), 4, "grd_frame_anchor_index_mismatch"), ((*F0, "timestamp_seconds"), 0.2, "grd_frame_anchor_time_mismatch"), ((*F0, "objects"), None, "invalid_grd_inventory"), ((*O0, "name"), "", "invalid_grd_inventory_object"), ((*O0, "bbox_xyxy_1000"), [5, 0, 2, 9], "invalid_grd_inventory_bbox"),
        ((*O0, "center_xy_1000"), [5, 5], "invalid_grd_inventory_center"), ((*O0, "clearly_visible"), None, "grd_inventory_contains_nonvisible_object"), ((*F0, "task_first_object"), "jar", "grd_first_object_not_in_inventory"), ((*F0, "task_first_object_selection"), None, "invalid_grd_first_object_selection"),
        ((*S0, "media_scope", "anchor_frame_index"), 1, "duplicate_grd_anchor"), ((*S0, "subtask", "end_time_seconds"), 3.0, "grd_anchor_coverage_mismatch"),
    ],
    "sta": [
        (("contact_frame_authority",), "x", "sta_contact_frame_not_cpa_final"), (("parent_cpa_result_sha256",), "x", "invalid_sta_parent_cpa_hash"), (("sta_observation_policy", "observations_per_contact"), 0, "invalid_sta_observation_policy"), ((*S0, "result", "contact_frame_authority"), "x", "sta_segment_contact_frame_not_cpa_final"),
        ((*S0, "result", "parent_cpa_segment_sha256"), "x", "invalid_sta_parent_cpa_segment_hash"), ((*S0, "result", "contact_events"), None, "invalid_sta_contact_events"), ((*S0, "result", "rejected_contact_event_proposals"), None, "invalid_sta_rejected_contact_events"), ((*E0, "event_id"), "", "invalid_or_duplicate_sta_event_id"),
        ((*E0, "accepted"), None, "sta_contains_nonaccepted_contact_event"), ((*E0, "contact_frame_source"), "x", "sta_event_contact_frame_not_cpa_final"), ((*E0, "contact_frame_selection", "valid_contact"), False, "invalid_sta_contact_frame_selection"), ((*E0, "contact_frame_selection", "requested_subtask_id"), 2, "sta_requested_subtask_mismatch"),
        ((*E0, "contact_frame_selection", "selected_candidate", "subtask_id"), 2, "sta_selected_subtask_mismatch"), ((*E0, "contact_subtask_id"), 2, "sta_contact_subtask_mismatch"), ((*E0, "contact_time_seconds"), True, "invalid_sta_contact_time"), ((*E0, "contact_event_name"), "x", "wrong_sta_contact_event_name"),
        ((*E0, "observation_sampling", "version"), "x", "invalid_sta_observation_sampling"), ((*E0, "observations"), None, "invalid_sta_observations"), ((*E0, "observation_sampling", "invisible_observation_count"), 4, "sta_observation_count_mismatch"), ((*B0, "bbox_xyxy_1000"), [0, 0, 0, 0], "invalid_sta_observation_bbox"),
        ((*B0, "bbox_source"), "x", "wrong_sta_bbox_source"), ((*B0, "contact_frame_source"), "x", "sta_observation_contact_frame_not_cpa_final"), ((*B0, "no_intervening_cpa_final_contact"), None, "sta_observation_allows_intervening_contact"), ((*B0, "contact_event_name"), "x", "sta_observation_event_name_mismatch"),
        ((*B0, "next_contact_noun"), "x", "sta_observation_noun_mismatch"), ((*B0, "next_contact_verb"), "x", "sta_observation_verb_mismatch"), ((*B0, "time_seconds"), 1.5, "sta_observation_not_before_contact"), ((*B0, "time_to_contact_seconds"), 0.4, "sta_observation_ttc_mismatch"),
        ((*E0, "observation_sampling", "previous_contact_time_seconds"), 0.6, "sta_observation_not_after_previous_contact"), ((*E0, "observation_sampling", "previous_contact_time_seconds"), 0.1, "sta_previous_contact_mismatch"), (("contact_frame_summary", "accepted"), 3, "sta_contact_frame_summary_mismatch"),
        ((*E0, "observation_sampling", "selected_frame_count"), 3, "sta_bbox_request_count_mismatch"),
    ],
    "ecot": [
        (("task_instruction_source",), "x", "wrong_ecot_instruction_source"), (("ecot_sample_type",), "x", "wrong_ecot_sample_type"), (("sampling_fps",), True, "wrong_ecot_sampling_fps"), (("ecot_interval",), 0, "invalid_ecot_interval"), (("sampled_frame_count",), 1.5, "invalid_ecot_sampled_frame_count"),
        (("annotation_contract", "schema"), "x", "invalid_ecot_annotation_contract"), (("frames",), None, "invalid_ecot_frames"), (("frames", 0, "sampled_frame_index"), -1, "invalid_ecot_frame_index"), (("frames", 0, "sampled_time_seconds"), 1.0, "ecot_frame_time_index_mismatch"), (("frames", 0, "structured_ecot"), {}, "invalid_structured_ecot"),
        (("frames", 0, "scene_description"), "x", "ecot_scene_description_mismatch"), (("frames", 0, "structured_ecot", "atomic_action"), "LOUD", "invalid_ecot_atomic_action"), (("frames", 0, "task_progress"), "x", "ecot_task_progress_mismatch"), (("frames", 0, "atomic_action"), "x", "ecot_atomic_action_mismatch"),
        (("frames", 0, "messages"), [], "invalid_ecot_training_messages"), (("frames", 0, "messages", 1, "role"), "user", "ecot_training_message_target_mismatch"), (("frames", 0, "messages", 0, "role"), "x", "ecot_training_message_input_mismatch"), (("frames", 0, "structured_ecot", "task_progress"), "x", "invalid_ecot_task_progress"),
        (("frames", 0, "structured_ecot", "current_subtask"), {}, "invalid_ecot_current_subtask"), (("frames", 0, "training_input", "video"), "v", "ecot_training_input_leaks_or_is_invalid"), (("frames", 0, "training_target", "atomic_action"), "x", "ecot_training_target_mismatch"), (("sampled_frame_count",), 9, "ecot_frame_selection_coverage_mismatch"),
    ],
}


@pytest.mark.parametrize("task", ["grd", "sta", "ecot"])
def test_each_failure(spark, task):
    good, requests = {"grd": grd, "sta": sta, "ecot": ecot}[task]()
    rows, want = [(-1, json.dumps(good), json.dumps(requests)), (-2, json.dumps(good), json.dumps(requests[:-1])), (-3, json.dumps(good), None), (-4, "5", None)], {}
    for k, (path, value, failure) in enumerate(BREAKS[task]):
        bad = copy.deepcopy(good)
        holder, key = at(bad, path)
        holder[key] = value
        rows.append((k, json.dumps(bad), json.dumps(requests)))
        want[k] = failure
    got = {r.k: r.failures for r in contracts.failures(task, spark.createDataFrame(rows, "k int, result string, requests string")).collect()}
    assert got[-1] == [] and any("request" in f for f in got[-2]) and got[-3] == ["invalid_request_audit_list"] and got[-4] == ["missing_result"]
    assert {k: f in got[k] for k, f in want.items()} == dict.fromkeys(want, True), {k: (f, got[k]) for k, f in want.items() if f not in got[k]}


def test_subtask_and_cpa(spark):
    rows = [("a", json.dumps({"subtasks": [{"subtask": "A b"}, {"subtask": "a  B"}, {"subtask": "c"}, {"subtask": "a b"}]})), ("b", '{"subtasks":[]}'), ("c", "[]")]
    df = spark.createDataFrame(rows, "k string, result string").selectExpr("*", "'[]' AS requests")
    assert {r.k: r.failures for r in contracts.failures("subtask", df).collect()} == {"a": ["adjacent_identical_subtask"], "b": ["invalid_subtasks"], "c": ["missing_result"]}
    assert {r.k: r.failures for r in contracts.failures("cpa", df).collect()} == {"a": [], "b": [], "c": ["missing_result"]}


def record(uid, task="subtask", model="m", contract=None, result=None):
    extension = {"annotation_task": task, "provider": "p", "model": model, "result": result or {"subtasks": [{"subtask": "a"}]}, "requests": []}
    return json.dumps({"schema_version": records.RECORD_SCHEMA, "uid": f"{uid}:annotation:{task}:{model}", "source_key": "s", "annotations": {"robot_extension": extension}, "provenance": {"input_record_uid": uid, "annotation": {"contract_id": contract or contracts.CONTRACT_IDS[task][0]}}})


def test_audit_and_quarantine(spark):
    values = [record("a"), record("a"), "{bad", record("b", model="z"), "  ", record("c", contract="old"), record("", result={"subtasks": []}), record("d")]
    lines = spark.createDataFrame([("f", k, v) for k, v in enumerate(values)], "file string, line int, value string")
    audited = records.audit(lines, task="subtask", provider="p", model="m", contract_id=contracts.CONTRACT_IDS["subtask"][0]).cache()
    assert {r.line: r.failures for r in audited.collect()} == {0: [], 1: ["duplicate_input_uid"], 2: ["invalid_record"], 3: ["wrong_model"], 5: ["wrong_contract"], 6: ["invalid_subtasks", "empty_input_uid"], 7: []}
    summary = {(r.figure, r.key): r.n for r in records.audit_summary(audited, expected=7).collect()}
    assert summary["records", ""] == 7 and summary["unique_uids", ""] == 4 and summary["failure", "unexpected_unique_uid_count"] == 1 and ("failure", "unexpected_record_count") not in summary and summary["source", "s"] == 6
    accepted, evidence = records.split_quarantine(records.classified(records.parsed(lines), "subtask", "m", "p"), "file", "line")
    assert sorted(r.line for r in accepted.collect()) == [0, 7] and sorted(r.line for r in evidence.collect()) == [1, 2, 3, 4, 5, 6]
    heads = lines.select("line", records.header_mismatch(lines.value, "subtask", "m").alias("off")).collect()
    assert [r.line for r in heads if r.off] == [3]
