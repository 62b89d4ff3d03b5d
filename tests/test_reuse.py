import copy
import json

from annolith.operators import ecot, reuse

GOOD = {"scene_description": "A  cup", "task_progress": "Half done. The task is not complete.", "current_subtask": {"subtask": "Pick the CUP", "action": "Pick", "object": "cup", "source": "None", "target": "None"}, "atomic_action": "Move left"}


def test_parsing(spark):
    def but(**changes):
        value = copy.deepcopy(GOOD)
        for path, new in changes.items():
            holder = value
            *head, last = path.split("__")
            for k in head:
                holder = holder[k]
            holder[last] = new
        return json.dumps(value)

    done = {"task_progress": "All. Task complete.", "current_subtask": {"subtask": "No further subtask remains", **dict.fromkeys(("action", "object", "source", "target"), "None")}, "atomic_action": "None"}
    rows = {
        "good": (json.dumps(GOOD), None), "done": (json.dumps({**GOOD, **done}), None), "keys": (json.dumps({**GOOD, "more": 1}), "ecot_top_level_fields_invalid"), "empty": (but(scene_description=" "), "ecot_empty_text"),
        "judgment": (but(task_progress="Half done."), "ecot_completion_judgment_missing"), "fields": (but(current_subtask={"subtask": "x"}), "ecot_subtask_fields_invalid"), "blank": (but(current_subtask__action=" "), "ecot_subtask_semantic_invalid"),
        "mismatch": (but(task_progress="Task complete."), "ecot_subtask_completion_mismatch"), "two": (but(current_subtask__subtask="pick, then put"), "ecot_subtask_not_single_goal"), "action": (but(atomic_action="a" * 241), "ecot_atomic_action_invalid_phrase"),
        "leak": (but(scene_description="The video shows a cup."), "ecot_privileged_context_leak:the video shows"),
    }
    df = spark.createDataFrame([(k, v) for k, (v, _) in rows.items()], "k string, value string")
    got = {r.k: r for r in ecot.parse(df).collect()}
    assert {k: r.error for k, r in got.items()} == {k: e for k, (_, e) in rows.items()}
    p = got["good"].parsed
    assert p.scene_description == "A cup." and p.task_progress == "Half done; Task not yet complete." and p.current_subtask.subtask == "pick the cup." and p.atomic_action == "move left" and got["two"].parsed is None


def frame():
    objects = [{"name": "red cup", "alternate_name": "cup"}, {"name": "plate", "alternate_name": "dish"}]
    before = {"objects": [{"name": "cup", "alternate_name": "cup"}, dict(objects[1])], "media_index": 0}
    pairs = [{"object_indices": [0, 1], "distinguishable": True, "reason": "differ"}]
    value = {"objects": objects, "media_index": 0, "registered": True}
    stages = [{"stage": "initial_language_review", "accepted": False}, {"stage": "name_correction"}, {"stage": "post_correction_language_review", "pairs": pairs}]
    value["inventory_review"] = {"policy": ecot.REVIEW_POLICY, "model": ecot.REVIEW_MODELS[0], "provider": "ark", "pairs": pairs, "accepted": True, "original_frame": before, "final_frame": {"objects": objects, "media_index": 0}, "stages": stages, "frame_sha256": ecot._frame_digest(value), "input_frame_sha256": ecot._frame_digest(before)}
    return value


def test_reviews(spark):
    good, changed, box, accepted = frame(), frame(), frame(), frame()
    changed["objects"][0]["name"] = "blue cup"
    box["inventory_review"]["original_frame"]["media_index"] = 1
    accepted["registered"] = False
    assert ecot.review_holds(json.dumps(good)) and not any(ecot.review_holds(json.dumps(x)) for x in (changed, box, accepted, {}, [])) and not ecot.review_holds("{bad")
    df = spark.createDataFrame([("a", [json.dumps(good)], ecot.REVIEW_MODELS[0]), ("b", [json.dumps(good), json.dumps(changed)], ecot.REVIEW_MODELS[0]), ("c", [json.dumps(good)], "other"), ("d", [], "x")], "uid string, frames array<string>, model string")
    assert {r.uid: r.is_reviewed for r in ecot.reviewed(df).collect()} == {"a": True, "b": False, "c": False, "d": True}


def test_located(spark):
    sources = spark.createDataFrame([("a", "h"), ("a:view=left", "h"), ("b", "h"), ("c", "h")], "uid string, subtask_sha string")
    stored = spark.createDataFrame([("a", "pack", "r1", True, "cpa_final", "h"), ("a", "exact", "r2", True, "cpa_final", "h"), ("b", "exact", "r3", True, "cpa_final", "old"), ("b", "cache", "r4", False, "cpa_final", "h")], "uid string,place string,record string,contract_ok boolean,authority string,subtask_sha string")
    got = {r.uid: (r.record, r.place, r.error, r.primary_view) for r in reuse.located(sources, stored).collect()}
    assert got["a"] == ("r2", "exact", None, True) and got["a:view=left"] == ("r2", "exact", None, False) and got["b"][2] == "subtask_differs" and got["c"][2] == "not_found"


def test_frames_and_boxes(spark):
    c = [(0, "1", 10), (1, "2", 11)]
    rows = [("ok", c, 0, "1", "1", True), ("no", c, 0, "1", "1", None), ("index", c, 7, "1", "1", True), ("step", c, 1, "1", "1", True), ("answer", c, 0, "1", "2", True)]
    df = spark.createDataFrame(rows, "k string,candidates array<struct<media_index:int,subtask_id:string,source_frame:int>>,selected_index int,requested_step string,answered_step string,says_valid boolean")
    got = {r.k: (r.reason, r.contact_frame) for r in reuse.exact_frames(df).collect()}
    assert got == {"ok": (None, 10), "no": ("not_valid_contact", None), "index": ("selected_index_invalid", None), "step": ("candidate_in_other_step", None), "answer": ("answer_names_other_step", None)}
    boxes = spark.createDataFrame([("u", "e", 0, 5, [0.0, 0.0, 9.6, 4.5], True), ("u", "e", 1, 6, None, False), ("u", "e", 2, 7, [1.0, 1.0, 1.0, 1.0], None)], "uid string,event_id string,sample int,frame int,bbox array<double>,target_visible boolean")
    out = reuse.observation_boxes(boxes)
    assert [(r.box, r.error) for r in sorted(out.collect(), key=lambda r: r.sample)] == [([0, 0, 10, 4], None), (None, None), (None, "sta_bbox_invalid")]
    r = reuse.regrouped(out).first()
    assert (r.selected, r.grounded, r.invisible) == (3, 1, 2)
