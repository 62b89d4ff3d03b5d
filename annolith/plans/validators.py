"""Queries that hold the contract checks against SQL: records are written as JSON from orders, with faults of known places.

A template is the JSON of a sound record; a mark in it is replaced by its sound or its faulty text, by a condition on
the order's number o, or, inside a segment, on k, the number of the segment over all orders.  SQL counts, for each
failure, the rows that meet the conditions of the marks that cause it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.operators import contracts, records

from .registry import query, table

Marks = dict[str, tuple[str, str, str]]

SHA = "0123456789abcdef" * 4
ROWS = "r AS (SELECT o_orderkey AS o, 1 + o_orderkey % 3 AS n FROM orders), s AS (SELECT o, n, i, o * 4 + i AS k FROM (SELECT *, unnest(range(0, CAST(n AS BIGINT))) AS i FROM r))"


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def chosen(condition: str, bad: str, good: str) -> str:
    """SQL of one of two texts (also SQL); k is the order's number and the segment's place i."""
    return f"CASE WHEN {re.sub(r'\bk\b', '(o * 4 + i)', condition)} THEN {bad} ELSE {good} END"


def written_sql(template: str, marks: Marks) -> str:
    """SQL of the template with <name> as the sound or the faulty text of a mark, and {expression} as a number."""
    parts = []
    for piece in re.split(r"(<\w+>|\{\{.+?\}\})", re.sub(r"\n\s*", "", template)):
        if piece.startswith("{{"):
            parts.append(f"CAST({piece[2:-2]} AS STRING)")
        elif piece.startswith("<"):
            good, bad, condition = marks[piece[1:-1]]
            parts.append(chosen(condition, *map(quoted, (bad, good))))
        elif piece:
            parts.append(quoted(piece))
    return f"concat({', '.join(parts)})"


def written(template: str, marks: Marks) -> Column:
    return F.expr(written_sql(template, marks))


def orders(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("o"), (1 + F.col("o_orderkey") % 3).cast("int").alias("n"))


def segments(spark, sf_dir: str, **texts: str) -> DataFrame:
    """o, n and, for each text (SQL on o and i), the segments' texts in order.

    Orders are dealt to all cores before they become texts a hundred times their size; the texts are not shuffled.
    """
    dealt = orders(spark, sf_dir).repartition(4 * spark.sparkContext.defaultParallelism, "o")
    return dealt.select("o", "n", *[F.expr(f"array_join(transform(sequence(0, n - 1), i -> {sql}), ',')").alias(name) for name, sql in texts.items()])


def counted(rows: DataFrame) -> DataFrame:
    return rows.select(F.explode("failures").alias("failure")).groupBy("failure").agg(F.count("*").alias("n"))


def counts_sql(by_record: dict[str, str], by_segment: dict[str, str]) -> str:
    """SQL that counts the records and segments that meet each failure's condition."""
    one = [f"SELECT '{name}' AS failure FROM r WHERE {c}" for name, c in by_record.items()] + [f"SELECT '{name}' FROM s WHERE {c}" for name, c in by_segment.items()]
    return f"WITH {ROWS} SELECT failure, count(*) AS n FROM ({' UNION ALL '.join(one)}) GROUP BY failure"


def conditions(marks: Marks) -> dict[str, str]:
    return {name: c for name, (_, _, c) in marks.items()}


# Reasoning records

ECOT_FRAME: Marks = {
    "index": ("{i}", "-1", "k % 101 = 0"), "time": ("0", "9", "k % 103 = 1"), "scene": ("A table.", "A desk.", "k % 107 = 2"), "action": ("move the cup", "Move The Cup", "k % 109 = 3"),
    "progress": ("Half done; Task not yet complete.", "Half done.", "k % 113 = 4"), "fields": ('"target":"None"', '"goal":"None"', "k % 127 = 5"), "more": ("", ',"further":1', "k % 131 = 6"),
    "input": ('"task_instruction":"t"', '"task_instruction":"t","video":"v"', "k % 137 = 7"), "training": ("A table.", "A bench.", "k % 139 = 8"), "role": ("user", "system", "k % 149 = 9"),
    "answer": ("assistant", "user", "k % 151 = 10"), "turns": ("", ',{"role":"user","content":"x"}', "k % 157 = 11"), "content": ("", "not JSON ", "k % 163 = 12"), "frame_action": ("", "x", "k % 167 = 13"),
}
ECOT_RECORD: Marks = {
    "source": ("global_task", "subtask", "o % 11 = 0"), "sample": (contracts.ECOT_SAMPLES, "random", "o % 13 = 1"), "fps": ("2.0", "1.0", "o % 17 = 2"), "interval": ("1", "0", "o % 19 = 3"), "teacher": ("0.5", "2.0", "o % 23 = 4"),
    "frames": ("frames", "no_frames", "o % 97 = 5"), "kind": ("complete_0.5fps_episode_video_plus_target_image", "video", "o % 29 = 6"), "stage": ("privileged_complete_video_ecot", "other", "o % 31 = 7"),
}


def _ecot_frame() -> str:
    inner = '{"scene_description":"A table.","task_progress":"<progress>","current_subtask":{"subtask":"move the cup.","action":"move","object":"cup","source":"None",<fields>},"atomic_action":"<action>"<more>}'
    said = inner.replace('"', '\\"').replace('<fields>', '<q_fields>').replace("<more>", "<q_more>")
    marks = ECOT_FRAME | {f"q_{m}": (ECOT_FRAME[m][0].replace('"', '\\"'), ECOT_FRAME[m][1].replace('"', '\\"'), ECOT_FRAME[m][2]) for m in ("fields", "more")}
    index = chosen(ECOT_FRAME["index"][2], "'-1'", "CAST(i AS STRING)")
    time = chosen(ECOT_FRAME["time"][2], "'9'", "CAST(i / 2 AS STRING)")
    head = f"""'{{"sampled_frame_index":', {index}, ',"sampled_time_seconds":', {time}"""
    template = (
        f',"structured_ecot":{inner},"scene_description":"<scene>","task_progress":"<progress>","current_subtask":{{"subtask":"move the cup.","action":"move","object":"cup","source":"None",<fields>}},"atomic_action":"<action><frame_action>",'
        f'"messages":[{{"role":"<role>","content":[{{"type":"image","image":"a.png"}},{{"type":"text","text":"Give the atomic_action."}}]}},{{"role":"<answer>","content":"<content>{said}"}}<turns>],'
        f'"training_input":{{"image":"a.png",<input>}},"training_target":{inner.replace("A table.", "<training>")}}}'
    )
    return f"concat({head}, {written_sql(template, marks)})"


def _ecot_sql() -> str:
    r, f = conditions(ECOT_RECORD), conditions(ECOT_FRAME)
    whole, there = f"NOT ({f['more']})", f"NOT ({r['frames']})"
    frame = lambda c: f"{there} AND {c}"
    inside = lambda c: f"{there} AND {whole} AND {c}"
    two, readable = f"NOT ({f['turns']})", f"NOT ({f['content']} AND NOT ({f['answer']}))"
    stage = f"NOT ({r['stage']})"
    coverage = f"{there} AND EXISTS (SELECT 1 FROM s WHERE s.o = r.o AND {f['index']})"
    by_record = {
        "wrong_ecot_instruction_source": r["source"], "wrong_ecot_sample_type": r["sample"], "wrong_ecot_sampling_fps": r["fps"], "invalid_ecot_interval": r["interval"], "invalid_ecot_annotation_contract": r["teacher"], "invalid_ecot_frames": r["frames"],
        "ecot_frame_selection_coverage_mismatch": coverage, "ecot_request_count_mismatch": f"{there} AND {r['stage']}", "wrong_ecot_request_media_kind": f"{there} AND {stage} AND {r['kind']}",
    }
    by_segment = {
        "invalid_ecot_frame_index": frame(f["index"]), "ecot_frame_time_index_mismatch": frame(f"NOT ({f['index']}) AND {f['time']}"), "invalid_structured_ecot": frame(f["more"]), "ecot_scene_description_mismatch": inside(f["scene"]),
        "invalid_ecot_atomic_action": inside(f["action"]), "ecot_atomic_action_mismatch": inside(f["frame_action"]), "invalid_ecot_task_progress": inside(f["progress"]), "invalid_ecot_current_subtask": inside(f["fields"]),
        "ecot_training_input_leaks_or_is_invalid": inside(f["input"]), "ecot_training_target_mismatch": inside(f["training"]), "invalid_ecot_training_messages": inside(f["turns"]),
        "invalid_ecot_training_message_target": inside(f"{two} AND {f['content']} AND NOT ({f['answer']})"), "ecot_training_message_target_mismatch": inside(f"{two} AND {f['answer']}"),
        "ecot_training_message_input_mismatch": inside(f"{two} AND {readable} AND {f['role']}"),
    }
    return counts_sql(by_record, by_segment)


@query(_ecot_sql())
def ecot_contract(spark, sf_dir):
    request = written_sql('{"stage":"<stage>","media_kind":"<kind>"}', ECOT_RECORD)
    rows = segments(spark, sf_dir, frames=_ecot_frame(), requests=request)
    head = '{"task_instruction_source":"<source>","ecot_interval":<interval>,"sampled_frame_count":{{n}},"ecot_sample_type":"<sample>","sampling_fps":<fps>,'
    contract = f'"annotation_contract":{{"schema":"{contracts.ECOT_SCHEMA}","one_teacher_request_per_selected_frame":true,"teacher_receives_complete_0_5fps_video":true,"teacher_sampling_fps":<teacher>,"target_sampling_fps":2.0,"training_excludes_privileged_video":true}},"<frames>":['
    result = F.concat(written(head, ECOT_RECORD), written(contract, ECOT_RECORD), "frames", F.lit("]}"))
    return counted(contracts.failures("ecot", rows.select("o", result.alias("result"), F.concat(F.lit("["), "requests", F.lit("]")).alias("requests"))))


# Grounding

GRD_SEGMENT: Marks = {
    "source": ("subtask", "global_task", "k % 41 = 0"), "text": ("pick the cup", " ", "k % 43 = 1"), "instruction": ("", " now", "k % 47 = 2"), "still": ("single_current_image", "clip", "k % 53 = 3"), "clip": ("3.0", "2.0", "k % 59 = 4"),
    "media": ("", "7", "k % 61 = 5"), "stamp": ("", "1", "k % 67 = 6"), "name": ("cup", " ", "k % 71 = 7"), "corner": ("300", "1300", "k % 73 = 8"), "center": ("201", "202", "k % 79 = 9"), "visible": ("true", "false", "k % 83 = 10"),
    "first": ("cup", "jar", "k % 89 = 11"), "selected": ("", "x", "k % 97 = 12"), "scope": ("grounding_frame", "grounding_clip", "k % 101 = 13"), "reviewed": ("true", "false", "k % 103 = 14"), "again": ("", ',{"registered":true}', "k % 107 = 15"),
    "many": ("", ',{"name":"a"},{"name":"b"},{"name":"c"},{"name":"d"}', "k % 109 = 16"), "now": ("single_current_image", "video", "k % 113 = 17"), "later": ("future_video_3fps_4s", "video", "k % 127 = 18"), "anchor": ("", "9", "k % 131 = 19"),
}
GRD_RECORD: Marks = {
    "source": ("subtask", "global_task", "o % 11 = 0"), "sha": (SHA, "none", "o % 13 = 1"), "results": ("subtask_results", "results", "o % 211 = 2"), "model": (contracts.REVIEW_MODELS[0], "unknown", "o % 17 = 3"), "rejected": ("[]", "null", "o % 19 = 4"),
    "total": ("", "1", "o % 23 = 5"), "stage": ("current_frame_inventory", "other", "o % 29 = 6"),
}


def _grd_segment() -> str:
    model = chosen(GRD_RECORD["model"][2], "'unknown'", quoted(contracts.REVIEW_MODELS[0]))
    one = (
        '{"subtask":{"id":"s{{i}}","subtask":"<text>","start_time_seconds":{{i / 2}},"end_time_seconds":{{i / 2 + 0.5}}},"task_instruction_source":"<source>","task_instruction":"<text><instruction>",'
        '"media_scope":{"kind":"<scope>","anchor_frame_index":<anchor>{{i}},"anchor_time_seconds":{{i / 2}},"grounding_media":{"kind":"<still>","sampling_fps":2.0},"first_object_media":{"fps":<clip>,"encoded_duration_seconds":4.0,"maximum_future_seconds":4.0,"anchor_fps":2.0}},'
        '"result":{"frames":[{"media_index":<media>{{i}},"timestamp_seconds":<stamp>{{i / 2}},"registered":true,"objects":[{"name":"<name>","bbox_xyxy_1000":[101,200,<corner>,400],"center_xy_1000":[<center>,300],"clearly_visible":<visible>}<many>],'
        '"task_first_object":"<first>","task_first_object_selection":{"task_first_object":"<first><selected>"},"inventory_review":{"policy":"' + contracts.REVIEW_POLICY + '","model":"'
    )
    # 100.5 + ... the centre of [101, 200, 300, 400] is [200.5, 300], and half goes to the even 200
    seen = written_sql(one, GRD_SEGMENT | {"center": ("200", "201", GRD_SEGMENT["center"][2])})
    return f"concat({seen}, {model}, {written_sql('","accepted":<reviewed>}}<again>]}}', GRD_SEGMENT)})"


def _grd_sql() -> str:
    r, s = conditions(GRD_RECORD), conditions(GRD_SEGMENT)
    there = f"NOT ({r['results']})"
    seg = lambda c: f"{there} AND {c}"
    single = f"NOT ({s['again']})"
    one = lambda c: f"{there} AND {single} AND {c}"
    scoped, index_moved = f"NOT ({s['scope']})", f"({s['anchor']})"
    named = f"NOT ({s['name']})"
    has = lambda c: f"EXISTS (SELECT 1 FROM s WHERE s.o = r.o AND {c})"
    by_record = {
        "wrong_result_instruction_source": r["source"], "invalid_subtask_result_hash": r["sha"], "invalid_subtask_results": r["results"], "invalid_grd_review_model": f"{there} AND {r['model']}", "invalid_grd_rejected_segments": f"{there} AND {r['rejected']}",
        "invalid_grd_review_summary": f"{there} AND {r['total']}", "grd_anchor_coverage_mismatch": f"{there} AND {has(f'({index_moved} OR NOT {scoped})'.replace('NOT NOT', ''))}",
        "grd_current_request_count_mismatch": f"{there} AND {r['stage']}", "wrong_grd_current_request_media_kind": f"{there} AND NOT ({r['stage']}) AND {has(s['now'])}", "wrong_grd_future_request_media_kind": f"{there} AND {has(s['later'])}",
    }
    moved_media = f"(({s['media']}) <> ({s['anchor']}) OR (({s['media']}) AND ({s['anchor']})) OR NOT {scoped})".replace("NOT NOT", "")
    by_segment = {
        "empty_segment_subtask_instruction": seg(s["text"]), "wrong_segment_instruction_source": seg(s["source"]), "wrong_segment_task_instruction": seg(s["instruction"]), "invalid_grd_media_scope": seg(s["scope"]),
        "invalid_grd_current_image_contract": seg(f"({s['scope']} OR {s['still']})"), "invalid_grd_future_video_contract": seg(f"({s['scope']} OR {s['clip']})"), "invalid_grd_anchor_index": seg(s["scope"]), "invalid_grd_anchor_time": seg(s["scope"]),
        "grd_anchor_time_index_mismatch": seg(f"{scoped} AND {s['anchor']}"), "grd_requires_exactly_one_output_frame": seg(s["again"]), "invalid_grd_inventory_review": seg(f"({s['again']} OR {s['reviewed']})"),
        "grd_frame_anchor_index_mismatch": one(moved_media), "grd_frame_anchor_time_mismatch": one(f"({s['scope']} OR {s['stamp']})"), "grd_inventory_over_four_objects": one(s["many"]), "invalid_grd_inventory_object": one(s["name"]),
        "grd_first_object_not_in_inventory": one(f"({s['name']} OR {s['first']})"), "invalid_grd_first_object_selection": one(s["selected"]),
    }
    # an object counts once, and so do each of the four further ones, which lack a box and say nothing about their visibility
    one_object = {"invalid_grd_inventory_bbox": f"{named} AND {s['corner']}", "invalid_grd_inventory_center": f"{named} AND NOT ({s['corner']}) AND {s['center']}", "grd_inventory_contains_nonvisible_object": f"{named} AND {s['visible']}"}
    more = {name: f"UNION ALL SELECT '{name}' FROM s, (SELECT unnest(range(0, 4))) WHERE {one(s['many'])}" for name in ("invalid_grd_inventory_bbox", "grd_inventory_contains_nonvisible_object")}
    sql = counts_sql(by_record, by_segment | {k: one(v) for k, v in one_object.items()})
    return sql.replace(") GROUP BY failure", f" {' '.join(more.values())}) GROUP BY failure")


@query(_grd_sql())
def grd_contract(spark, sf_dir):
    now = written_sql('{"stage":"<stage>","media_kind":"<now>"}', {"stage": GRD_RECORD["stage"], "now": GRD_SEGMENT["now"]})
    later = written_sql('{"stage":"future_first_object_selection","media_kind":"<later>"}', GRD_SEGMENT)
    rows = segments(spark, sf_dir, results=_grd_segment(), now=now, later=later)
    head = '{"task_instruction_source":"<source>","subtask_result_sha256":"<sha>","rejected_subtask_results":<rejected>,"inventory_review_summary":{"policy":"' + contracts.REVIEW_POLICY + '","model":"<model>","total_frames":<total>{{n}},"accepted_frames":{{n}},"rejected_frames":0},"<results>":['
    result = F.concat(written(head, GRD_RECORD), "results", F.lit("]}"))
    return counted(contracts.failures("grd", rows.select("o", result.alias("result"), F.concat(F.lit("["), "now", F.lit(","), "later", F.lit("]")).alias("requests"))))


# Contacts

STA_SEGMENT: Marks = {
    "source": ("subtask", "global_task", "k % 41 = 0"), "authority": ("cpa_final", "proposal", "k % 43 = 1"), "sha": (SHA, "x", "k % 47 = 2"), "events": ("contact_events", "events", "k % 211 = 3"), "proposals": ("[]", "null", "k % 53 = 4"),
    "id": ("e{i}", "", "k % 59 = 5"), "accepted": ("true", "false", "k % 61 = 6"), "frame": ("cpa_final", "model", "k % 67 = 7"), "valid": ("true", "false", "k % 71 = 8"), "requested": ("s", "t", "k % 73 = 9"), "candidate": ("s", "t", "k % 79 = 10"),
    "step": ("s", "t", "k % 83 = 11"), "name": ("pick cup", "pick jar", "k % 89 = 12"), "version": (contracts.STA_SAMPLING, "other", "k % 97 = 13"), "grounded": ("1", "2", "k % 101 = 14"), "corner": ("300", "50", "k % 103 = 15"),
    "box": ("single_image_vlm_event_name_grounding", "manual", "k % 107 = 16"), "origin": ("cpa_final", "model", "k % 109 = 17"), "between": ("true", "false", "k % 113 = 18"), "event": ("", "!", "k % 127 = 19"), "noun": ("cup", "jar", "k % 131 = 20"),
    "verb": ("pick", "put", "k % 137 = 21"), "until": ("0.5", "0.75", "k % 139 = 22"), "kind": ("single_random_pre_contact_image", "video", "k % 149 = 23"),
}
STA_RECORD: Marks = {
    "source": ("subtask", "global_task", "o % 11 = 0"), "sha": (SHA, "none", "o % 13 = 1"), "authority": ("cpa_final", "proposal", "o % 17 = 2"), "parent": (SHA, "none", "o % 19 = 3"), "least": ("3", "0", "o % 23 = 4"), "results": ("subtask_results", "results", "o % 211 = 5"),
    "summary": ("0", "1", "o % 29 = 6"), "sync": ("cpa_final_random_sta_observation_sync", "other", "o % 31 = 7"), "previous": ("", "no_", "o % 37 = 8"),
}


def _sta_segment() -> str:
    event_id = chosen(STA_SEGMENT["id"][2], "''", "concat('e', CAST(i AS STRING))")
    head = (
        '{"subtask":{"id":"s{{i}}","subtask":"pick the cup"},"task_instruction_source":"<source>","task_instruction":"pick the cup","result":{"contact_frame_authority":"<authority>","parent_cpa_segment_sha256":"<sha>","rejected_contact_event_proposals":<proposals>,"<events>":[{"event_id":"'
    )
    body = (
        '","accepted":<accepted>,"contact_frame_source":"<frame>","contact_frame_selection":{"valid_contact":<valid>,"requested_subtask_id":"<requested>{{i}}","selected_candidate":{"subtask_id":"<candidate>{{i}}"}},"contact_subtask_id":"<step>{{i}}",'
        '"contact_time_seconds":{{i + 1}},"contact_event_name":"<name>","object_name":"cup","contact_verb":"pick","observation_sampling":{"version":"<version>","no_intervening_cpa_final_contact":true,"selected_frame_count":1,"grounded_observation_count":<grounded>,"invisible_observation_count":0,'
    )
    previous = f"""'"', {chosen(STA_RECORD["previous"][2], "'no_'", "''")}, 'previous_contact_time_seconds":', CASE WHEN i > 0 THEN CAST(i AS STRING) ELSE 'null' END"""
    seen = (
        '},"observations":[{"bbox_xyxy_1000":[100,200,<corner>,400],"bbox_source":"<box>","contact_frame_source":"<origin>","no_intervening_cpa_final_contact":<between>,"contact_event_name":"<name><event>","next_contact_noun":"<noun>","next_contact_verb":"<verb>","time_seconds":{{i + 0.5}},"time_to_contact_seconds":<until>}]}]}}'
    )
    return f"concat({written_sql(head, STA_SEGMENT)}, {event_id}, {written_sql(body, STA_SEGMENT)}, {previous}, {written_sql(seen, STA_SEGMENT)})"


def _sta_sql() -> str:
    r, s = conditions(STA_RECORD), conditions(STA_SEGMENT)
    there, held = f"NOT ({r['results']})", f"NOT ({s['events']})"
    seg, ev = (lambda c: f"{there} AND {c}"), (lambda c: f"{there} AND {held} AND {c}")
    valid = f"NOT ({s['valid']})"
    lost = f"(SELECT count(*) FROM s WHERE s.o = r.o AND {s['events']})"
    counted_ = f"(SELECT count(*) FROM s x WHERE x.o = s.o AND x.i < s.i AND x.k % 211 <> 3)"
    # the previous contact is that of the segment before, unless that one gives no events
    before = f"(SELECT max(x.i) FROM s x WHERE x.o = s.o AND x.i < s.i AND x.k % 211 <> 3)"
    wrong = f"CASE WHEN {r['previous']} THEN {counted_} > 0 WHEN {counted_} = 0 THEN i > 0 ELSE {before} + 1 <> i END"
    by_record = {
        "wrong_result_instruction_source": r["source"], "invalid_subtask_result_hash": r["sha"], "sta_contact_frame_not_cpa_final": r["authority"], "invalid_sta_parent_cpa_hash": r["parent"], "invalid_sta_observation_policy": r["least"], "invalid_subtask_results": r["results"],
        "sta_contact_frame_summary_mismatch": f"{there} AND ({r['summary']} OR {lost} > 0)", "invalid_sta_cpa_sync_request": f"{there} AND {r['sync']}", "sta_bbox_request_count_mismatch": f"{there} AND {lost} > 0",
        "wrong_sta_bbox_request_media_kind": f"{there} AND EXISTS (SELECT 1 FROM s WHERE s.o = r.o AND {s['kind']})",
    }
    by_segment = {
        "wrong_segment_instruction_source": seg(s["source"]), "sta_segment_contact_frame_not_cpa_final": seg(s["authority"]), "invalid_sta_parent_cpa_segment_hash": seg(s["sha"]), "invalid_sta_contact_events": seg(s["events"]), "invalid_sta_rejected_contact_events": seg(s["proposals"]),
        "invalid_or_duplicate_sta_event_id": ev(s["id"]), "sta_contains_nonaccepted_contact_event": ev(s["accepted"]), "sta_event_contact_frame_not_cpa_final": ev(s["frame"]), "invalid_sta_contact_frame_selection": ev(s["valid"]),
        "sta_requested_subtask_mismatch": ev(f"{valid} AND {s['requested']}"), "sta_selected_subtask_mismatch": ev(f"{valid} AND {s['candidate']}"), "sta_contact_subtask_mismatch": ev(s["step"]), "wrong_sta_contact_event_name": ev(s["name"]),
        "invalid_sta_observation_sampling": ev(s["version"]), "sta_observation_count_mismatch": ev(f"({s['version']} OR {s['grounded']})"), "invalid_sta_observation_bbox": ev(s["corner"]), "wrong_sta_bbox_source": ev(s["box"]),
        "sta_observation_contact_frame_not_cpa_final": ev(s["origin"]), "sta_observation_allows_intervening_contact": ev(s["between"]), "sta_observation_event_name_mismatch": ev(s["event"]), "sta_observation_noun_mismatch": ev(s["noun"]), "sta_observation_verb_mismatch": ev(s["verb"]),
        "sta_observation_ttc_mismatch": ev(s["until"]), "sta_previous_contact_mismatch": ev(f"({wrong})"),
    }
    return counts_sql(by_record, by_segment)


@query(_sta_sql())
def sta_contract(spark, sf_dir):
    box = written_sql('{"stage":"cpa_final_random_observation_bbox","media_kind":"<kind>"}', STA_SEGMENT)
    rows = segments(spark, sf_dir, results=_sta_segment(), boxes=box)
    head = (
        '{"task_instruction_source":"<source>","subtask_result_sha256":"<sha>","contact_frame_authority":"<authority>","parent_cpa_result_sha256":"<parent>","sta_observation_policy":{"version":"'
        + contracts.STA_POLICY + '","contact_frame_authority":"cpa_final","bbox_input":"single_observation_image_plus_contact_event_name","observations_per_contact":<least>},"contact_frame_summary":{"accepted":{{n}},"rejected":<summary>},"<results>":['
    )
    result = F.concat(written(head, STA_RECORD), "results", F.lit("]}"))
    sync = written('[{"stage":"<sync>","parent_cpa_result_sha256":"<parent>"},', STA_RECORD)
    return counted(contracts.failures("sta", rows.select("o", result.alias("result"), F.concat(sync, "boxes", F.lit("]")).alias("requests"))))


# Other tasks and the dispatch

SUBTASK: Marks = {"field": ("subtasks", "steps", "o % 7 = 0"), "same": ("close", " OPEN", "o % 5 = 1"), "hole": ("", "null,", "o % 3 = 2")}


@query("""SELECT failure, count(*) AS n FROM (SELECT 'invalid_subtasks' AS failure FROM orders WHERE o_orderkey % 7 = 0 UNION ALL SELECT 'adjacent_identical_subtask' FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 5 = 1
UNION ALL SELECT 'invalid_subtask' FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 3 = 2) GROUP BY failure""")
def subtask_contract(spark, sf_dir):
    result = written('{"<field>":[<hole>{"subtask":"open"},{"subtask":"<same>"}]}', SUBTASK)
    return counted(contracts.failures("subtask", orders(spark, sf_dir).select("o", result.alias("result"), F.lit("[]").alias("requests"))))


@query("SELECT 'missing_result' AS failure, count(*) AS n FROM orders WHERE o_orderkey % 4 = 0")
def cpa_contract(spark, sf_dir):
    """No contract but that there is a result."""
    result = F.when(F.col("o") % 4 == 0, F.lit("[]")).otherwise(F.lit('{"any": 1}'))
    return counted(contracts.failures("cpa", orders(spark, sf_dir).select("o", result.alias("result"), F.lit("[]").alias("requests"))))


@query("""SELECT o_orderkey AS o, CASE WHEN o_orderkey % 3 = 1 THEN 5.0 WHEN o_orderkey % 3 = 2 AND o_orderkey % 2 = 0 THEN CAST(o_orderkey % 10 + 1 AS DOUBLE) END AS duration FROM orders""")
def parent_durations(spark, sf_dir):
    """The first of three places with a positive number."""
    own = F.when(F.col("o") % 3 == 1, F.lit("5.0")).when(F.col("o") % 3 == 2, F.lit("-1")).otherwise(F.lit('"x"'))
    deep = F.when((F.col("o") % 3 == 2) & (F.col("o") % 2 == 0), (F.col("o") % 10 + 1).cast("string")).otherwise(F.lit("0"))
    text = F.concat(F.lit('{"_source_duration_seconds":'), own, F.lit(',"provider_output":{"boundary_mapping":{"source_duration_seconds":'), deep, F.lit("}}}"))
    return orders(spark, sf_dir).select("o", contracts.parent_duration(F.from_json(text, contracts.PARENT)).alias("duration"))


RECORD: Marks = {
    "task": ("subtask", "grd", "o % 5 = 0"), "model": ("m", "old", "o % 7 = 1"), "provider": ("p", "q", "o % 11 = 2"), "contract": (contracts.CONTRACT_IDS["subtask"][0], "v0", "o % 13 = 3"), "same": ("close", "Open ", "o % 17 = 4"), "uid": ("input_record_uid", "other", "o % 19 = 5"),
}
FITS = "NOT (" + " OR ".join(c for _, _, c in RECORD.values()) + ")"


def _lines(spark, sf_dir: str) -> DataFrame:
    """Records of steps, one for each order, under a hundred uids a source."""
    template = (
        '{"schema_version": "' + records.RECORD_SCHEMA + '","uid": "{{o % 100}}:annotation:<task>:<model>","source_key":"s{{o % 3}}","annotations":{"robot_extension":{"annotation_task":"<task>","provider":"<provider>","model":"<model>",'
        '"result":{"subtasks":[{"subtask":"open"},{"subtask":"<same>"}]},"requests":[]}},"provenance":{"<uid>":"{{o % 100}}","source_record_uid":"x{{o % 100}}","annotation":{"contract_id":"<contract>"}}}'
    )
    return orders(spark, sf_dir).select("o", written(template, RECORD).alias("value"))


@query(f"SELECT o_orderkey AS o, {FITS.replace('o %', 'o_orderkey %')} AS compatible FROM orders")
def compatible_records(spark, sf_dir):
    return records.classified(records.parsed(_lines(spark, sf_dir)), "subtask", "m", "p").select("o", "compatible")


@query(f"WITH f AS (SELECT o_orderkey AS o, {FITS.replace('o %', 'o_orderkey %')} AS ok FROM orders) SELECT 'accepted' AS part, min(o) AS o FROM f WHERE ok GROUP BY o % 100 UNION ALL SELECT 'evidence', o FROM f WHERE NOT ok OR o NOT IN (SELECT min(o) FROM f WHERE ok GROUP BY o % 100)")
def quarantined_records(spark, sf_dir):
    rows = records.classified(records.parsed(_lines(spark, sf_dir)), "subtask", "m", "p")
    accepted, evidence = records.split_quarantine(rows, "o")
    return accepted.select(F.lit("accepted").alias("part"), "o").unionByName(evidence.select(F.lit("evidence").alias("part"), "o"))


@query("SELECT o_orderkey AS o FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 1")
def headers_rejected(spark, sf_dir):
    return _lines(spark, sf_dir).where(records.header_mismatch(F.col("value"), "subtask", "m")).select("o")


@query(f"WITH f AS (SELECT o_orderkey AS o, {FITS.replace('o %', 'o_orderkey %')} AS ok FROM orders) SELECT count(*) AS records, count(DISTINCT CASE WHEN ok AND o % 3 < 2 THEN o % 100 END) AS selected, count(*) FILTER (NOT ok) AS invalid FROM f")
def readiness(spark, sf_dir):
    return records.readiness(records.classified(records.parsed(_lines(spark, sf_dir)), "subtask", "m", "p"), sources=["s0", "s1"])


@query("""WITH o AS (SELECT o_orderkey AS o FROM orders), a AS (SELECT o, unnest(CASE WHEN o % 3 = 0 THEN ['u' || o, 'src' || o, 'in' || o] WHEN o % 3 = 1 THEN ['ep' || o, 'dir/v' || o || '.mp4', 'v' || o || '.mp4', 'v' || o] ELSE ['d' || o] END) AS alias FROM o)
SELECT o, alias, CASE WHEN o % 3 = 0 THEN 'annotation' WHEN o % 3 = 1 THEN 'foreign' ELSE 'direct' END AS subtask FROM a""")
def step_layouts(spark, sf_dir):
    """The three layouts of prior records, and the aliases under which each is found."""
    own = '{"uid":"u{{o}}","annotations":{"robot_extension":{"annotation_task":"subtask","result":{"subtasks":[{"subtask":"annotation"}]}}},"provenance":{"input_record_uid":"in{{o}}","source_record_uid":"src{{o}}"}}'
    foreign = '{"kind":"subtask","parent_episode_id":"ep{{o}}","source_video":"dir/v{{o}}.mp4","steps":[{"subtask":"foreign"}]}'
    direct = '{"input_record_uid":"d{{o}}","subtasks":[{"subtask":"direct"}]}'
    value = F.when(F.col("o") % 3 == 0, written(own, {})).when(F.col("o") % 3 == 1, written(foreign, {})).otherwise(written(direct, {}))
    rows = records.subtask_layouts(records.parsed(orders(spark, sf_dir).select("o", value.alias("value"))))
    return rows.select("o", F.explode("keys").alias("alias"), F.get_json_object("result", "$.subtasks[0].subtask").alias("subtask"))
