"""Record assembly: output records, geometry rows, media references, compatibility and stage audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions.scalar import blank_to_null

from .contracts import CONTRACT_IDS, failures
from .sets import keep_first

#: The record schema and the models that one task's records may name besides the wanted one.
RECORD_SCHEMA, AUDIT_SCHEMA = "unified-vqa-record/v2", "vqa-annotation-stage-audit/v2"
ALSO_ACCEPTED = {("sta", "doubao-seed-2-1-turbo-260628"): ("doubao-seed-2-0-lite-260215",)}

ENVELOPE = (
    "struct<schema_version:string,uid:string,source_key:string,split:string,kind:string,annotations:struct<robot_extension:struct<annotation_task:string,provider:string,model:string,result:string,requests:string>>,"
    "provenance:struct<input_record_uid:string,source_record_uid:string,source_locator:struct<source_file:string,storage_kind:string>,annotation:struct<contract_id:string,model:string,provider:string>>,"
    "steps:string,subtasks:string,input_record_uid:string,parent_episode_id:string,video_id:string,source_video:string,task_instruction:string>"
)


def parsed(lines: DataFrame, *, value: str = "value") -> DataFrame:
    """Envelope columns of JSON records, with result and requests as JSON text; corrupt is set for a line that is no object."""
    rows = lines.withColumn("_r", F.from_json(value, ENVELOPE))
    ext, prov = "_r.annotations.robot_extension", "_r.provenance"
    body = lambda path: F.get_json_object(value, f"$.annotations.robot_extension.{path}")
    return rows.select(
        *lines.columns, F.col("_r.uid").alias("record_uid"), F.col("_r.source_key").alias("source_key"), F.col(f"{ext}.annotation_task").alias("task"), F.col(f"{ext}.provider").alias("provider"), F.col(f"{ext}.model").alias("model"),
        body("result").alias("result"), body("requests").alias("requests"), F.col(f"{prov}.input_record_uid").alias("uid"), F.col(f"{prov}.source_record_uid").alias("source_uid"), F.col(f"{prov}.source_locator.source_file").alias("path"),
        F.col(f"{prov}.annotation.contract_id").alias("contract_id"), (F.col(f"{ext}").isNull() | F.col(f"{prov}.annotation").isNull() | ~F.col(f"{prov}.input_record_uid").isNotNull()).alias("corrupt"),
        F.col("_r.kind").alias("kind"), F.get_json_object(value, "$.steps").alias("steps"), F.get_json_object(value, "$.subtasks").alias("subtasks"), F.col("_r.input_record_uid").alias("direct_uid"),
        F.array_compact(F.array("_r.parent_episode_id", "_r.video_id", "_r.source_video")).alias("foreign_ids"), F.col("_r.task_instruction").alias("task_instruction"),
    )


def subtask_layouts(records: DataFrame) -> DataFrame:
    """The three layouts of prior step records as (keys, result JSON); rows of no layout go."""
    annotation = (F.col("task") == "subtask") & F.coalesce(F.col("result").startswith("{"), F.lit(False))
    foreign = (F.col("kind") == "subtask") & F.coalesce(F.col("steps").startswith("["), F.lit(False))
    direct = F.coalesce(F.col("subtasks").startswith("["), F.lit(False)) & F.col("direct_uid").isNotNull()
    video = F.element_at("foreign_ids", -1)
    name = F.element_at(F.split(video, "/"), -1)
    keys = F.when(annotation, F.array("record_uid", "source_uid", "uid", "path")).when(foreign, F.concat("foreign_ids", F.array(name, F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")))).when(direct, F.array("direct_uid"))
    wrap = F.concat(F.lit('{"subtasks":'), F.col("steps"), F.lit("}"))
    result = F.when(annotation, F.col("result")).when(foreign, wrap).when(direct, F.concat(F.lit('{"subtasks":'), F.col("subtasks"), F.lit("}")))
    rows = records.withColumn("keys", F.filter(F.array_distinct(F.array_compact(keys)), lambda k: k != "")).withColumn("result", result)
    return rows.where(F.col("result").isNotNull() & (F.size("keys") > 0))


def header_mismatch(value: Column, task: str, model: str) -> Column:
    """Cheap test on the first 4096 characters: the record's uid names another task or model."""
    head = F.substring(value, 1, 4096)
    uid = F.regexp_extract(head, r'"uid"\s*:\s*"((?:[^"\\]|\\.)*)"', 1)
    return F.coalesce(head.contains(f'"schema_version": "{RECORD_SCHEMA}"') & (uid != "") & ~uid.endswith(f":annotation:{task}:{model}"), F.lit(False))


def classified(records: DataFrame, task: str, model: str, provider: str) -> DataFrame:
    """Adds compatible: identity and contract fit.  Failures are counted in the same pass."""
    models = (model, *ALSO_ACCEPTED.get((task, model), ()))
    rows = failures(task, records)
    fits = ~F.col("corrupt") & (F.col("task") == task) & F.col("model").isin(*models) & (F.col("provider") == provider) & F.col("contract_id").isin(*CONTRACT_IDS[task]) & (F.col("uid") != "")
    return rows.withColumn("compatible", F.coalesce(fits & (F.size("failures") == 0), F.lit(False)))


def split_quarantine(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """(accepted: the first compatible record of each uid, evidence: all others) from ``classified`` rows."""
    accepted = keep_first(rows.where("compatible"), "uid", *order)
    return accepted, rows.join(accepted.select(*order), list(order), "left_anti")


def audit(lines: DataFrame, *, task: str, provider: str, model: str, contract_id: str, order: tuple[str, ...] = ("file", "line"), value: str = "value") -> DataFrame:
    """Each record of a stage with its failures: identity, contract, empty and repeated uids (the first in order is none)."""
    rows = failures(task, parsed(lines.where(F.trim(value) != ""), value=value), result="result", requests="requests")
    first = rows.where(~F.col("corrupt") & (F.col("uid") != "")).groupBy("uid").agg(F.min(F.struct(*order)).alias("_first"))
    rows = rows.join(first, "uid", "left")
    differs = lambda c, want: ~F.col(c).eqNullSafe(F.lit(want))
    own = F.array_compact(
        F.array(
            F.when(differs("task", task), "wrong_annotation_task"), F.when(differs("provider", provider), "wrong_provider"), F.when(differs("model", model), "wrong_model"), F.when(differs("contract_id", contract_id), "wrong_contract"),
        )
    )
    uid = F.array_compact(F.array(F.when(F.col("uid") == "", "empty_input_uid").when(F.struct(*order) != F.col("_first"), "duplicate_input_uid")))
    return rows.withColumn("failures", F.when(F.col("corrupt"), F.array(F.lit("invalid_record"))).otherwise(F.concat(own, "failures", uid))).drop("_first")


def audit_summary(audited: DataFrame, *, expected: int, expected_by_source: DataFrame | None = None) -> DataFrame:
    """(figure, key, n): records, distinct uids, records by source, failures by name, and the expectations that fail."""
    one = audited.agg(F.count("*").alias("records"), F.count_distinct(F.when(~F.col("corrupt") & (F.col("uid") != ""), F.col("uid"))).alias("unique"))
    totals = one.select(F.inline(F.array(F.struct(F.lit("records").alias("figure"), F.lit("").alias("key"), F.col("records").alias("n")), F.struct(F.lit("unique_uids").alias("figure"), F.lit("").alias("key"), F.col("unique").alias("n")))))
    by_source = audited.where(~F.col("corrupt")).groupBy(F.coalesce(blank_to_null("source_key"), F.lit("unknown")).alias("key")).agg(F.count("*").alias("n"))
    by_name = audited.select(F.explode("failures").alias("key")).groupBy("key").agg(F.count("*").alias("n"))
    unmet = one.select(F.inline(F.array(F.struct(F.lit("failure").alias("figure"), F.lit("unexpected_record_count").alias("key"), (F.col("records") != expected).cast("bigint").alias("n")), F.struct(F.lit("failure").alias("figure"), F.lit("unexpected_unique_uid_count").alias("key"), (F.col("unique") != expected).cast("bigint").alias("n"))))).where("n > 0")
    out = totals.unionByName(by_source.select(F.lit("source").alias("figure"), "key", "n")).unionByName(by_name.select(F.lit("failure").alias("figure"), "key", "n")).unionByName(unmet)
    if expected_by_source is not None:
        wanted = expected_by_source.select("key", F.col("n").alias("_w"))
        off = by_source.join(wanted, "key", "full_outer").where(~F.col("n").eqNullSafe(F.col("_w"))).agg(F.least(F.count("*"), F.lit(1)).alias("n")).where("n > 0")
        out = out.unionByName(off.select(F.lit("failure").alias("figure"), F.lit("unexpected_source_counts").alias("key"), "n"))
    return out


def audit_examples(audited: DataFrame, n: int = 20, order: tuple[str, ...] = ("file", "line")) -> DataFrame:
    """The first failing records in order: a report's examples."""
    return audited.where(F.size("failures") > 0).orderBy(*order).limit(n).select(*order, "failures")


def make_records(rows: DataFrame, *, task: str, model: str, provider: str) -> DataFrame:
    """Output records from uid, source_key, split, prompt, result (JSON), status, reason, input_locator, source_uid, media, kept_segments.

    kept_segments counts accepted segments: a grounding record without any is dropped from training.
    """
    graded = F.lit(task == "grd")
    empty = graded & (F.col("kept_segments") == 0)
    turn = lambda role, text, loss, k: F.struct(F.lit(role).alias("role"), text.alias("content"), F.lit("").alias("thinking"), loss.alias("loss"), F.lit(k).alias("source_turn_index"))
    return rows.select(
        F.lit(RECORD_SCHEMA).alias("schema_version"), F.concat("uid", F.lit(f":annotation:{task}:{model}")).alias("uid"), "source_key", "split",
        F.struct(F.lit(False).alias("thinking_enabled"), F.array(turn("user", F.col("prompt"), F.lit(False), 0), turn("assistant", F.col("result"), ~empty, 1)).alias("turns")).alias("dialogue"),
        "media", F.struct(F.struct(F.lit(task).alias("annotation_task"), F.lit(provider).alias("provider"), F.lit(model).alias("model"), F.col("result")).alias("robot_extension")).alias("annotations"),
        F.struct(
            F.when(empty, "drop").when(F.col("status") == "deferred", "defer").otherwise("keep").alias("grounding_decision"), F.struct(F.coalesce("status", F.lit("accepted")).alias("status")).alias("vlm"),
            F.when(F.col("status") == "deferred", F.struct(F.col("reason"))).alias("defer"),
        ).alias("cleaning"),
        F.struct(
            F.col("uid").alias("input_record_uid"), F.coalesce("source_uid", "uid").alias("source_record_uid"),
            F.struct(F.lit(CONTRACT_IDS[task][0]).alias("contract_id"), F.col("input_locator"), F.lit(model).alias("model"), F.lit(provider).alias("provider"), F.lit(task in ("grd", "sta", "cpa")).alias("subtask_conditioned"), F.lit({"ecot": "global_task", "subtask": None}.get(task, "subtask")).cast("string").alias("task_instruction_source")).alias("annotation"),
        ).alias("provenance"),
    )


def media_references(items: Column, locator: Column) -> Column:
    """Items (member, relative_path, container_format) addressed inside a tar, or by the file itself."""
    tar = locator.endswith(".tar")

    def one(x: Column) -> Column:
        done = (x["container_format"] == "tar") & x["member"].isNotNull()
        return F.when(F.coalesce(done, F.lit(False)), x).otherwise(
            x.withField("relative_path", F.when(tar, locator).otherwise(F.coalesce(F.nullif(x["relative_path"], F.lit("")), locator))).withField("member", F.when(tar, x["member"])).withField("container_format", F.when(tar, F.lit("tar")).otherwise(x["container_format"]))
        )

    return F.transform(items, one)


def frame_geometry(objects: DataFrame) -> DataFrame:
    """Geometry rows of grounded objects: uid, segment, step_id, frame, media_index, pos, name, bbox."""
    rows = objects.where(F.size("bbox") == 4)
    ident = F.format_string("grd:segment-%d:frame-%d:object-%d", "segment", "frame", "pos")
    return rows.select("uid", ident.alias("geometry_id"), F.lit("bbox").alias("type"), F.struct(F.col("step_id").alias("subtask_id"), "media_index").alias("binding"), F.struct(F.lit("xyxy").alias("order"), F.lit("norm1000").alias("unit"), F.col("bbox").alias("value")).alias("canonical"), F.col("name").alias("label"))


def observation_geometry(observations: DataFrame, task: str) -> DataFrame:
    """Geometry rows of observed boxes: uid, segment, step_id, event, observation, time_seconds, bbox."""
    rows = observations.where(F.size("bbox") == 4)
    ident = F.format_string(f"{task}:segment-%d:event-%d:observation-%d:bbox", "segment", "event", "observation")
    binding = F.struct(F.col("step_id").alias("subtask_id"), F.col("event").alias("event_index"), F.col("observation").alias("observation_index"), "time_seconds")
    return rows.select("uid", ident.alias("geometry_id"), F.lit("bbox").alias("type"), binding.alias("binding"), F.struct(F.lit("xyxy").alias("order"), F.lit("norm1000").alias("unit"), F.col("bbox").alias("value")).alias("canonical"))


def point_geometry(pairs: DataFrame, task: str) -> DataFrame:
    """Geometry rows of contact points: uid, segment, event, observation (null: the event itself), pair_index, h_xy, o_xy."""
    both = F.array(*[F.struct(F.lit(r).alias("participant_role"), F.col(c).alias("xy")) for r, c in (("contact_agent", "h_xy"), ("contact_object", "o_xy"))])
    rows = pairs.select("uid", "segment", "step_id", "event", "observation", "pair_index", F.inline(F.filter(both, lambda p: F.coalesce(F.size(p["xy"]) == 2, F.lit(False)))))
    place = F.concat(F.format_string(f"{task}:segment-%d:event-%d", "segment", "event"), F.when(F.col("observation").isNotNull(), F.format_string(":observation-%d", "observation")).otherwise(""), F.format_string(":pair-%d:", "pair_index"), F.col("participant_role"))
    return rows.select("uid", place.alias("geometry_id"), F.lit("point").alias("type"), F.struct(F.col("step_id").alias("subtask_id"), F.col("event").alias("event_index"), F.col("observation").alias("observation_index")).alias("binding"), F.struct(F.lit("xy").alias("order"), F.lit("norm1000").alias("unit"), F.col("xy").alias("value")).alias("canonical"), "participant_role", "pair_index")


def task_text(name: Column, text: Column, turns: Column, limit: int = 12000) -> Column:
    """The task's name, else its text, else the dialogue; the end of long ones."""
    said = F.array_join(F.transform(turns, lambda t: F.concat(F.coalesce(t["role"], F.lit("unknown")), F.lit(": "), F.coalesce(t["content"], F.lit("")))), "\n")
    head = lambda c: F.concat(F.lit("Task instruction: "), blank_to_null(c))
    return F.coalesce(head(name), F.right(head(text), F.lit(limit)), F.right(said, F.lit(limit)))


def is_temporal(items: Column, kinds: tuple[str, ...] = ("video", "frame")) -> Column:
    return F.coalesce(F.exists(items, lambda x: F.lower(x["type"]).isin(*kinds)), F.lit(False))


def renested(rows: DataFrame, *, key: str, order: str, fields: list[str], into: str) -> DataFrame:
    """Flat rows back to one record per key, with an ordered array of structs."""
    whole = F.array_sort(F.collect_list(F.struct(order, *[f for f in fields if f != order])))
    return rows.groupBy(key).agg(whole.alias(into), F.count("*").alias("n"))


def public_scope(rows: DataFrame) -> DataFrame:
    """Without the private columns, whose names begin with an underscore."""
    return rows.select(*[c for c in rows.columns if not c.startswith("_")])


def student_records(examples: DataFrame, *, task: str = "cpa", model: str = "m") -> DataFrame:
    """One record for each learner example (uid, id, prompt, answer_text, media): the episode's media stays out of it."""
    turn = lambda role, text, loss: F.struct(F.lit(role).alias("role"), text.alias("content"), F.lit(loss).alias("loss"))
    return examples.select(
        F.concat("uid", F.lit(f":annotation:{task}:{model}:"), "id").alias("uid"), F.array("media").alias("media"), F.struct(F.lit(False).alias("thinking_enabled"), F.array(turn("user", F.col("prompt"), False), turn("assistant", F.col("answer_text"), True)).alias("turns")).alias("dialogue"),
    )


def step_index(records: DataFrame) -> DataFrame:
    """(alias, result) of prior step records of all layouts, ready for a lookup; ``sets.conflicts`` finds disagreements."""
    return subtask_layouts(records).select(F.explode("keys").alias("alias"), F.col("result"))


def readiness(records: DataFrame, *, sources: list[str] | None = None) -> DataFrame:
    """(records, selected, invalid) of classified records: how many uids of the sources could be handed on."""
    wanted = F.col("source_key").isin(*sources) if sources else F.lit(True)
    return records.agg(F.count("*").alias("records"), F.count_distinct(F.when(F.col("compatible") & wanted, F.col("uid"))).alias("selected"), F.count_if(~F.col("compatible")).alias("invalid"))
