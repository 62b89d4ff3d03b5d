"""The boundary to models: requests answered by a pluggable function or by recorded responses.

The engine needs no network: the default provider replays a table of (request_hash, raw).  Answers are
parsed and checked in columns; errors are data.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.functions import pyfuncs

from .lookup import uncached


def request_hash(*parts: Column | str) -> Column:
    """Identity of a request: its parts with their lengths, so that no two lists of parts are alike."""
    return F.sha2(F.concat_ws("|", *[F.concat(F.coalesce(F.length(p), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(p, F.lit(""))) for p in (F.col(x) if isinstance(x, str) else x for x in parts)]), 256)


def replayed(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with their recorded raw answer, or error 'not_recorded'."""
    one = responses.groupBy("request_hash").agg(F.min("raw").alias("raw"))
    return requests.join(one, "request_hash", "left").withColumn("error", F.when(F.col("raw").isNull(), "not_recorded"))


def answered(requests: DataFrame, call: Callable[[str, str, str], str], *, attempts: int = 3, valid: Callable[[str], bool] | None = None, fallback: Callable[[str, str, str], str] | None = None) -> DataFrame:
    """(request_hash, raw, attempts, error) by ``call(task, model, prompt)`` on the executors, tried up to ``attempts`` times.

    valid decides whether an answer counts; fallback is tried once after the last failure (stills for a video).
    """

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            out = []
            for key, task, model, prompt in zip(pdf["request_hash"], pdf["task"], pdf["model"], pdf["prompt"], strict=True):
                raw = error = None
                tries = [call] * attempts + ([fallback] if fallback else [])
                n = 0
                for n, ask in enumerate(tries, 1):
                    try:
                        raw, error = ask(task, model, prompt), None
                        if valid is None or valid(raw):
                            break
                        raw, error = None, "invalid_answer"
                    except Exception as e:  # the provider's own failures are data
                        raw, error = None, type(e).__name__
                out.append((key, raw, n, error))
            yield pd.DataFrame(out, columns=["request_hash", "raw", "attempts", "error"])

    return requests.select("request_hash", "task", "model", "prompt").mapInPandas(run, "request_hash string, raw string, attempts int, error string")


def through_cache(requests: DataFrame, cache: DataFrame, call: Callable[[str, str, str], str], **options) -> tuple[DataFrame, DataFrame]:
    """(all answers, the new ones to append to the cache): the anti-join comes before any call."""
    new = answered(uncached(requests.dropDuplicates(["request_hash"]), cache), call, **options)
    return cache.select("request_hash", "raw").unionByName(new.where("error IS NULL").select("request_hash", "raw")), new


def parsed_answers(answers: DataFrame, schema: str) -> DataFrame:
    """The first JSON object of each answer by a schema; error 'response_unparseable' where there is none."""
    body = answers.withColumn("_o", pyfuncs.first_json_object("raw")).withColumn("value", F.from_json("_o", schema))
    return body.withColumn("error", F.coalesce("error", F.when(F.col("value").isNull(), "response_unparseable")) if "error" in answers.columns else F.when(F.col("value").isNull(), F.lit("response_unparseable"))).drop("_o")


def fenced_steps(raw: Column | str) -> Column:
    """The non-empty list of objects in an answer, as an array of their JSON; null if it has none.

    A code fence around it is opened; an object gives its ``subtasks``, or, if that is empty, its ``steps``.
    """
    text = F.trim(F.col(raw) if isinstance(raw, str) else raw)
    fence = r"(?is)^```(?:json)?\s*(.*?)\s*```$"
    body = F.when(text.rlike(fence), F.regexp_extract(text, fence, 1)).otherwise(text)
    body = F.when(F.try_parse_json(body).isNotNull(), body)
    listed = lambda c: F.when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>"))
    member = lambda name: F.when(F.size(listed(F.get_json_object(body, f"$.{name}"))) > 0, listed(F.get_json_object(body, f"$.{name}")))
    rows = F.when(F.ltrim(body).startswith("{"), F.coalesce(member("subtasks"), member("steps"))).otherwise(listed(body))
    return F.when((F.size(rows) > 0) & F.forall(rows, lambda r: F.coalesce(F.ltrim(r).startswith("{"), F.lit(False))), rows)


#: The answer schema of a reasoning request: fields and the longest text each may have (None: any).
ANSWER_FIELDS = {"scene_description": None, "task_progress": None, "atomic_action": 240}
STEP_FIELDS = {"subtask": None, "action": 80, "object": 120, "source": 160, "target": 160}


def response_schema() -> dict:
    """The strict JSON schema that a reasoning request asks the provider to answer by."""
    text = lambda most: {"type": "string", "minLength": 1} | ({"maxLength": most} if most else {})
    closed = lambda properties, order: {"type": "object", "additionalProperties": False, "required": order, "properties": properties}
    step = closed({f: text(n) for f, n in STEP_FIELDS.items()}, list(STEP_FIELDS))
    order = ["scene_description", "task_progress", "current_subtask", "atomic_action"]
    return {"name": "privileged_video_ecot_atomic_v2", "strict": True, "schema": closed({f: text(n) for f, n in ANSWER_FIELDS.items()} | {"current_subtask": step}, order)}


def schema_errors(answer: Column | str) -> Column:
    """Paths at which an answer (JSON text) breaks ``response_schema``: missing or further fields, no text, empty or too long."""
    body = F.col(answer) if isinstance(answer, str) else answer

    def level(text: Column, prefix: str, fields: dict[str, int | None], objects: tuple[str, ...] = ()) -> list[Column]:
        keys = F.coalesce(F.json_object_keys(text), F.array().cast("array<string>"))
        known = F.array(*[F.lit(f) for f in (*fields, *objects)])
        found = [F.transform(F.array_sort(F.array_except(keys, known)), lambda k: F.concat(F.lit(f"{prefix}additional:"), k))]
        for f in objects:
            found.append(F.when(~F.coalesce(F.ltrim(F.get_json_object(text, f"$.{f}")).startswith("{"), F.lit(False)), F.array(F.lit(f"{prefix}{f}"))))
        for f, most in fields.items():
            value = F.try_variant_get(F.try_parse_json(text), f"$.{f}", "string")
            is_text = F.schema_of_variant(F.try_variant_get(F.try_parse_json(text), f"$.{f}", "variant")) == "STRING"
            bad = ~F.coalesce(is_text & (F.length(value) >= 1) & (F.length(value) <= (most or 1 << 30)), F.lit(False))
            found.append(F.when(bad, F.array(F.lit(f"{prefix}{f}"))))
        return found

    none = F.array().cast("array<string>")
    step = F.get_json_object(body, "$.current_subtask")
    rows = level(body, "", ANSWER_FIELDS, ("current_subtask",)) + level(step, "current_subtask.", STEP_FIELDS)
    return F.flatten(F.array(*[F.coalesce(r, none) for r in rows]))


def rewrite_in_batches(lines: DataFrame, call: Callable[[list[str]], list[str]], *, size: int = 32) -> DataFrame:
    """(id, line, rewritten): chunks of up to ``size`` lines; a chunk that comes back with another count is halved."""

    def split(chunk: list[str]) -> list[str | None]:
        got = call(chunk)
        if len(got) == len(chunk):
            return list(got)
        if len(chunk) == 1:
            return [None]
        half = len(chunk) // 2
        return split(chunk[:half]) + split(chunk[half:])

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            text = pdf["line"].tolist()
            done = [x for k in range(0, len(text), size) for x in split(text[k : k + size])]
            yield pdf.assign(rewritten=done)

    return lines.select("id", "line").mapInPandas(run, "id bigint, line string, rewritten string")


def provenance_mix(frames: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Frames by provider and model, sorted, where a record mixes them; homogeneous records give no row."""
    counts = frames.groupBy(uid, "provider", "model").agg(F.count("*").alias("n"))
    mix = counts.groupBy(uid).agg(F.array_sort(F.collect_list(F.struct("provider", "model", "n"))).alias("mix"))
    return mix.where(F.size("mix") > 1)


def prior_units(units: DataFrame, wanted: DataFrame) -> DataFrame:
    """Prior units classified against the wanted identities: reason is null for one to reuse, else the first check that fails."""
    rows = units.join(wanted.select("uid", "unit_key", F.struct("prompt_sha", "question_sha", "schema", "frame").alias("_w")), ["uid", "unit_key"], "left")
    reason = F.when(F.col("_w").isNull(), "not_wanted")
    for c in ("schema", "prompt_sha", "question_sha", "frame"):
        reason = reason.when(~F.col(c).eqNullSafe(F.col(f"_w.{c}")), f"{c}_differs")
    return rows.withColumn("reason", reason.when(F.col("value").isNull(), "empty")).drop("_w")


def token_usage(usage: Column, model: Column | str) -> Column:
    """The first usage entry of a model."""
    name = F.lit(model) if isinstance(model, str) else model
    return F.get(F.filter(usage, lambda u: u["model"] == name), F.lit(0))
