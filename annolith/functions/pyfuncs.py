"""Arrow-batched functions for what column expressions cannot say exactly: canonical JSON, Python's seeded
generator, rounding to significant digits, and the first JSON value of an answer."""

from __future__ import annotations

import hashlib
import json
import random
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The four canonical forms of JSON that digests are taken of.
FORMS = {
    "spaced": dict(sort_keys=True, ensure_ascii=False),
    "compact": dict(ensure_ascii=False, separators=(",", ":")),
    "sorted-compact": dict(sort_keys=True, ensure_ascii=False, separators=(",", ":")),
    "ascii": dict(sort_keys=True),
}

KINDS = {"string": T.StringType(), "double": T.DoubleType(), "array<int>": T.ArrayType(T.IntegerType())}


def _typed(f, kind: str):
    """A pandas UDF over Arrow batches from a function of one row's values."""

    def run(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in parts:
            columns = columns if isinstance(columns, tuple) else (columns,)
            yield pd.Series([f(*row) for row in zip(*columns, strict=True)], dtype=object)

    n = f.__code__.co_argcount
    run.__annotations__ = {"parts": Iterator[pd.Series] if n == 1 else Iterator[tuple[(pd.Series,) * n]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, KINDS[kind])


def canonical_text(text: str | None, form: str) -> str | None:
    return None if text is None else json.dumps(json.loads(text), **FORMS[form])


def canonical_json(form: str):
    """A function of a JSON column that writes it in one of FORMS."""

    def write(text):
        return canonical_text(text, form)

    return _typed(write, "string")


def json_digest(form: str):
    """SHA-256 of a JSON column in one of FORMS."""

    def digest(text):
        return None if text is None else hashlib.sha256(canonical_text(text, form).encode()).hexdigest()

    return _typed(digest, "string")


def first_object(text: str | None) -> str | None:
    """The first JSON object of an answer as compact JSON: a code fence is opened, what follows the object ignored."""
    if text is None:
        return None
    body = text.strip()
    fence = re.fullmatch(r"```(?:json)?\s*(.*?)\s*```", body, re.S | re.I)
    body = fence[1].strip() if fence else body
    at = body.find("{")
    if at < 0:
        return None
    try:
        got = json.JSONDecoder().raw_decode(body, at)[0]
    except ValueError:
        return None
    return json.dumps(got, **FORMS["compact"])


first_json_object = _typed(first_object, "string")


def first_bare_object(text: str | None) -> str | None:
    """The object that begins at the first brace, whatever stands before and after it."""
    at = (text or "").find("{")
    try:
        return None if at < 0 else json.dumps(json.JSONDecoder().raw_decode(text, at)[0], **FORMS["compact"])
    except ValueError:
        return None


first_json_object_unfenced = _typed(first_bare_object, "string")


def three_digits(x: float | None) -> float | None:
    return None if x is None or not 0 <= x <= 1 else float(f"{x:.3g}")


three_significant = _typed(three_digits, "double")


def seeded_ranks(n: int | None, count: int | None, seed: str | None) -> list[int]:
    """Which of n places a sample without replacement takes, sorted; the seed is the head of the SHA-256 of a compact JSON list."""
    if not n or n <= 0 or not count or count <= 0:
        return []
    generator = random.Random(int(hashlib.sha256(seed.encode()).hexdigest()[:16], 16))
    return sorted(generator.sample(range(n), min(count, n)))


sampled_ranks = _typed(seeded_ranks, "array<int>")


def history(start: int | None, query: int | None, fps: float | None, rate: float = 5.0) -> list[int] | None:
    """Frames back from the query at ``rate`` a second; null for a bad interval or a slower source."""
    if start is None or query is None or fps is None or not 0 <= start <= query or not rate <= fps < float("inf"):
        return None
    n = int((query - start) * rate // fps)
    return [query - round(k * fps / rate) for k in range(n, -1, -1)]


def _history(start, query, fps):
    return history(start, query, fps)


history_frames = _typed(_history, "array<int>")

