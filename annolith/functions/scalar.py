"""Column functions: rounding, text, boxes, identifiers and response classes (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Response classes and the tokens that mark them.
TOKEN_RATE_WORDS = ("tpm", "tokens per minute", "tokenratelimit", "token rate")
REQUEST_RATE_WORDS = ("rpm", "requests per minute", "requestratelimit")
FATAL_WORDS = ("insufficient_quota", "account balance", "billing", "overdue-payment", "overdue payment", "arrearage", "account is in good standing")
REJECTION_CODE = "data_inspection_failed"
VIEW_ORDER = ("ego", "head_left", "head_right", "left_wrist", "right_wrist")
TASK_NAME_CHARS = 80


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def half_even(x: Column | str, digits: int = 0) -> Column:
    """Rounds ties to the even neighbour; ``round`` would take them away from zero."""
    return F.bround(col(x), digits)


def finite(x: Column | str) -> Column:
    """Not null, not NaN, not infinite."""
    x = col(x)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))


def two_decimal(x: Column | str) -> Column:
    """Half-up on the decimal text of x; null outside [0, 1]."""
    x = col(x)
    return F.when(finite(x) & x.between(0, 1), F.round(x.cast("string").cast("decimal(38,18)"), 2).cast("double"))


def collapse(x: Column | str) -> Column:
    """Every run of Unicode white space becomes one blank; the ends are trimmed."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(F.trim(col(x)), F.lit(""))


def skill_words(x: Column | str) -> Column:
    """camelCase, snake_case and dashes to lower-case words; 'None' if nothing is left."""
    spaced = F.regexp_replace(F.coalesce(col(x), F.lit("")), "(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.coalesce(F.nullif(F.lower(collapse(F.regexp_replace(spaced, "[_-]+", " "))), F.lit("")), F.lit("None"))


def sentence(x: Column | str) -> Column:
    """Collapsed text; a full stop if it has no mark of an end anywhere; null if empty."""
    text = collapse(x)
    return F.when(F.length(text) > 0, F.when(text.rlike("[.!?]"), text).otherwise(F.concat(text, F.lit("."))))


def casefold(x: Column | str) -> Column:
    """Unicode case folding: lower case of upper case joins what one of them alone keeps apart (eszett, final sigma, ligatures).

    The dotless i, which upper case would join with i, is put aside meanwhile; the optimizer takes lower case of upper case
    for one conversion, so the translation that brings it back stands between the two.
    """
    upper = F.upper(F.translate(col(x), "\u0131\u1e9e", "\ue000\u00df"))
    return F.translate(F.lower(F.translate(upper, "\ue000", "\u0131")), "\u03c2", "\u03c3")


#: The two endings of a progress text, and words that betray context the learner does not have.
COMPLETE, INCOMPLETE = "Task complete.", "Task not yet complete."
LEAK = (
    r"(?iU)\b(?:future frames?|past frames?|timestamps?|progress percentage|episode progress|later in the episode|earlier in the episode|"
    r"(?:in|from|throughout)\s+(?:the\s+)?video|(?:the\s+)?video\s+(?:shows?|reveals?|indicates?|depicts?|demonstrates?|context|frames?))\b"
)
#: How a text may state the judgment, strongest first.  A denial that closes the text gives way to the ending unless it
#: gives a reason; a sentence about the task that ends in a verdict is kept, with the ending after it.
DENIAL = r"(?iU)(?:^|(?<=[.!?;]))\s*(?:the\s+)?task\s+(?:is\s+)?not\s+(?:yet\s+)?complete(\s+(?:as|because)\s+[^.!?;]+)?[.!]?$"
VERDICT = r"(?iU)\b(?:is|are)\s+(not\s+(?:yet\s+)?)?complete[.!]?$"
ABOUT_TASK, HEDGED = r"(?iU)(?<!sub)\btasks?\b", r"(?iU)\b(?:may|might|could)\b|^if |[\"']|\?$"


def completion_suffix(x: Column | str) -> Column:
    """A progress text with the canonical ending where it states the judgment; unchanged where it does not.

    Conditionals, quotes and questions state none, nor do sentences about a subtask.
    """
    text = col(x)
    body = F.regexp_replace(text, r"(?U)\s+$", "")
    kept = F.regexp_replace(body, "[.!]+$", "")
    last = F.trim(F.element_at(F.split(body, r"(?U)(?<=[.!;])\s+"), -1))
    before = F.regexp_replace(F.regexp_replace(body, DENIAL, ""), r"(?U)\s+$", "")
    ended = [F.when(F.lower(body).endswith(e.lower()), F.concat(F.substr(body, F.lit(1), F.length(body) - len(e)), F.lit(e))) for e in (INCOMPLETE, COMPLETE)]
    denied = F.when(body.rlike(DENIAL), F.when(F.regexp_extract(body, DENIAL, 1) != "", F.concat(kept, F.lit(f"; {INCOMPLETE}"))).otherwise(F.concat_ws(" ", F.nullif(before, F.lit("")), F.lit(INCOMPLETE))))
    verdict = F.concat(kept, F.when(F.regexp_extract(last, VERDICT, 1) != "", F.lit(f"; {INCOMPLETE}")).otherwise(F.lit(f"; {COMPLETE}")))
    stated = F.when(last.rlike(VERDICT) & last.rlike(ABOUT_TASK) & ~last.rlike(HEDGED), verdict)
    return F.coalesce(*ended, denied, stated, text)


def leaked_phrase(x: Column | str) -> Column:
    """The first phrase, in lower case, that betrays privileged context; null if there is none."""
    return F.lower(F.nullif(F.regexp_extract(col(x), LEAK, 0), F.lit("")))


def progress_sentence(x: Column | str) -> Column:
    """A sentence whose completion suffix follows a semicolon, not a full stop."""
    return F.regexp_replace(sentence(x), r"\.(?:\s+|\s*;\s*)(Task (?:not yet )?complete\.)$", "; $1")


def event_name(verb: Column | str, thing: Column | str) -> Column:
    return F.concat_ws(" ", blank_to_null(verb), blank_to_null(thing))


def tokens(x: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(col(x)), F.lit("[a-z0-9]+"), F.lit(0))


def task_name(description: Column | str, name: Column | str, limit: int = TASK_NAME_CHARS) -> Column:
    """The first that fits, else the first that is there, cut; null if both are blank."""
    texts = [collapse(F.coalesce(col(x), F.lit(""))) for x in (description, name)]
    fits = [F.when(F.length(t).between(1, limit), t) for t in texts]
    cut = [blank_to_null(F.substring(F.nullif(t, F.lit("")), 1, limit)) for t in texts]
    return F.coalesce(*fits, *cut)


def prompt_task_name(prompt: Column | str, limit: int = TASK_NAME_CHARS) -> Column:
    """The global task in a prompt: three phrasings, else the answer or the last assistant's words."""
    context = collapse(F.element_at(F.split(col(prompt), r"Global task context:\n"), -1))
    #: How prompts state the task.
    phrasings = (
        r"(?i)(?:the\s+)?(?:agent|robot)(?:\s+in\s+the\s+video)?\s+was\s+given\s+the\s+instruction\s*[-:]\s*(.+?)(?:[?.]|$)",
        r"(?i)current\s+goal\s+is\s*:\s*(.+?)(?:[?.]|\blast\s+\d+\s+steps\s*:|$)",
        r"(?i)^(?:task\s+instruction|task|instruction)\s*:\s*(.+)$",
    )
    last = F.element_at(F.split(context, r"(?i)\bassistant\s*:\s*"), -1)
    answer = F.nullif(F.regexp_extract(last, r"(?is)<answer>\s*(.*?)\s*</answer>", 1), F.lit(""))
    plain = F.regexp_replace(last, r"(?is)<think>.*?</think>", "")
    found = F.coalesce(*[F.nullif(F.regexp_extract(context, p, 1), F.lit("")) for p in phrasings], answer, plain)
    return blank_to_null(F.substring(F.regexp_replace(F.trim(found), r"(?i)^(?:user|assistant)\s*:\s*", ""), 1, limit))


def embodiment(*fields: Column, configured: str = "auto") -> Column:
    if configured in ("human", "robot"):
        return F.lit(configured)
    return F.when(F.lower(F.concat_ws(" ", *fields)).rlike("human|egodex|ego4d"), F.lit("human")).otherwise(F.lit("robot"))


def mime_type(explicit: Column | str, member: Column | str, kind: Column | str) -> Column:
    """What is stated, else by the member's suffix, else by the kind of medium."""
    #: Media types by suffix.
    by_suffix = {"mp4": "video/mp4", "m4v": "video/x-m4v", "mov": "video/quicktime", "avi": "video/x-msvideo", "mkv": "video/x-matroska", "webm": "video/webm", "jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png", "gif": "image/gif", "webp": "image/webp", "json": "application/json", "txt": "text/plain"}
    table = F.create_map(*[F.lit(x) for pair in by_suffix.items() for x in pair])
    kind = F.lower(col(kind))
    return F.coalesce(
        F.lower(blank_to_null(explicit)),
        F.try_element_at(table, F.lower(F.regexp_extract(col(member), r"\.([^./]+)$", 1))),
        F.when(kind == "video", "video/mp4").when(kind.isin("image", "frame"), "image/jpeg"),
        F.lit("application/octet-stream"),
    )


def primary_view(views: Column | str) -> Column:
    """Of a map from view to member: the first of VIEW_ORDER, else the smallest name."""
    views = col(views)
    return F.coalesce(*[F.when(F.map_contains_key(views, F.lit(v)), F.lit(v)) for v in VIEW_ORDER], F.array_min(F.map_keys(views)))


def shard_location(name: Column | str) -> Column:
    """train-NNNNNN.tar to shards/<two hex digits of N mod 64>/name; null for other names."""
    name = col(name)
    number = F.regexp_extract(name, r"^train-(\d{6})\.tar$", 1)
    return F.when(number != "", F.concat(F.lit("shards/"), F.lpad(F.lower(F.hex(number.cast("bigint") % 64)), 2, "0"), F.lit("/"), name))


# Boxes and points on the grid 0..1000


def valid_box(box: Column | str) -> Column:
    """Four finite numbers, ordered and on the grid."""
    b = col(box)
    at = lambda k: F.get(b, F.lit(k))
    return F.coalesce((F.size(b) == 4) & F.forall(b, finite) & (at(0) >= 0) & (at(0) < at(2)) & (at(2) <= 1000) & (at(1) >= 0) & (at(1) < at(3)) & (at(3) <= 1000), F.lit(False))


def rounded_box(box: Column | str) -> Column:
    """Rounded to whole numbers, or null if that is no valid box."""
    whole = F.transform(col(box), lambda v: F.bround(v))
    return F.when(valid_box(whole), F.transform(whole, lambda v: v.cast("int")))


def box_center(box: Column | str) -> Column:
    b = col(box)
    return F.array(*[F.bround((F.get(b, F.lit(k)) + F.get(b, F.lit(k + 2))) / 2).cast("int") for k in (0, 1)])


def grid_to_pixel(v: Column, size: Column) -> Column:
    return v / 1000 * F.greatest(F.lit(1), size - 1)


def pixel_to_grid(p: Column, size: Column) -> Column:
    return F.bround(p / F.greatest(F.lit(1), size - 1) * 1000).cast("int")


def crop_to_full(v: Column, low: Column, high: Column, full: Column) -> Column:
    """One coordinate of a point in a crop (pixels low..high) to the grid of the full image."""
    return pixel_to_grid(low + grid_to_pixel(v, high - low), full)


def expanded_crop(box: Column | str, width: Column, height: Column, padding: float) -> Column:
    """The padded box in pixels, inside the image; null for a bad box or one under two pixels."""
    b = col(box)
    sides = []
    for k, size in ((0, width), (1, height)):
        low, high = F.get(b, F.lit(k)) / 1000 * size, F.get(b, F.lit(k + 2)) / 1000 * size
        pad = (high - low) * padding
        sides.append((F.greatest(F.lit(0), F.floor(low - pad)).cast("int"), F.least(size, F.ceil(high + pad)).cast("int")))
    (x1, x2), (y1, y2) = sides
    return F.when(valid_box(b) & (x2 - x1 >= 2) & (y2 - y1 >= 2), F.array(x1, y1, x2, y2))


# Identifiers, paths, sizes and responses


def sha_pattern(x: Column | str) -> Column:
    return F.coalesce(col(x).rlike("^[0-9a-f]{64}$"), F.lit(False))


def window_key(step: Column, frame: Column, media: Column) -> Column:
    return F.concat_ws(":", step.cast("string"), F.when(frame.isNotNull(), F.lit("frame")).otherwise(F.lit("media")), F.coalesce(frame, media).cast("string"))


def checkpoint_path(task: Column | str, uid: Column | str) -> Column:
    sha = F.sha2(col(uid), 256)
    return F.concat(col(task), F.lit("/"), F.substring(sha, 1, 2), F.lit("/"), sha, F.lit(".jsonl"))


def data_uri_size(mime: Column | str, n_bytes: Column | str) -> Column:
    return F.length(F.concat(F.lit("data:"), col(mime), F.lit(";base64,"))) + F.ceil(col(n_bytes) / 3) * 4


def redact_urls(x: Column | str) -> Column:
    return F.regexp_replace(col(x), "(?:oss|https?)://[^\\s\"'<>]+", "[MEDIA_URL_REDACTED]")


def rate_kind(message: Column | str) -> Column:
    low = F.lower(col(message))
    has = lambda words: F.coalesce(low.rlike("|".join(words)), F.lit(False))
    return F.when(has(TOKEN_RATE_WORDS), "tpm").when(has(REQUEST_RATE_WORDS), "rpm").otherwise("unknown")


def fatal_response(status: Column | str, body: Column | str) -> Column:
    return F.coalesce(col(status).isin(401, 403), F.lit(False)) | F.coalesce(F.lower(col(body)).rlike("|".join(FATAL_WORDS)), F.lit(False))


def media_rejection(status: Column | str, body: Column | str, kinds: tuple[str, ...] = ("input video", "input image")) -> Column:
    code, message = F.get_json_object(col(body), "$.error.code"), F.lower(F.get_json_object(col(body), "$.error.message"))
    return F.coalesce((col(status) == 400) & (code == REJECTION_CODE) & message.rlike("|".join(kinds)), F.lit(False))


def retry_after(value: Column | str, now: Column) -> Column:
    """Seconds to wait: a number, or the time left until an HTTP date."""
    value = col(value)
    when = F.try_to_timestamp(F.regexp_replace(F.trim(value), "^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss 'GMT'"))
    seconds = F.coalesce(F.try_cast(value, "double") if hasattr(F, "try_cast") else value.try_cast("double"), F.unix_timestamp(when) - F.unix_timestamp(now))
    return F.when(F.trim(value) != "", F.greatest(F.lit(0.0), seconds))


def response_text(response: Column | str) -> Column:
    """choices[0].message.content: a string, or the texts of its parts in a row; null if neither."""
    body = col(response)
    content = F.get_json_object(body, "$.choices[0].message.content")
    parts = F.from_json(content, "array<struct<text:string>>")
    return F.when(F.trim(content).startswith("["), F.array_join(F.transform(parts, lambda p: F.coalesce(p["text"], F.lit(""))), "")).otherwise(content)


def primary_uid(uid: Column | str) -> Column:
    """The uid of the episode that a secondary view belongs to."""
    return F.substring_index(col(uid), ":view=", 1)


def hash_slot(uid: Column | str, slots: int) -> Column:
    """First eight bytes of the SHA-256, big-endian, modulo the number of slots."""
    head = F.conv(F.substring(F.sha2(col(uid), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % slots).cast("int")


def offset_seconds(offset: Column, t: Column) -> Column:
    """Local time on the episode's clock, six decimals."""
    return F.bround(offset + t, 6)
