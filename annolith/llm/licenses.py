"""License scans by ordered signature rules, as column expressions.

Every rule is a regular expression with a label and a priority (1 is the strongest); ``license_rules`` lists them.  A text is
looked at in three steps: does it hold one of the gate words (a set so chosen that every rule's match holds one), then which
rules' own words does it hold, and only then are those rules' expressions run.  Where detections overlap, one that lies
inside another of the same or a stronger priority is suppressed.

Beside the rules stand the base phrases, whole words that follow each other, counted over all places.

Null text counts as empty: no words, no places, score 0.  Repeated rows give repeated results; ties between equal intervals
go to the stronger priority, then to the first label.  Arrays are built in blocks, so that a text of very many matches
takes time in proportion to them.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lower_ascii
from .license_rules import listed

WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

#: White space or a mark, once the text is in lower case.
MARK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
BEFORE, AFTER = r"(?<![a-z0-9]|[^\x00-\x7F])", r"(?![a-z0-9]|[^\x00-\x7F])"

#: Base phrases and labels, in any case.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Words that ordinary prose is full of: a gate among them would let most texts pass.
ORDINARY = frozenset(
    "the and any for with without this that you may not are its use used from have has can all new one two three four each must more other under either such text work works file files free public general version program software "
    "document source form code data book part provided terms rights made available person copy copies following including subject conditions commercial material only project permission permitted original library language open org "
    "com www net database content contents state when good some day buy beer your freedom share change names holders group foundation european union government common business server side mark zero science law but make back "
    "into action advantage advised anniversary based computer copied goods hosted included modify modified price product products shall meet extent associated executable associated in by is to of or on an as it if at be we do no "
    "just accept use company covered user section system given real restriction respect party parties possible notice written even away benefit carry components cover date object service services includes charge independent mit arising intent derived directed distribute stuff used fuck".split()
)


def expression(pattern: str) -> str:
    """Blanks match any white space and marks; the whole stands between word ends."""
    return BEFORE + pattern.replace(" ?", MARK + "*").replace(" ", MARK + "+") + AFTER


def needed(pattern: str) -> list[str]:
    """Strings that every match holds: what stands outside brackets, up to a choice or a repetition."""
    while (bare := re.sub(r"\(\?:[^()]*\)[?*+]?", " ", pattern)) != pattern:
        pattern = bare
    found = []
    for token in re.split(r" \??", pattern):
        word, rest = re.match(r"([a-z0-9]*)(.*)", token).groups()
        found.append(word[:-1] if rest[:1] in ("?", "*", "{") else word)
    return sorted({w for w in found if len(w) > 1}, key=lambda w: (w in ORDINARY or "licen" in w, -len(w), w))


@lru_cache(maxsize=1)
def gates() -> tuple[str, ...]:
    """Words of which every match of every rule holds one, few and rare ones: the word that opens most rules first."""
    waiting, chosen = [needed(pattern) for _, _, pattern in listed()], []
    while waiting:
        counts: dict[str, int] = {}
        for words in waiting:
            for w in {"licen" if "licen" in w else w for w in words}:
                counts[w] = counts.get(w, 0) + 1
        best = min(counts, key=lambda w: (w in ORDINARY, len(w) < 3, -counts[w], -len(w), w))
        chosen.append(best)
        waiting = [words for words in waiting if not any(best == w or len(best) > 3 and best in w for w in words)]
    return tuple(chosen)


def gate(low: Column) -> Column:
    """Whether a text in lower case may match a rule.  Gates of up to three letters begin at a word's start."""
    some = None
    for w in gates():
        has = F.contains(low, F.lit(w))
        if len(w) < 4:
            has = has & F.regexp_like(low, F.lit(BEFORE + w))
        some = has if some is None else some | has
    return some


def _rule_table() -> Column:
    """Rules under the first of their words: each has its other words, label, priority and expression."""
    groups: dict[str, list[dict]] = {}
    for label, priority, pattern in listed():
        first, *others = needed(pattern)
        groups.setdefault(first, []).append({"k": others[:2], "l": label, "p": priority, "x": expression(pattern)})
    return F.from_json(F.lit(json.dumps([{"w": w, "r": some} for w, some in groups.items()])), "array<struct<w:string,r:array<struct<k:array<string>,l:string,p:int,x:string>>>>")


FOUND = "array<struct<s:int,minus_e:int,p:int,l:string>>"
#: Elements that are appended to one array; longer arrays are made of such blocks.
BLOCK = 256


def _bound(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(items: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / BLOCK).cast("int")), lambda k: F.slice(items, k * BLOCK + 1, F.lit(BLOCK)))


def _running(items: Column, zero: Column, step, kind: str) -> Column:
    """The states before each element: step(state, element) is the state after it."""
    start = F.struct(zero.alias("at"), F.array().cast(kind).alias("out"))
    return F.aggregate(items, start, lambda acc, x: F.struct(step(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")), lambda acc: acc["out"])


def _places(text: Column, rule: Column) -> Column:
    """(start, end, priority, label) of every match: pieces and matches alternate."""

    def from_lengths(lengths: Column) -> Column:
        def in_block(block: Column, start: Column) -> Column:
            before = _running(block, start, lambda at, x: at + x["gap"] + x["hit"], "array<int>")
            return F.zip_with(block, before, lambda x, at: F.struct((at + x["gap"]).alias("s"), (-(at + x["gap"] + x["hit"])).alias("minus_e"), rule["p"].alias("p"), rule["l"].alias("l")))

        def over(blocks: Column) -> Column:
            total = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda a, x: a + x["gap"] + x["hit"]))
            return F.flatten(F.zip_with(blocks, _running(total, F.lit(0), lambda at, x: at + x, "array<int>"), in_block))

        return F.when(F.size(lengths) > 0, _bound(_blocks(lengths), over)).otherwise(F.array().cast(FOUND))

    hits = F.regexp_extract_all(text, rule["x"], F.lit(0))
    pieces = F.split(text, rule["x"], -1)
    return _bound(F.slice(F.zip_with(pieces, hits, lambda a, b: F.struct(F.length(a).alias("gap"), F.length(b).alias("hit"))), F.lit(1), F.size(hits)), from_lengths)


LEVELS = 5


def _unsuppressed(found: Column) -> Column:
    """In order of start, longest first: a detection goes if an earlier one, no weaker, reaches as far."""

    def reached(reach: Column, d: Column) -> Column:
        return F.transform(reach, lambda r, k: F.when(k == d["p"] - 1, F.greatest(r, -d["minus_e"])).otherwise(r))

    def kept(block: Column, start: Column) -> Column:
        marked = F.zip_with(block, _running(block, start, reached, "array<array<int>>"), lambda d, reach: F.struct(d.alias("d"), (F.array_max(F.slice(reach, F.lit(1), d["p"])) < -d["minus_e"]).alias("stays")))
        return F.transform(F.filter(marked, lambda m: m["stays"]), lambda m: m["d"])

    def over(blocks: Column) -> Column:
        none = F.array(*[F.lit(-1) for _ in range(LEVELS)])
        far = F.transform(blocks, lambda b: F.aggregate(b, none, reached))
        starts = _running(far, none, lambda reach, x: F.zip_with(reach, x, lambda a, b: F.greatest(a, b)), "array<array<int>>")
        return F.flatten(F.zip_with(blocks, starts, kept))

    return _bound(F.sort_array(found), lambda s: F.when(F.size(s) > 0, _bound(_blocks(s), over)).otherwise(F.array().cast(FOUND)))


def detections(text: Column) -> Column:
    """The detections of a text that no other suppresses: array of (s, minus_e, p, l)."""

    def found(low: Column) -> Column:
        live = F.flatten(F.transform(F.filter(_rule_table(), lambda g: F.contains(low, g["w"])), lambda g: g["r"]))
        live = F.filter(live, lambda r: F.forall(r["k"], lambda w: F.contains(low, w)))
        return _unsuppressed(F.flatten(F.transform(live, lambda r: _places(low, r))))

    low = lower_ascii(text)
    return F.when(gate(low), _bound(low, found)).otherwise(F.array().cast(FOUND))


def base_pattern(phrases=PHRASES) -> str:
    some = "|".join(GAP.join(p.split()) for p, _ in phrases)
    return f"(?i)(?<!{WORD})(?:{some})(?!{WORD})"


def scan(df: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, word and base-phrase figures, labels, score, and the detections with their character spans.

    score is the trust in the strongest detection: 1 for a phrase of a license's own text or an SPDX tag, a
    fifth less for each priority below; 0.5 if only a base phrase stands there; 0 without any.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    words = lambda c: F.regexp_count(c, F.lit(WORD + "+")).cast("bigint")
    pattern = F.lit(base_pattern())
    has = F.regexp_like(F.col("t"), F.lit("(?i)license"))
    none = F.array().cast("array<string>")
    rows = df.select(F.col(key).alias("doc_id"), t.alias("t"))
    rows = rows.select("doc_id", "t", words(F.col("t")).alias("n_words"), F.when(has, F.regexp_extract_all("t", pattern, F.lit(0))).otherwise(none).alias("hits"), detections(F.col("t")).alias("found"))
    some = F.size("hits") > 0
    label = lambda h: F.coalesce(*[F.when(F.regexp_like(h, F.lit("(?i)^" + p.split()[0])), F.lit(name)) for p, name in PHRASES])
    base = F.array_distinct(F.transform("hits", label))
    return rows.select(
        "doc_id",
        "n_words",
        F.size("hits").cast("bigint").alias("n_base"),
        F.when(some, words(F.get(F.split("t", base_pattern(), 2), F.lit(0)))).alias("first_word"),
        F.when(some, F.col("n_words") - words(F.element_at(F.split("t", base_pattern(), -1), -1)) - words(F.element_at("hits", -1))).alias("last_word"),
        F.array_join(F.sort_array(base), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(base, F.transform("found", lambda d: d["l"]))), ",").alias("labels"),
        F.when(F.size("found") > 0, (6 - F.array_min(F.transform("found", lambda d: d["p"]))) / 5).when(some, F.lit(0.5)).otherwise(F.lit(0.0)).alias("score"),
        F.transform("found", lambda d: F.struct(d["l"].alias("label"), d["p"].alias("priority"), d["s"].alias("start"), (-d["minus_e"]).alias("end"))).alias("detections"),
    )
