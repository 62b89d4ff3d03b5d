"""Personal data: plain detection, and detection behind disguises with spans in the source.

Two passes of transducers rewrite a text and keep, for every character written, the source characters
that it came from: look-alike letters and digits of other scripts become ASCII; runs of spelled digits
become digits; bracketed or spaced "at" and "dot" between host names become ``@`` and ``.``.  Detectors run
on the rewritten text, and spans that touch a rewritten place are mapped back and added.  What the
detectors find in the plain text always stays.

Null text counts as empty and has no spans.  Texts are searched whole.  Equal rows give equal results.
"""

from __future__ import annotations

import hashlib
import re
from array import array

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches

KINDS = ("email", "ip", "card", "phone")
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
#: A number is entered at its first digit only: from a later one the same parts follow, so it would fail alike.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

#: Letters and marks of other scripts, each before the ASCII one that it looks like.
PAIRS = (
    "АA ВB ЕE З3 КK МM НH ОO РP СC ТT УY ХX ЅS ІI ЈJ аa еe оo рp сc уy хx ѕs іi јj ԁd ԛq ԝw һh "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX οo ιi κk νv "
    "＠@ ﹫@ ．. ․. 。. ｡. ＋+ －- ‐- ‑- ‒- –- —-"
)
LOOK_ALIKES = {ord(p[0]): p[1] for p in PAIRS.split()}
#: Digits of other scripts by their zero, and the full-width letters.
LOOK_ALIKES |= {zero + k: str(k) for zero in (0xFF10, 0x660, 0x6F0, 0x966) for k in range(10)}
LOOK_ALIKES |= {0xFEE0 + k: chr(k) for k in range(ord("A"), ord("z") + 1) if chr(k).isalpha()}
SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9"}
#: A run from its first spelled digit on: at least four tokens, spelled or plain digits, "dot" or "point".
DIGIT_WORD = "(?:" + "|".join(SPELLED) + ")"
RUN = re.compile(rf"(?<![A-Za-z0-9]){DIGIT_WORD}(?:[\x20,.-]+(?:{DIGIT_WORD}|dot|point|[0-9]+)){{3,}}(?![A-Za-z0-9])", re.I)
#: What may stand before the first spelled digit, written backwards: plain digits, then a "plus".
LEAD = re.compile(r"(?:[\x20-]++[0-9]++(?![A-Za-z]))*+(?:[\x20-]++sulp(?![A-Za-z0-9]))?", re.I)
#: What a run has at least: a spelled digit and a further digit, spelled or plain, "dot" or "point".
SPELLED_OUT = re.compile(rf"{DIGIT_WORD}[\x20,.-]+(?:{DIGIT_WORD}|dot|point|[0-9])", re.I)
RUN_WORD = re.compile(rf"plus[\x20-]*|{DIGIT_WORD}|dot|point|[0-9]+|[\x20,.-]+", re.I)
#: "name [at] host [dot] org", and "name at host dot org" with single spaces.
DISGUISED = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+(?P<at>\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\sat\s|\s@\s|@)[A-Za-z0-9-]+(?:(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\s\.\s|\.)[A-Za-z0-9-]+)+", re.I
)
AT = re.compile(r"\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\sat\s|\s@\s", re.I)
DOT = re.compile(r"\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\sdot\s|\s\.\s", re.I)
HINT = re.compile(r"[\[({<]\s?(?:at|@|dot|\.)\s?[\])}>]|\s(?:dot|@)\s", re.I)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = int(d) * (1 + k % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost non-overlapping addresses.  Each ends at an @ of its own, from which the name is read backwards."""
    found, past, at = [], 0, text.find("@")
    while at >= 0:
        start = past + len(text[past:at].rstrip(LOCAL))
        host = HOST.match(text, at + 1) if start < at else None
        if host:
            found.append((start, host.end()))
        past = host.end() if host else at + 1
        at = text.find("@", past)
    return found


def _octet(digits: str) -> bool:
    value = digits.lstrip("0")
    return len(value) < 4 and int(value or "0") <= 255


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind's place in KINDS, end), leftmost non-overlapping within a kind; failing matches go without a retry."""
    found = []
    if "@" in text:
        found += [(start, 0, end) for start, end in emails(text)]
    if DIGITS.search(text) is None:
        return found
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(map(_octet, m[0].split(".")))]
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(found)


class Rewriting:
    """A text being rewritten; each character written has its source span and whether it was changed."""

    def __init__(self, source: str):
        self.text = source
        self.first = array("q", range(len(source)))
        self.past = array("q", range(1, len(source) + 1))
        self.new = bytearray(len(source))

    def back(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source span of a span written, and whether it holds a changed character."""
        return self.first[start], self.past[end - 1], 1 in self.new[start:end]

    def swap(self, text: str) -> None:
        """Takes a text of the same length, changed in some characters."""
        self.new = bytearray(old or a != b for old, a, b in zip(self.new, self.text, text, strict=True))
        self.text = text

    def replace(self, changes: list[tuple[int, int, str]]) -> None:
        """Replaces stretches of the text as it is now, given in order and without overlaps."""
        out, first, past, new, at = [], array("q"), array("q"), bytearray(), 0
        for a, b, put in [*changes, (len(self.text), len(self.text), "")]:
            out += [self.text[at:a], put]
            first += self.first[at:a]
            past += self.past[at:a]
            new += self.new[at:a]
            if put:
                first.extend([self.first[a]] * len(put))
                past.extend([self.past[b - 1]] * len(put))
                new += b"\1" * len(put)
            at = b
        self.text, self.first, self.past, self.new = "".join(out), first, past, new


def rewritten(text: str) -> Rewriting | None:
    """The text without disguises, or None if it wears none."""
    plain = text if text.isascii() else text.translate(LOOK_ALIKES)
    spelled = SPELLED_OUT.search(plain) is not None
    low = plain.lower()
    hinted = ("dot" in low or "@" in plain or "at" in low) and HINT.search(plain)
    if plain == text and not spelled and not hinted:
        return None
    own = Rewriting(text)
    if plain != text:
        own.swap(plain)
    if spelled:
        changes, backwards, past = [], own.text[::-1], 0
        n = len(backwards)
        for m in RUN.finditer(own.text):
            start = n - LEAD.match(backwards, n - m.start(), n - past).end()
            past, kept = m.end(), []
            for w in RUN_WORD.findall(own.text[start : m.end()]):
                word = w.strip(" -,").lower()
                kept.append("+" if word == "plus" else "." if word in ("dot", "point", ".") else SPELLED.get(word, word if word.isdigit() else ""))
            new = "".join(kept)
            if sum(c.isdigit() for c in new) >= 4:
                changes.append((start, m.end(), new))
        own.replace(changes) if changes else None
    if hinted:
        changes = []
        for m in DISGUISED.finditer(own.text):
            bracketed = m["at"].strip()[:1] in "[({<@" and m["at"].strip() != ""
            if not bracketed and not DOT.search(own.text, m.end("at"), m.end()):
                continue  # an ordinary "at" before a host name
            changes.append((m.start("at"), m.end("at"), "@"))
            changes += [(d.start(), d.end(), ".") for d in DOT.finditer(own.text, m.end("at"), m.end())]
        changes = [(a, b, new) for a, b, new in changes if own.text[a:b] != new]
        own.replace(changes) if changes else None
    return own if 1 in own.new else None


def all_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Spans of the plain text, and those that only show without disguises."""
    base = plain_spans(text)
    own = rewritten(text)
    if own is None:
        return base, []
    known, added = set(base), set()
    for start, kind, end in plain_spans(own.text):
        s, e, changed = own.back(start, end)
        if changed and (s, kind, e) not in known:
            added.add((s, kind, e))
    return base, sorted(added)


def _joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def detect(df: DataFrame, *, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, counts of the plain spans by kind, base_sha256 over them, and all spans in one string."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: list[list[int]] = [[], [], [], []]
        sha, spans = [], []
        for x in batch.column(1):
            base, added = all_spans(x.as_py() or "")
            for k, column in enumerate(counts):
                column.append(sum(s[1] == k for s in base))
            sha.append(hashlib.sha256(_joined(base).encode()).hexdigest())
            spans.append(_joined(sorted(base + added)))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array(sha, pa.string()), pa.array(spans, pa.string())], ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string", rows)


def redacted(text: str) -> str:
    """The text with each stretch of overlapping spans replaced by the kind of its first."""
    base, added = all_spans(text)
    out, at = [], 0
    spans = sorted(base + added)
    k = 0
    while k < len(spans):
        start, kind, end = spans[k]
        k += 1
        while k < len(spans) and spans[k][0] < end:
            end = max(end, spans[k][2])
            k += 1
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def redact(df: DataFrame, *, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns with personal data replaced; null texts stay null.

    length names the column, if there is one, that holds the text's number of characters.
    """

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        k = batch.schema.get_field_index(text)
        new = [None if x is None else redacted(x) for x in batch.column(k).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if j == k else c for j, c in enumerate(batch.columns)], batch.schema.names)

    out = map_batches(df, df.schema, clean)
    return out.withColumn(length, F.length(text).cast(df.schema[length].dataType)) if length in df.columns else out
