import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from annolith.llm import pii


def texts_of(text):
    base, added = pii.all_spans(text)
    return [(pii.KINDS[k], text[s:e]) for s, k, e in base], [(pii.KINDS[k], text[s:e]) for s, k, e in added]


CASES = [
    ("mail a@b.co or A.b+c@x-y.org.", [("email", "a@b.co"), ("email", "A.b+c@x-y.org")], []),
    ("ip 10.0.0.255 and 10.0.0.256 and 1.2.3", [("ip", "10.0.0.255")], []),
    ("card 4111 1111 1111 1111, 4111111111111112", [("card", "4111 1111 1111 1111")], []),
    ("call +1 (555) 123-4567 now", [("phone", "+1 (555) 123-4567")], []),
    ("mail john.doe [at] example [dot] com now", [], [("email", "john.doe [at] example [dot] com")]),
    ("john at example dot com", [], [("email", "john at example dot com")]),
    ("call plus one five five five two three four five six seven eight", [], [("phone", "plus one five five five two three four five six seven eight")]),
    ("jоhn@exаmple.com", [], [("email", "jоhn@exаmple.com")]),
    ("１９２．168.0.1", [], [("ip", "１９２．168.0.1")]),
    ("see me at home.com, look at dot com", [], []),
    ("", [], []),
]


@pytest.mark.parametrize("text,base,added", CASES)
def test_spans(text, base, added):
    assert texts_of(text) == (base, added)


KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and checks(digits(x))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
}


def digits(x):
    return re.sub("[^0-9]", "", x)


def checks(number):
    return sum(sum(divmod(int(d) * 2, 10)) if k % 2 else int(d) for k, d in enumerate(number[::-1])) % 10 == 0


def expected(text):
    """The contract's expressions, one search for each kind."""
    found = [(m.start(), k, m.end()) for k, (x, good) in enumerate(KINDS.values()) for m in re.finditer(x, text) if good(m[0])]
    return [(list(KINDS)[k], s, e) for s, k, e in sorted(found)]


def test_detect(odd, corpus, none):
    for df in (odd, corpus):
        texts = {r.doc_id: r.text or "" for r in df.collect()}
        for r in pii.detect(df).collect():
            base = expected(texts[r.doc_id])
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == kind for k, _, _ in base) for kind in KINDS)
            joined = [f"{k}:{s}:{e}" for k, s, e in base]
            assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
            assert set(joined) <= set(r.spans.split(",")) | {""}
    assert pii.detect(none).count() == 0 and pii.redact(none).count() == 0


@settings(max_examples=400, deadline=None)
@given(st.text("a@.b-_+ 019()x%é", max_size=60) | st.lists(st.sampled_from(["1", "255", "256", ".", "a", "@", "b.c", " ", "-", "+", "4111111111111111", "0012"]), max_size=20).map("".join))
def test_plain_spans_are_the_contracts(text):
    assert [(pii.KINDS[k], s, e) for s, k, e in pii.plain_spans(text)] == expected(text)


@pytest.mark.parametrize("text", ["0" * 5000 + ".1.1.1", "1" * 1_000_000, "a" * 1_000_000 + " x@y.z", "a@" * 400_000, "one two " + "1 " * 400_000, "+1" * 400_000, "one " * 200_000, "1." * 400_000, " one " + " " * 1_000_000 + "[at]"])
def test_long_runs_take_linear_time(text):
    began = time.perf_counter()
    pii.all_spans(text)
    assert time.perf_counter() - began < 4


def test_redaction(spark, odd):
    df = spark.createDataFrame([(1, "x a@b.co y +1 (555) 123-4567", 5), (2, None, None)], "doc_id bigint, text string, n_chars bigint")
    assert sorted((r.doc_id, r.text, r.n_chars) for r in pii.redact(df).collect())[0] == (1, "x [EMAIL] y [PHONE]", 19)
    out = pii.redact(odd)
    assert out.columns == odd.columns and out.count() == odd.count()


def test_foreign_scripts_stay_fast():
    text = "Привет мир " * 50_000
    assert texts_of(text)[0] == []


@pytest.mark.parametrize("text,kind", [("call plus 49 five five 1 2 3 4 5 6 7 8 today", "phone"), ("card four 111 1111 1111 1111 1 1", None), ("at one.2.3.4 now", "ip"), ("call plus \uff4fne five five five 2 3 4 5 6 7 8", "phone")])
def test_few_spelled_digits(text, kind):
    """What stands before and after a run does not decide whether it is seen."""
    alone, among = texts_of(text)[1], texts_of(text + ", or phone someone else, one or two of seven")[1]
    assert alone == among and [k for k, _ in alone] == [kind] * (kind is not None)
