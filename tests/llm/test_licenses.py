import re
import time

from pyspark.sql import functions as F

from annolith.llm import licenses


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    found = [(k, label) for phrase, label in licenses.PHRASES for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    return len(words), len(found), min(found)[0] if found else None, max(found)[0] if found else None, ",".join(sorted({x for _, x in found}))


TEXTS = ["Released under the MIT License. Then MIT-License; permitlicense mit licenses. Apache\nLicense, version 2.0", "é Mit licenseé MIT LICENSE ﬁn", "GNU General  Public (License) v3, all rights reserved", "SPDX-License-Identifier: Apache-2.0", "Licensed under CC BY-NC 4.0.", "mit\x00license K mit license"]


def test_base_figures(spark, odd, corpus):
    more = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    for df in (odd, corpus, more):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in licenses.scan(df).collect():
            assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(texts[r.doc_id])
            assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_rules_and_suppression(spark):
    df = spark.createDataFrame(list(enumerate([*TEXTS, "İİİİ MIT License"])), "doc_id bigint, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    assert got[3].labels == "apache" and got[3].score == 1
    assert got[4].labels == "cc-by-nc"
    assert got[2].labels == "copyright,gpl"
    spans = [(d.label, TEXTS[0][d.start : d.end]) for d in got[0].detections]
    assert ("mit", "the MIT License") in spans and len([s for s in spans if s[0] == "mit"]) == 2
    assert [(d.start, d.end) for d in got[len(TEXTS)].detections] == [(5, 16)]


def brute(text):
    """Every rule on every text, then every detection against every other."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = {(m.start(), -m.end(), p, label) for label, p, x in RULES for m in x.finditer(low) if m.end() > m.start()}
    return sorted(d for d in found if not any(e[0] <= d[0] and e[1] <= d[1] and e[2] <= d[2] and (e < d) for e in found))


RULES = [(label, p, re.compile(licenses.expression(x))) for label, p, x in licenses.listed()]


def example(pattern):
    """A text that a pattern matches: first choices, optional parts left out."""
    while (less := re.sub(r"\(\?:[^()]*\)\?", "", re.sub(r"\(\?:([^()|]*)\|?[^()]*\)(?!\?)", r"\1", pattern))) != pattern:
        pattern = less
    pattern = re.sub(r"\[(.)[^]]*\]", r"\1", pattern)
    return re.sub(r".\?", "", pattern.replace("\\d{4}", "2004").replace("\\d", "2").replace("\\.", "."))


def test_rules_alone_and_against_brute_force(spark, odd, corpus):
    texts = [example(x) for _, _, x in licenses.listed()]
    assert [(x, t) for (_, _, x), t, r in zip(licenses.listed(), texts, RULES, strict=True) if not r[2].search(t)] == []
    wrapped = ["# " + t.upper().replace(" ", "\n#  ") + "." for t in texts]
    more = spark.createDataFrame(list(enumerate([*texts, *wrapped, " and ".join(texts)])), "doc_id bigint, text string")
    assert len(texts) > 400 and all(map(licenses.needed, (x for _, _, x in licenses.listed())))
    for df in (odd, corpus, more):
        expected = sorted((str(r.doc_id), str(brute(r.text))) for r in df.collect())
        got = licenses.scan(df).select("doc_id", "detections").collect()
        assert sorted((str(r.doc_id), str([(d.start, -d.end, d.priority, d.label) for d in r.detections])) for r in got) == expected


def test_a_megabyte_of_matches(spark):
    df = spark.createDataFrame([(1, "MIT License, all rights reserved " * 30_000)], "doc_id int, text string")
    began = time.perf_counter()
    row = licenses.scan(df).select("n_base", F.size("detections").alias("n")).first()
    assert (row.n_base, row.n) == (30_000, 60_000)
    assert time.perf_counter() - began < 20


def test_empty_table(none):
    assert licenses.scan(none).count() == 0


def test_no_rule_is_kept_from_its_matches(spark):
    texts = {"Released under the WTFPL": "wtfpl", "Distributed under BSD 3 Clause terms": "bsd", "available under Apache 2.0": "apache", "https://mozilla.org/MPL/2.0/": "mpl", "may be used to endorse or promote products derived from this software": "bsd", "altered source versions must be plainly marked as such": "zlib", "Creative\nCommons Attribution": "cc-by", "the Common\n#          Public License": "cpl", "Open\nFont License": "ofl", "the Expat license": "mit", "SPDX-License-Identifier: MPL-2.0": "mpl", "Creative Commons Zero": "cc0"}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(df).select("doc_id", "labels").collect()}
    assert [x for x, (k, label) in zip(texts, enumerate(texts.values()), strict=True) if label not in got[k]] == []
