import os
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from annolith.llm import quality


def plain(text):
    text = text or ""
    words = text.encode().split()
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if grams[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return len(words), sum(len(w.decode()) for w in words), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_measures(odd, corpus, spark):
    more = spark.createDataFrame([(1, "a b c a b c a b"), (2, "x x x x"), (3, "l1\nl1\n\n \nl2\nl1"), (4, "#*|<> & %$")], "doc_id bigint, text string")
    for df in (odd, corpus, more):
        texts = {r.doc_id: r.text for r in df.collect()}
        for r in quality.judge(df).collect():
            want = plain(texts[r.doc_id])
            assert tuple(r[c] for c in quality.MEASURES[:5]) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and not (r.base_failed and r.kept)


def test_policies_and_ablation(corpus):
    rows = quality.ledger(quality.measure(corpus)).cache()
    n = rows.count()
    for policy in quality.POLICIES:
        kept = rows.where(quality.kept(policy)).count()
        table = quality.ablation(rows, policy).collect()
        assert {r.rule for r in table} == set(quality.POLICIES[policy])
        for r in table:
            assert r.n == n and r.kept == kept
            others = tuple(x for x in quality.POLICIES[policy] if x != r.rule)
            assert r.kept_without == rows.where(rows.failed.bitwiseAND(quality.mask(others)) == 0).count()


def test_kept_rows_are_whole(odd, none, corpus):
    assert quality.keep(odd).columns == odd.columns
    assert quality.keep(none).count() == 0 and quality.judge(none).count() == 0
    want = {r.doc_id for r in quality.judge(corpus, "corpus-1").where("kept").collect()}
    kept = quality.keep(corpus)
    assert {r.doc_id for r in kept.collect()} == want and kept.schema == corpus.schema


def test_clean_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = quality.judge(docs, "corpus-1").join(labels, "doc_id").where("toxic = 0 AND NOT base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    poor = [r.kept for r in rows if r.quality == 0]
    assert sum(good) >= 0.99 * len(good) and sum(poor) <= 0.1 * len(poor)


def test_native(corpus):
    plan = quality.judge(corpus)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


DATA = "/root/testdata/sf0.1"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the tables of sf0.1")
def test_toxic_recall_by_language(spark):
    """On the odd doc_ids, from which no word was taken."""
    labels = spark.read.parquet(f"{DATA}/labels.parquet").where("doc_id % 2 = 1 AND quality = 1")
    docs = spark.read.parquet(f"{DATA}/documents.parquet").join(labels, "doc_id")
    found = quality.measure(docs).select("doc_id", F.expr(dict(quality.RULES)["toxic"]).cast("int").alias("found"))
    rows = docs.select("doc_id", "lang", "toxic").join(found, "doc_id").groupBy("lang", "toxic").agg(F.avg("found").alias("share")).collect()
    share = {(r.lang, r.toxic): r.share for r in rows}
    assert {x for x, _ in share} == {"de", "en", "es", "fr"}
    assert all(v >= 0.9 if toxic else v <= 0.01 for (_, toxic), v in share.items()), share
