import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from annolith.llm import substring_dedup as s


def plain(rows):
    words = {i: (t or "").encode().split() for i, t in rows}
    first = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            first.setdefault(tuple(words[i][k : k + 50]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if first[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        out[i] = (len(w), [x for x, g in zip(w, gone, strict=True) if not g])
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_equals_brute_force(corpus, batches):
    want = plain([(r.doc_id, r.text) for r in corpus.collect()])
    for r in s.digest(corpus, batches=batches).collect():
        n, left = want[r.doc_id]
        assert (r.n_words, r.n_removed, r.kept_sha256) == (n, n - len(left), hashlib.sha256(b" ".join(left)).hexdigest())
    assert any(n > len(left) for n, left in want.values())


def test_edges(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(1, passage), (2, "a " + passage + " b"), (3, " ".join(passage.split()[:50])), (4, " ".join(passage.split()[:49])), (5, passage.upper()), (9, passage + " " + passage), (8, None), (7, "x " * 70)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = plain(rows)
    got = {r.doc_id: (r.n_words, r.n_removed) for r in s.digest(df).collect()}
    assert got == {i: (n, n - len(left)) for i, (n, left) in want.items()}
    assert got[2] == (62, 60) and got[3] == (50, 50) and got[4] == (49, 0) and got[7] == (70, 0) and got[9] == (120, 120)


def test_a_later_session_goes_on(spark, corpus, tmp_path):
    """Batches by indexes that are opened anew each time: the same repeats as brute force, and few runs left."""
    root, want, got, whole = f"file://{tmp_path}/index", plain([(r.doc_id, r.text) for r in corpus.collect()]), {}, set()
    ids = sorted(want)
    cuts = [ids[len(ids) * k // 6] for k in range(6)] + [ids[-1] + 1]
    for low, high in zip(cuts, cuts[1:], strict=False):
        index = s.FingerprintIndex(spark, root, fan=2)
        found, copies = index.ingest(corpus.where(f"doc_id >= {low} AND doc_id < {high}"), corpus.where(f"doc_id < {low}"))
        got |= {r.doc_id: {x % 2**64 for x in r.repeats} for r in found.collect()}
        whole |= {r.doc_id for r in copies.collect()}
        assert all(len(runs) <= 2 for runs in index.runs.values())
    for r in corpus.collect():
        n, left = want[r.doc_id]
        assert len(left) == (0 if r.doc_id in whole else len(s._cut(r.text, np.array(sorted(got.get(r.doc_id, ())), np.uint64))[1]))
    assert whole
    folders = {p.name.split("-")[0] for p in (tmp_path / "index").iterdir()}
    assert folders == {"manifest", "texts", "anchors", "verified", "windows"} and len(list((tmp_path / "index").iterdir())) <= 9 and index.version == 6


def test_copies_under_a_shared_id(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    df = spark.createDataFrame([(1, passage, 0), (2, passage, 0), (2, "own " + passage + " end", 0), (3, "x  " + passage, 0), (4, "x " + passage, 0)], "doc_id bigint, text string, n_chars int")
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in s.digest(df).collect())
    assert got == [(1, 60, 0), (2, 60, 60), (2, 62, 60), (3, 61, 60), (4, 61, 61)]
    left = sorted((r.doc_id, r.text.split()) for r in s.remove(df).collect())
    assert left == [(1, passage.split()), (2, []), (2, ["own", "end"]), (3, ["x"]), (4, [])]


def test_ids_of_other_types(corpus):
    want = {r.doc_id: r.n_removed for r in s.digest(corpus).collect()}
    named = corpus.withColumn("doc_id", F.format_string("d%09d", "doc_id"))
    assert {int(r.doc_id[1:]): r.n_removed for r in s.digest(named).collect()} == want and any(want.values())


def test_rows_stay_whole(odd, none):
    out = s.remove(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    before, after = {(r.doc_id, r.text) for r in odd.collect()}, {(r.doc_id, r.text) for r in out.collect()}
    assert before == after  # nothing of 50 words repeats
    assert s.remove(none).count() == 0 and s.digest(none).count() == 0
    digest = s.digest(odd).collect()
    assert len(digest) == odd.count() and all(r.n_removed == 0 for r in digest)


def test_white_space_is_kept(spark):
    passage = " ".join(f"p{k}" for k in range(50))
    df = spark.createDataFrame([(1, passage, 0), (2, f"  keep\tthis\n{passage.replace(' ', '  ')} end ", 0)], "doc_id bigint, text string, n_chars int")
    got = {r.doc_id: (r.text, r.n_chars) for r in s.remove(df).collect()}
    assert got[2][0].split() == ["keep", "this", "end"] and got[2][0].startswith("  keep\tthis\n") and got[2][1] == len(got[2][0])


def test_anchors_are_the_windows_minima():
    h = np.random.default_rng(0).integers(0, 2**63, 400).astype(np.uint64)
    grams = s.rolled(h, s.GRAM)
    per = s.WINDOW - s.GRAM + 1
    assert s.anchors(h)[0].tolist() == sorted({k + int(np.argmin(grams[k : k + per])) for k in range(len(h) - s.WINDOW + 1)})
    whole = s.rolled(h, s.WINDOW)
    assert all(whole[k] == s.rolled(h[k : k + s.WINDOW], s.WINDOW)[0] for k in (0, 7, 350))
