import os

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from annolith.llm import simhash


def plain_fingerprint(text, k=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, radius=4):
    parent = {i: i for i in ids}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = root(ids[i]), root(ids[j])
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in ids}


def test_fingerprints(odd):
    got = {(r.doc_id, f"{r.bits & (2**64 - 1):016x}") for r in simhash.fingerprints(odd).collect()}
    assert got == {(r.doc_id, f"{plain_fingerprint(r.text):016x}") for r in odd.collect()}


def test_classes_equal_brute_force(corpus):
    rows = corpus.collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = plain_components([r.doc_id for r in rows], fps)
    got = {r.doc_id: (r.component_id, r.fingerprint) for r in simhash.classes(corpus).collect()}
    assert got == {r.doc_id: (want[r.doc_id], f"{f:016x}") for r, f in zip(rows, fps, strict=True)}


def test_every_pair_in_the_radius_shares_a_mask():
    rng = np.random.default_rng(1)
    masks = simhash.covering_masks(4)
    assert len(masks) == 31
    for _ in range(3000):
        x = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
        assert any(x & m == 0 for m in masks)


def test_large_buckets_and_long_chains(spark):
    """A chain of small steps is one component though its ends are far apart; a dense ball is one too."""
    chain = [(1 << k * 3) - 1 for k in range(21)]
    ball = [0xFFFF << 40 ^ 1 << a ^ 1 << b for a in range(20) for b in range(a)]
    fps = sorted({*chain, *ball, 0x5555555555555555})
    nodes = spark.createDataFrame([(x - (x >> 63 << 64),) for x in fps], "bits bigint")
    label = {r.node: r.label for r in simhash.components(simhash.links(nodes)).collect()}
    want = plain_components(fps, fps)
    signed = lambda x: x - (x >> 63 << 64)
    groups = {}
    for x in fps:
        groups.setdefault(want[x], set()).add(label.get(signed(x), signed(x)))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)


def test_one_of_each_group_stays(odd, none):
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == ["1", "4", "5", "7", "7", "None"]  # 2 and 3 join 1; 6 repeats 4; both rows of 7 are one document
    assert simhash.keep_one(none).count() == 0 and simhash.classes(none).count() == 0


def plain_links(rows, k=5):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    ids = sorted(sets)
    return {(a, b) for n, b in enumerate(ids) for a in ids[:n] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}, sets


def test_similar_links(spark, corpus, none):
    """Every link is right, and all near copies are joined: edits of every 40th word leave a similarity of about 0.8."""
    words = [f"w{k * k % 9973}" for k in range(400)]
    rows = [(r.doc_id, r.text) for r in corpus.collect()] + [(5000, " ".join(words)), (5001, " ".join(w if k % 60 else "x" for k, w in enumerate(words))), (5002, " ".join(w if k % 7 else "y" for k, w in enumerate(words))), (5003, " ".join(words).upper() + " "), (5004, None), (5005, " ")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, sets = plain_links(rows)
    got = {(r.a, r.b) for r in simhash.similar_links(df).collect()}
    assert got <= want and (5000, 5003) in got and (5004, 5005) in got and (5000, 5002) not in got
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in got:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    missed = [p for p in want if root(p[0]) != root(p[1])]
    assert missed == []
    assert simhash.similar_links(none).count() == 0


def test_large_groups_of_near_copies(spark):
    """More copies than a bucket's pairwise limit, each with an edit of its own."""
    words = [f"v{k * 7 % 1009}" for k in range(300)]
    rows = [(0, " ".join(words))] + [(k, " ".join(w if j != k * 2 else "edit" + str(k) for j, w in enumerate(words))) for k in range(1, 120)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert [r.doc_id for r in simhash.keep_one(df).collect()] == [0]


def test_similar_pairs_by_edit_and_length(spark):
    """Appended ends, rare new words and scattered edits with a similarity of 0.8 or little more, for short and long texts."""
    rng = np.random.default_rng(5)
    rows, kinds = [], {}
    for size in (30, 60, 150, 400, 1000, 3000):
        for kind in ("end", "rare", "front", "scattered"):
            for _ in range(4):
                at = 2 * len(kinds)
                words = [f"w{x}" for x in rng.integers(0, 5000, size)]
                new = [f"n{at}-{k}" for k in range(int(size * 0.17))]
                if kind == "scattered":
                    other = list(words)
                    for k in rng.choice(size, max(1, size // 55), replace=False):
                        other[k] = f"n{at}-{k}"
                else:
                    other = {"end": words + [f"w{x}" for x in rng.integers(0, 5000, len(new))], "rare": words + new, "front": new + words}[kind]
                rows += [(at, " ".join(words)), (at + 1, " ".join(other))]
                kinds[at] = (kind, size)
    want, _ = plain_links(rows)
    assert {kinds[a] for a, b in want if b == a + 1} >= set(kinds.values()) - {("scattered", 30)}  # one edit of 30 words is too much
    got = {(r.a, r.b) for r in simhash.similar_links(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == want


@pytest.mark.parametrize("block", [simhash.BLOCK, 5])
def test_buckets_that_mix_groups(spark, monkeypatch, block):
    """Chains of copies and unlike texts that share a long common passage: every similar pair ends in one component."""
    monkeypatch.setattr(simhash, "BLOCK", block)
    rng = np.random.default_rng(8)
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for group in range(6):
        words = passage + [f"g{group}-{k}" for k in range(30)]
        for k in range(14):  # each copy has an edit more than the one before, so the ends are far apart
            words = list(words)
            words[62 + 2 * k] = f"e{group}-{k}"
            rows.append((len(rows), " ".join(words)))
    rows = [(i, rows[k][1]) for i, k in enumerate(rng.permutation(len(rows)))]
    want, _ = plain_links(rows)
    root = {i: i for i, _ in rows}
    for _ in rows:
        for a, b in want:
            root[a] = root[b] = min(root[a], root[b])
    got = simhash.similar_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.a, r.b) for r in got.collect()} <= want
    label = {r.node: r.label for r in simhash.components(got).collect()}
    assert {i: label.get(i, i) for i in root} == root


def test_long_chain_is_one_component(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(400)], "a bigint, b bigint")
    assert {(r.node, r.label) for r in simhash.components(edges).collect()} == {(k, 0) for k in range(401)}


def test_a_hot_bucket_is_searched_in_parts(spark):
    """100,000 texts under one key, in two components: the smaller one is dealt over many parts, none of which lacks a member."""
    n = 100_000
    large = spark.range(n).selectExpr("7L AS key", "id AS doc", "100 AS n", "1 AS place", "id AS bits")
    label = spark.range(n).selectExpr("id AS node", "id % 3 DIV 2 AS label")
    parts = simhash._searched(large, label).groupBy("bucket").agg(F.count("*").alias("m"), F.count_if("seeks").alias("s")).collect()
    assert len(parts) == -(-(n // 3) // simhash.BLOCK) and {r.m for r in parts} == {n}
    assert sum(r.s for r in parts) == n // 3 and max(r.s for r in parts) < 2 * simhash.BLOCK


def test_unlike_texts_of_a_bucket_make_no_pairs(spark, monkeypatch):
    """40 texts share a passage and meet in many buckets; none is like another but for two copies, so searching on makes no pair."""
    stored, searched = simhash.stored, []

    def counted(df, what):
        out = stored(df, what)
        if what == "untried":
            searched.append(out.count())
        return out

    monkeypatch.setattr(simhash, "stored", counted)
    passage = [f"p{k}" for k in range(60)]
    rows = [(i, " ".join(passage + [f"o{i}-{k}" for k in range(20)])) for i in range(40)]
    rows.append((40, rows[39][1] + " end"))
    want, _ = plain_links(rows)
    got = simhash.similar_links(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert {(r.a, r.b) for r in got.collect()} == want == {(39, 40)}
    assert sum(searched) <= 1


def test_a_pair_meets_in_its_first_bucket(spark):
    """Of buckets with the same texts one stays; later buckets of a pair name one that has it."""
    held = {1: [10, 11, 12], 2: [10, 11, 12], 3: [10, 11], 4: [12]}
    rows = [(key, doc, doc * 7, 20, key - 1, 0) for key, docs in held.items() for doc in docs]
    members = spark.createDataFrame(rows, "key bigint, doc bigint, text bigint, n int, place int, bits bigint")
    got = sorted((r.key, r.doc, r._m, r._c.doc, r.p, r.q) for r in simhash._buckets(members).collect())
    assert got == [(1, 10, 3, 10, 0, 0), (1, 11, 3, 10, 0, 0), (1, 12, 3, 10, 0, 0), (3, 10, 2, 10, 1, 0), (3, 11, 2, 10, 1, 0)]


def test_keys_of_one_text_are_not_grouped(spark):
    """Of 60,000 keys all but ten have one text: besides the rows themselves only counts of their keys are shuffled."""

    def written():
        sc = spark.sparkContext._jsc.sc()
        sc.listenerBus().waitUntilEmpty(30_000)
        return sc.statusStore().executorList(False).head().totalShuffleWrite()

    some = spark.range(60_000).selectExpr("xxhash64(id) AS key", "id DIV 100 AS doc", "xxhash64(id DIV 100) AS text", "500 AS n", "CAST(id % 100 AS int) AS place", "xxhash64(-id DIV 100) AS bits")
    members = simhash.stored(some.unionByName(some.where("doc < 10 AND place = 0").withColumns({"doc": F.lit(9_000).cast("bigint"), "text": F.lit(9).cast("bigint")})), "some")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    before = written()
    try:
        assert simhash._buckets(members).count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert (written() - before) / 60_010 < 40  # bytes a row; 47 when all rows were grouped with their texts, 31 now


def test_signatures_go_before_buckets_are_made(spark, monkeypatch):
    """Texts are chosen from the signatures, which then leave the disk; both hold every first shingle."""
    stored, there = simhash.stored, {}

    def noted(df, what):
        there[what] = stored(df, what)
        if what == "members":
            there["then"] = {k: os.path.exists(there[k].stored_at.removeprefix("file:")) for k in ("signatures", "texts", "chosen")}
        return there[what]

    monkeypatch.setattr(simhash, "stored", noted)
    words = [f"w{k}" for k in range(100)]
    df = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words)), (3, " ".join(words + ["end"]))], "doc_id bigint, text string")
    assert {(r.a, r.b) for r in simhash.similar_links(df).collect()} == {(1, 2), (1, 3)}
    assert there["then"] == {"signatures": False, "texts": False, "chosen": True}
