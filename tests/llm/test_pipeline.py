import corpus_pipeline
from annolith.llm import pii, simhash
from annolith.llm.common import stored


def test_stages(spark, corpus, odd):
    for docs in (corpus, odd):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stored(stage(spark, docs, ""), f"stage-{k}")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns and {r.doc_id for r in out.select("doc_id").collect()} <= {r.doc_id for r in docs.select("doc_id").collect()}
            if name == "SimHash near-dedup":
                groups = [r.component_id for r in simhash.classes(out).collect() if r.doc_id is not None]
                assert len(groups) == len({r.doc_id for r in out.collect() if r.doc_id is not None} & set(groups)) or docs is odd
            if name == "PII":
                assert all(not pii.plain_spans(r.text) for r in out.collect() if r.text)
            docs = out
        assert {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(docs.columns)


def test_run(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 100


def test_each_stage_is_its_brute_force(spark, corpus):
    """Every stage on all that the one before kept, against plain code on the same rows."""
    import duckdb
    import test_packing
    import test_simhash
    import test_substring

    from annolith.llm import pii, queries

    sf, docs, seen = "/root/testdata/sf0.001", corpus, {}
    for name, stage in corpus_pipeline.STAGES:
        rows = {r.doc_id: r.text for r in docs.collect()}
        docs = stored(stage(spark, docs, sf), "stage")
        seen[name] = rows, docs
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({queries.ORACLES['op6_quality_rules']}) WHERE kept").fetchall()}
    assert {r.doc_id for r in seen["quality rules"][1].collect()} == kept

    rows, out = seen["SimHash near-dedup"]
    links, _ = test_simhash.plain_links(list(rows.items()))
    bits = {i: test_simhash.plain_fingerprint(t) for i, t in rows.items()}
    root = {i: i for i in rows}
    pairs = links | {(a, b) for a in rows for b in rows if a < b and (bits[a] ^ bits[b]).bit_count() <= 4}
    for _ in range(len(rows)):
        before = dict(root)
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert {r.doc_id for r in out.collect()} == {i for i in rows if root[i] == i}

    rows, out = seen["substring dedup"]
    want = test_substring.plain(list(rows.items()))
    assert {r.doc_id: (r.text or "").encode().split() for r in out.collect()} == {i: left for i, (_, left) in want.items()}

    rows, out = seen["PII"]
    assert {r.doc_id: r.text for r in out.collect()} == {i: pii.redacted(t) for i, t in rows.items()}

    rows, out = seen["best-fit packing"]
    got = out.collect()
    assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got], key=str) == test_packing.expected(list(rows.items()), 2048)
    test_packing.check(got, 2048)
