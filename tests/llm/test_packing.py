import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from annolith.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, capacity):
    tokenizer = Tokenizer.from_file(FILE)
    out = []
    for key, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        out += [(key, k // capacity, k, len(ids[k : k + capacity]), zlib.crc32(np.array(ids[k : k + capacity], "<u4").tobytes())) for k in range(0, len(ids), capacity)]
    return sorted(out, key=str)


def check(packed, capacity):
    held = {}
    for r in packed:
        held.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in held.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


@pytest.mark.parametrize("capacity,items", [(64, 40_000), (2048, 60)])
def test_pieces_and_places(odd, corpus, capacity, items):
    for df in (odd, corpus):
        out, proof = packing.pack(packing.token_pieces(df, FILE, capacity=capacity), capacity=capacity, items=items)
        rows = out.collect()
        assert sorted([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows], key=str) == expected([(r.doc_id, r.text) for r in df.collect()], capacity)
        n = check(rows, capacity)
        bound = proof.first().table_bound
        assert bound <= n <= bound + 3 + (bound // 20 if items < 100 else 0)


def test_empty_table(none):
    out, proof = packing.pack(packing.token_pieces(none, FILE))
    assert out.count() == 0 and proof.count() == 0


def test_ids_are_given(odd):
    row = packing.token_pieces(odd.where("doc_id = 4"), FILE, with_ids=True).first()
    assert row.ids[-1] == 0 and row.length == len(row.ids)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=60))
def test_bound_and_best_fit(lengths):
    sizes = np.array(lengths, np.int64)
    bins, offsets, held = packing.best_fit_decreasing(sizes, 100)
    assert packing.lower_bound(sizes, np.ones(len(sizes), np.int64), 100) <= len(held)
    for k in range(len(held)):
        inside = sorted((int(o), int(s)) for o, s, b in zip(offsets, sizes, bins, strict=True) if b == k)
        assert sum(s for _, s in inside) == held[k] <= 100
        assert [o for o, _ in inside] == list(np.cumsum([0] + [s for _, s in inside])[:-1])


def test_bound_sees_what_a_sum_does_not():
    assert packing.lower_bound(np.array([51, 51, 51]), np.array([1, 1, 1]), 100) == 3
    assert packing.lower_bound(np.array([34]), np.array([6]), 100) == 3


ODD_TEXTS = ["it's I'LL we've ﬁne ½ Ångström ĳ İstanbul ΣΑΣ \x1c\x1d a\x1cb x\xa0y é É́ don't! 'tis (foo) foo's, µm ª º ×a ÷b", "<|endoftext|> a<|startoftext|>b", "ß ẞ ſ K Å", "日本語 text, 123abc a.b,c", "́abc abć , ́", "É́,. 'a a'' a'."]


def test_chunks_equal_the_whole_tokenizer():
    cache = packing.ChunkCache(FILE)
    for text in ODD_TEXTS:
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == cache.tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings():
    """Held against the tokenizer as it is in its file."""
    whole, cache = Tokenizer.from_file(FILE), packing.ChunkCache(FILE)
    a, b = "<|startoftext|>", "<|endoftext|>"
    for text in (f"{b} a{a}b", a, b + b, f"x{a[:-1]} {b}", b.upper() + " y", f"It's{b}'s end", f"\u0130{a} \u00c9t\u00e9{b}\n", f"{b}>{a}<|", ""):
        assert np.frombuffer(cache.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids, text


def test_equal_rows_are_dealt_apart(spark):
    pieces = spark.range(3000, numPartitions=6).selectExpr("7L AS doc_id", "0 AS piece", "0L AS start", "30L AS length", "5L AS ids_crc32")
    out, proof = packing.pack(pieces, capacity=2048, items=100)
    first = proof.where("round = 0").collect()
    assert len(first) == 30 and check(out.collect(), 2048) <= 2 * len(first)
