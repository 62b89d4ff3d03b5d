import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from annolith.llm import sentencepiece_codec as codec

FILE = public_tokenizers.path("piece_bpe_32k.model")


def test_equals_the_library(odd, corpus):
    own = sentencepiece.SentencePieceProcessor(model_file=FILE)
    for df in (odd, corpus):
        for r, want in ((r, None) for r in codec.round_trip_digest(df, FILE).collect()):
            texts = {x.text or "" for x in df.collect() if x.doc_id == r.doc_id}
            ids = own.encode(texts.pop())
            assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(own.decode(ids).encode()).hexdigest())


def test_spans_tile_the_source(odd):
    texts = {r.doc_id: (r.text or "").encode() for r in odd.collect()}
    encoded = codec.encode(odd, FILE)
    for r in encoded.collect():
        assert b"".join(texts[r.doc_id][a:b] for a, b in zip(r.span_start, r.span_end, strict=True)) == texts[r.doc_id]
    back = {r.doc_id: r.text for r in codec.decode(encoded, FILE).collect()}
    assert back[4] == texts[4].decode() and back[1] == ""


def test_empty_table(none):
    assert codec.encode(none, FILE).count() == 0 and codec.round_trip_digest(none, FILE).count() == 0


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_compiled_maps(rule):
    """Longest-prefix normalisation agrees with the library's for its own compiled maps."""
    library = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    own = codec.Normalizer(library.serialized_model_proto())
    rng = random.Random(3)
    pool = "aB ½ﬁＡⅧ\t　éÅ가각ﾊﾟ㌔１²  "
    for text in ["", " ", "  ﬁne  Ａ　Ｂ ½ é ", *["".join(rng.choices(pool, k=rng.randrange(1, 30))) for _ in range(200)]]:
        normal, places = own.align(text.encode())
        assert normal.decode() == library.normalize(text)
        assert len(places) == len(normal) + 1 and list(places) == sorted(places)
