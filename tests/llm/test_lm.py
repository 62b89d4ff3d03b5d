import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from annolith.llm import ngram_lm
from annolith.llm.packing import chunk_cache

FILE = public_tokenizers.path("word_bpe_49k.json")


def plain(rows, order, alpha=0.4):
    """Counts in dictionaries, one unit after the other; rows that share an id are summed."""
    cache = chunk_cache(FILE)
    docs = [(i, np.frombuffer(cache.ids(t or ""), "<u4").tolist()) for i, t in rows]

    def counted(ids):
        grams, contexts = Counter(), Counter()
        padded = [None] * order + ids
        for k in range(order, len(padded)):
            for n in range(1, order + 1):
                grams[tuple(padded[k - n + 1 : k + 1])] += 1
                contexts[n, tuple(padded[k - n + 1 : k])] += 1
        return grams, contexts

    all_grams, all_contexts = Counter(), Counter()
    for _, ids in docs:
        g, c = counted(ids)
        all_grams += g
        all_contexts += c
    out = {}
    for i, ids in docs:
        g, c = counted(ids)
        padded, total, off = [None] * order + ids, 0.0, 0
        for k in range(order, len(padded)):
            factor = 1.0
            for n in range(order, 0, -1):
                gram = tuple(padded[k - n + 1 : k + 1])
                others = all_grams[gram] - g[gram]
                if others:
                    factor *= others / (all_contexts[n, gram[:-1]] - c[n, gram[:-1]])
                    break
                off += n == order
                factor *= alpha
            else:
                factor /= 49_408
            total += math.log(factor)
        before = out.get(i, (0, 0.0, 0))
        out[i] = (before[0] + len(ids), before[1] + total, before[2] + off)
    return out


@pytest.mark.parametrize("order,units", [(1, 10**6), (2, 3000), (3, 20_000), (4, 10**6)])
def test_scores(corpus, odd, order, units):
    """Repeated rows, rows without an id, null and empty texts included."""
    for df in (corpus, odd):
        want = plain([(r.doc_id, r.text) for r in df.collect()], order)
        got = ngram_lm.score(df, FILE, order=order, units=units).collect()
        assert len(got) == len(want)
        for r in got:
            n, total, backed = want[r.doc_id]
            assert (r.n_tokens, r.n_backed_off) == (n, backed) and abs(r.log_score - total) < 1e-3 * max(1, n / 1000)
            assert (r.mean_log_score is None) == (n == 0)


def test_limits(none, odd):
    assert ngram_lm.score(none, FILE).count() == 0
    with pytest.raises(ValueError):
        ngram_lm.score(odd, FILE, order=5)
