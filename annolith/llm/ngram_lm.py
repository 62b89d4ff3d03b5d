"""Stupid-backoff scores of documents under the n-gram counts of their own corpus.

Units are the ids of a public tokenizer, with start marks before each document.  n-grams of the highest order are counted
over all documents; shorter n-grams and contexts are sums of that table.  With each n-gram's count stands its context's:

    S_n(w | v) = c(vw) / c(v.)            if others have vw
                 ALPHA S_(n-1)(w | v')     else, v' being v without its first unit
    S_0        = ALPHA^0 / V

so that each step down costs one factor ALPHA, and what no other document has at all costs ALPHA^order / V.  A document's
own occurrences are taken off all counts first, else each of its n-grams would vouch for itself.

Documents are dealt into slices of about SLICE units.  A slice is exploded into its distinct n-grams of every order; these
are joined by hash to the count tables, and what is found goes back to the slice, where it is summed for each document.
An n-gram that every document has is one row for each slice, not one for each document, and nothing is broadcast.

Ids take 16 bits, a vocabulary beyond that is refused, and an n-gram is one 64-bit number: orders go up to four.  Null and
empty texts have no units: n_tokens 0, log_score 0, and a null mean.  Repeated rows, which share a doc_id, are scored one by
one and summed as one document, rows without a doc_id too; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored
from .packing import chunk_cache

START, BITS, ORDERS = 0xFFFF, 16, 4
ALPHA = 0.4
#: Units of a slice (a longer document stays whole).
SLICE = 1_000_000


def token_slices(df: DataFrame, tokenizer_file: str, *, units: int = SLICE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """slice, doc_ids, sizes (units of each document) and ids (little-endian uint16, all documents in a row)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        cache = chunk_cache(tokenizer_file)
        if max(cache.tokenizer.get_vocab_size(with_added_tokens=True), 0) > START:
            raise ValueError("the vocabulary has ids beyond 16 bits")
        turn, keys, parts, held, of = TaskContext.get().partitionId() << 32, [], [], 0, None

        def made() -> pa.RecordBatch:
            sizes = pa.array([[len(p) // 2 for p in parts]], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array([turn], pa.int64()), pa.array([keys], pa.list_(of)), sizes, pa.array([b"".join(parts)], pa.binary())], ["slice", "doc_ids", "sizes", "ids"])

        for batch in batches:
            of = batch.schema.field(0).type
            for k, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                keys.append(k)
                parts.append(np.frombuffer(cache.ids(x.as_py() or ""), "<u4").astype("<u2").tobytes())
                held += len(parts[-1]) // 2
                if held >= units:
                    yield made()
                    turn, keys, parts, held = turn + 1, [], [], 0
        if keys:
            yield made()

    return df.select(df[key].alias("doc_id"), df[text]).mapInArrow(run, f"slice bigint, doc_ids array<{kind}>, sizes array<int>, ids binary")


def grams(ids: np.ndarray, first: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each unit, earlier units in higher bits; first is the place of each unit in its document."""
    out = ids.astype(np.uint64)
    for back in range(1, order):
        before = np.full(len(ids), START, np.uint64)
        before[back:] = ids[:-back]
        before[first < back] = START
        out |= before << np.uint64(BITS * back)
    return out


def _places(sizes: np.ndarray) -> np.ndarray:
    starts = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) - np.repeat(starts, sizes)


def _slice_of(row_sizes, row_ids) -> tuple[np.ndarray, np.ndarray]:
    sizes = row_sizes.values.to_numpy().astype(np.int64)
    return np.frombuffer(row_ids.as_py(), "<u2"), sizes


def counts(slices: DataFrame, order: int) -> DataFrame:
    """n, gram, c and x (its context's count) of every n-gram of orders 1 to ``order``, over all slices."""

    def rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for sizes, ids in zip(batch.column(0), batch.column(1), strict=True):
            w, n = _slice_of(sizes, ids)
            gram, c = np.unique(grams(w, _places(n), order), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(c.astype(np.int64))], ["gram", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from rows(batch)

    table = stored(slices.select("sizes", "ids").mapInArrow(run, "gram bigint, c bigint").groupBy("gram").agg(F.sum("c").alias("c")), "grams")
    out = None
    for n in range(order, 0, -1):
        of = table if n == order else table.groupBy(F.col("gram").bitwiseAND(F.lit((1 << BITS * n) - 1)).alias("gram")).agg(F.sum("c").alias("c"))
        context = F.shiftrightunsigned("gram", BITS)
        sums = of.groupBy(context.alias("v")).agg(F.sum("c").alias("x"))
        both = of.withColumn("v", context).hint("merge").join(sums, "v").select(F.lit(n).alias("n"), "gram", "c", "x")
        out = both if out is None else out.unionByName(both)
    return out


def wanted(slices: DataFrame, order: int) -> DataFrame:
    """slice, n, gram: the distinct n-grams of each slice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for slice_, sizes, ids in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
                w, n = _slice_of(sizes, ids)
                place = _places(n)
                for k in range(1, order + 1):
                    gram = np.unique(grams(w, place, k))
                    for at in range(0, len(gram), 1 << 18):
                        some = gram[at : at + (1 << 18)].view(np.int64)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), slice_)), pa.array(np.full(len(some), k, np.int32)), pa.array(some)], ["slice", "n", "gram"])

    return slices.select("slice", "sizes", "ids").mapInArrow(run, "slice bigint, n int, gram bigint")


class _Table:
    """Sorted n-grams of one order with their counts."""

    def __init__(self, gram: np.ndarray, c: np.ndarray, x: np.ndarray):
        by = np.argsort(gram)
        self.gram, self.c, self.x = gram[by], c[by], x[by]

    def of(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.gram, some)
        return self.c[at], self.x[at]


def _own(every: np.ndarray, some: np.ndarray) -> np.ndarray:
    """How often each of ``some`` stands in ``every``."""
    seen, n = np.unique(every, return_counts=True)
    return n[np.searchsorted(seen, some)]


def score_document(ids: np.ndarray, tables: dict[int, _Table], order: int, vocabulary: int, alpha: float) -> tuple[float, int]:
    """The sum of log scores of a document's units, and how many backed off."""
    place = np.arange(len(ids))
    total, off, cost = 0.0, 0, 0.0
    gram, many = np.unique(grams(ids, place, order), return_counts=True)
    for n in range(order, 0, -1):
        every = grams(ids, place, n)
        c, x = tables[n].of(gram)
        others = c - (many if n == order else _own(every, gram))
        context = gram >> np.uint64(BITS)
        have = others > 0
        if have.any():
            rest = x[have] - _own(every >> np.uint64(BITS), context[have])
            total += float((many[have] * (np.log(others[have] / rest) + cost)).sum())
        gram, many = gram[~have], many[~have]
        off = int(many.sum()) if n == order else off
        cost += np.log(alpha)
        if not len(gram):
            return total, off
        gram, back = np.unique(gram & np.uint64((1 << BITS * (n - 1)) - 1), return_inverse=True)
        many = np.bincount(back, weights=many).astype(np.int64)
    return total + float(many.sum()) * (cost - np.log(vocabulary)), off


def score(df: DataFrame, tokenizer_file: str, *, order: int = 3, vocabulary: int | None = None, alpha: float = ALPHA, units: int = SLICE, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, log_score (natural logarithm, summed), mean_log_score and n_backed_off.

    vocabulary is the size of the tokenizer's, unless it is given.
    """
    if not 1 <= order <= ORDERS:
        raise ValueError(f"orders go from 1 to {ORDERS}")
    if vocabulary is None:
        from tokenizers import Tokenizer

        vocabulary = Tokenizer.from_file(tokenizer_file).get_vocab_size(with_added_tokens=True)
    slices = stored(token_slices(df, tokenizer_file, units=units, text=text, key=key), "slices")
    found = wanted(slices, order).hint("merge").join(counts(slices, order), ["n", "gram"]).select("slice", "n", "gram", "c", "x")
    kind = df.schema[key].dataType.simpleString()

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        n, gram, c, x = (right[name].to_numpy() for name in ("n", "gram", "c", "x"))
        gram = gram.view(np.uint64)
        tables = {k: _Table(gram[n == k], c[n == k], x[n == k]) for k in range(1, order + 1)}
        keys, sizes, got = [], [], []
        for ids, size, own in zip(left["ids"], left["sizes"], left["doc_ids"], strict=True):
            w, m = _slice_of(size, ids)
            ends = np.cumsum(m)
            keys.append(own.values)
            sizes.append(m)
            got += [score_document(w[e - k : e], tables, order, vocabulary, alpha) if k else (0.0, 0) for e, k in zip(ends.tolist(), m.tolist(), strict=True)]
        return pa.table({"doc_id": pa.chunked_array(keys), "size": pa.array(np.concatenate(sizes)), "log_score": pa.array([s for s, _ in got], pa.float64()), "off": pa.array([o for _, o in got], pa.int64())})

    each = stored(slices.groupBy("slice").cogroup(found.groupBy("slice")).applyInArrow(scored, f"doc_id {kind}, size bigint, log_score double, off bigint"), "scores")
    discard(slices)
    sums = each.groupBy("doc_id").agg(F.sum("size").alias("n_tokens"), F.sum("log_score").alias("log_score"), F.sum("off").alias("n_backed_off"))
    return sums.select("doc_id", "n_tokens", F.round("log_score", 4).alias("log_score"), F.round(F.when(F.col("n_tokens") > 0, F.col("log_score") / F.col("n_tokens")), 6).alias("mean_log_score"), "n_backed_off")
