"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents are cut into pieces of at most ``capacity`` tokens (only longer documents are cut).  Pieces are
dealt to partitions of bounded size and packed there best-fit decreasing.  Dual-feasible functions of the
length histogram give a lower bound for each partition and for the whole table.  While the table needs
more sequences than its bound, partitions hand over the pieces of sequences with gaps; these are dealt
anew over fewer partitions and packed again.  Every round is written to the shared folder, so a lost
executor costs one round at most.

No step gathers more than ``items`` pieces in a task; the driver sees the histogram of lengths (``capacity``
rows at most) and a few sums.  Null text counts as empty and gives one piece that holds the end id only.
Repeated rows are packed as often as they stand there; an empty table gives no rows; ties go by key.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, stored

#: Chunks whose ids a worker remembers, twice: those met lately, and those met before.
REMEMBERED = 200_000
#: One run of letters, whose lower case and normal form are simple, and perhaps ASCII marks after it.
#: An apostrophe is no such mark: the tokenizer cuts contractions there.
PLAIN = re.compile("([a-zA-ZÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The letters by which byte-level vocabularies write bytes: printable ones as they are, the rest from U+0100."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in same]
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(rest)}


class ChunkCache(dict):
    """Ids (little-endian uint32) of chunks between ASCII white space, with A-Z in lower case.

    The tokenizer drops white space, and neither its normaliser nor its merges reach across it, so a
    document's ids are its chunks' ids in a row, between the special strings it may hold.  A plain chunk goes straight to the tokenizer's merges;
    any other goes through all of it.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        special = {t.content: struct.pack("<I", k) for k, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special, self.cuts = special, re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.lowered = Tokenizer.from_file(tokenizer_file)
        self.lowered.encode_special_tokens = True  # what only looks special in lower case is none
        self.model, self.letters, self.before = self.tokenizer.model, _byte_letters(), {}

    def __missing__(self, chunk: bytes) -> bytes:
        got = self.before.get(chunk)
        if got is None:
            text = chunk.decode()
            m = PLAIN.fullmatch(text)
            if m is None:
                ids = self.lowered.encode(text, add_special_tokens=False).ids
            else:
                word, marks = m.groups()
                word = word if word.isascii() else "".join(map(self.letters.__getitem__, word.lower().encode()))
                ids = [t.id for t in self.model.tokenize(word)] + ([t.id for t in self.model.tokenize(marks)] if marks else [])
            got = struct.pack(f"<{len(ids)}I", *ids)
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        self[chunk] = got
        return got

    def ids(self, text: str) -> bytes:
        """The text's ids; its special strings, which count in their own case only, give their own."""
        if self.cuts is None or not self.cuts.search(text):
            return b"".join(map(self.__getitem__, text.encode().lower().split()))
        return b"".join(self.special[x] if k % 2 else b"".join(map(self.__getitem__, x.encode().lower().split())) for k, x in enumerate(self.cuts.split(text)))


@lru_cache(maxsize=2)
def chunk_cache(tokenizer_file: str) -> ChunkCache:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return ChunkCache(tokenizer_file)


def token_pieces(df: DataFrame, tokenizer_file: str, *, capacity: int = 2048, end_id: int = 0, text: str = "text", key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 and, if asked for, ids of every piece."""
    tail = np.array([end_id], "<u4").tobytes()

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        cache = chunk_cache(tokenizer_file)
        at, piece, start, length, crc, ids = [], [], [], [], [], []
        for row, x in enumerate(batch.column(1)):
            raw = cache.ids(x.as_py() or "") + tail
            for k, begin in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[begin : begin + 4 * capacity]
                at.append(row)
                piece.append(k)
                start.append(begin // 4)
                length.append(len(part) // 4)
                crc.append(zlib.crc32(part))
                if with_ids:
                    ids.append(np.frombuffer(part, "<u4").astype(np.int32))
        columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        if with_ids:
            columns.append(pa.array(ids, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    kind = df.schema[key].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), schema, rows)


def lower_bound(lengths: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    """The best of the Fekete-Schepers bounds: no packing has fewer bins.

    Two families of dual-feasible functions: with threshold a, lengths over capacity - a count as whole
    bins and those under a as nothing; with k, lengths are rounded down to multiples of 1/(k+1) and
    stretched to k-ths, but for exact multiples.
    """
    if not len(lengths):
        return 0
    many = np.zeros(capacity + 1, np.int64)
    np.add.at(many, lengths, counts)
    size = np.arange(capacity + 1)
    n, total = np.concatenate([[0], np.cumsum(many)]), np.concatenate([[0], np.cumsum(many * size)])
    a = np.arange(0, capacity // 2 + 1)
    whole = n[-1] - n[capacity - a + 1]
    part = total[capacity - a + 1] - total[a]
    best = int(np.max(whole + -(-part // capacity)))
    for k in range(1, 25):
        steps = (k + 1) * size
        value = np.where(steps % capacity == 0, size * k, steps // capacity * capacity)
        best = max(best, -(-int((many * value).sum()) // (k * capacity)))
    return best


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and offset of each length (longest first, ties in the order given), and what each bin holds."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    there, held = 0, []  # there: bit r is set if some bin has r left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fits = there >> size
        if fits:
            left = size + (fits & -fits).bit_length() - 1
            to = free[left].pop()
            if not free[left]:
                there ^= 1 << left
        else:
            left, to = capacity, len(held)
            held.append(0)
        bins[i], offsets[i] = to, held[to]
        held[to] += size
        left -= size
        if left:
            if not free[left]:
                there |= 1 << left
            free[left].append(to)
    return bins, offsets, np.array(held, np.int64)


PLACED = "doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, part bigint, sequence_id bigint, offset bigint, bins bigint, bound bigint, gap boolean"


def _packer(turn: int, capacity: int, last: bool, alone: bool):
    """Packs one partition; ``gap`` marks the pieces of sequences to hand over."""

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("ids_crc32", "ascending")])
        lengths = table["length"].to_numpy()
        bins, offsets, held = best_fit_decreasing(lengths, capacity)
        bound = lower_bound(lengths, np.ones(len(lengths), np.int64), capacity)
        loose = (held < capacity) & (not last) & (not alone or len(held) > bound)
        part = table["part"][0].as_py()
        n = len(lengths)
        added = ((turn << 56) | (part << 28) | bins, offsets, np.full(n, len(held)), np.full(n, bound), loose[bins])
        for name, values in zip(("sequence_id", "offset", "bins", "bound", "gap"), added, strict=True):
            table = table.append_column(name, pa.array(values))
        return table

    return packed


def pack(pieces: DataFrame, *, capacity: int = 2048, items: int = 40_000, rounds: int = 4) -> tuple[DataFrame, DataFrame]:
    """The pieces with sequence_id and offset, and a certificate for each partition of each round.

    A certificate has round, part, bins, bound and released (the sequences handed over to the next round).
    """
    spark = pieces.sparkSession
    kind = pieces.schema["doc_id"].dataType.simpleString()
    pieces = stored(pieces.select("doc_id", "piece", "start", "length", "ids_crc32"), "pieces")
    histogram = pieces.groupBy("length").count().collect()  # a row for each length up to the capacity
    table_bound = lower_bound(np.array([r[0] for r in histogram], np.int64), np.array([r[1] for r in histogram], np.int64), capacity)
    waiting, n = pieces, sum(r[1] for r in histogram)
    placed, certificates, settled, before = [], [], 0, None
    for turn in range(rounds):
        parts = max(1, -(-n // items))
        last = turn == rounds - 1

        # the row number spreads equal rows; waiting is a stored table, so a task that runs again numbers them alike
        dealt = waiting.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id(), F.lit(turn)), F.lit(parts)))
        done = stored(dealt.groupBy("part").applyInArrow(_packer(turn, capacity, last, parts == 1), PLACED.format(kind=kind)), f"packed-{turn}")
        by_part = done.groupBy("part").agg(
            F.first("bins").alias("bins"), F.first("bound").alias("bound"), F.count_distinct(F.when(F.col("gap"), F.col("sequence_id"))).alias("released"), F.count_if("gap").alias("again")
        )
        bins, released, again = by_part.agg(F.sum("bins"), F.sum("released"), F.sum("again")).first()
        bins, released, again = bins or 0, released or 0, again or 0
        certificates.append(by_part.select(F.lit(turn).alias("round"), "part", "bins", "bound", "released"))
        certified = settled + bins <= table_bound
        if last or certified or not again or (before is not None and bins >= before):
            placed.append(done)  # certified, or a further exchange would not help
            break
        placed.append(done.where(~F.col("gap")))
        settled += bins - released
        waiting, n, before = done.where("gap").select("doc_id", "piece", "start", "length", "ids_crc32"), again, released
    out = placed[0]
    for more in placed[1:]:
        out = out.unionByName(more)
    proof = certificates[0]
    for more in certificates[1:]:
        proof = proof.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"), proof.withColumn("table_bound", F.lit(table_bound))
