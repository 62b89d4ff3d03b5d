"""Incremental removal of passages that an earlier document already has.

A window is WINDOW words in a row.  A window that starts in a document with a smaller doc_id is a repeat, and
every word of it goes.  The index is log-structured; each batch of documents adds immutable runs, sorted by hash:

* texts (sha, lo): whole texts and the smallest doc_id of each.  A later document of the same words is a repeat from end
  to end and goes no further, so groups of copies cost one row each;
* anchors (anchor, doc_id): the windows' fingerprints thinned by content.  Of the GRAM-word hashes in a window the
  smallest stands for it, so equal windows have equal anchors wherever they stand, and a run is a small fraction of
  the text;
* verified (anchor): anchors that two documents share, whose windows are known;
* windows (h, c, lo): 96-bit hashes of the windows around verified anchors, and the smallest doc_id that has each.

A new batch's anchors are merge-joined with the runs.  Where one is shared for the first time, the earlier documents
that have it are read once more for the windows around it; a document is never read for the same anchor again.  The
batch's own windows around shared anchors are then merge-joined with the runs of windows, verified by all 96 bits, and
those with a smaller doc_id are repeats.  More than FAN runs of a kind are compacted into one and the old ones deleted.
A manifest, written last, says which runs count, so an index can be opened again by a later session, and a batch that
was broken off leaves nothing that is read.

Batches come in order of doc_id, which is of any type that can be ordered.  Texts are tokenised once for their anchors;
only documents that share an anchor are read again for their windows, and only those that lose words for what is kept.
Nothing is gathered but the windows of one document.  Null text counts as empty; documents shorter than a window lose
nothing; rows that share a doc_id never remove each other's words; rows without a doc_id neither lose words nor cost
others theirs; equal rows give equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import delete, discard, map_batches, release, scratch, stored

WINDOW, GRAM, FAN = 50, 8, 2
#: So many doc_ids are broadcast to keep texts that nobody asks for out of a shuffle; beyond, all texts are shuffled.
IDS = 2_000_000
BASE = np.uint64(0x9E3779B97F4A7C15)
REMEMBERED = 100_000


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > REMEMBERED:
            self.clear()
        got = self[word] = xxhash.xxh3_64_intdigest(word)
        return got


@lru_cache(maxsize=1)
def _words() -> _Words:
    return _Words()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_words().__getitem__, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(hashes: np.ndarray, size: int, base: np.uint64 = BASE) -> np.ndarray:
    """Mixed polynomial hashes of every ``size`` neighbours, by doubling: a few passes whatever the size."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out, done, power, span, factor = np.zeros(n, np.uint64), 0, hashes, 1, base
    left = size
    with np.errstate(over="ignore"):
        while left:
            if left & 1:  # append a stretch of the present span to what is hashed so far
                out = out * factor + power[done : done + n]
                done += span
            left >>= 1
            if left:
                power = power[: len(power) - span] * factor + power[span:]
                factor = factor * factor
                span *= 2
        return _mixed(out)


def _sliding(values: np.ndarray, size: int, pick) -> np.ndarray:
    """Minimum or maximum of every ``size`` neighbours, by block prefixes and suffixes."""
    n = len(values)
    if size == 1:
        return values
    fill = values[-1:] if pick is np.maximum else values[-1:]
    padded = np.concatenate([values, np.repeat(fill, -n % size)]).reshape(-1, size)
    ahead = pick.accumulate(padded, axis=1).ravel()
    behind = pick.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return pick(behind[: n - size + 1], ahead[size - 1 : n])


def anchors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and fingerprints that stand for the windows of a text: every window holds one, chosen by content alone."""
    if len(hashes) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    grams = rolled(hashes, GRAM)
    per = WINDOW - GRAM + 1
    least = _sliding(grams, per, np.minimum)
    edge = np.zeros(per - 1, np.uint64)
    highest = _sliding(np.concatenate([edge, least, edge]), per, np.maximum)
    chosen = np.flatnonzero(highest == grams)
    return chosen, grams[chosen]


def window_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent hashes of each window: 64 bits and 32 bits."""
    with np.errstate(over="ignore"):
        second = rolled(_mixed(hashes + np.uint64(1)), WINDOW, np.uint64(0xD6E8FEB86659FD93))
    return rolled(hashes, WINDOW), (second >> np.uint64(32)).astype(np.uint32)


def tokenised(df: DataFrame) -> DataFrame:
    """doc_id, n_words, whole_sha256 (of the words joined by one space) and anchors: the one look at every text."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        count, sha, found = [], [], []
        for x in batch.column(1):
            words = (x.as_py() or "").encode().split()
            count.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            found.append(np.unique(anchors(word_hashes(words))[1]).view(np.int64))
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "n_words", "whole_sha256", "anchors"])

    kind = df.schema["doc_id"].dataType.simpleString()
    return map_batches(df.select("doc_id", "text"), f"doc_id {kind}, n_words bigint, whole_sha256 string, anchors array<bigint>", rows)


def _near(shared: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Windows that hold a shared anchor."""
    places, found = anchors(hashes)
    places = places[np.isin(found, shared)]
    n = len(hashes) - WINDOW + 1
    turns = np.zeros(n + 1, np.int64)
    np.add.at(turns, np.maximum(0, places - (WINDOW - GRAM)), 1)
    np.add.at(turns, np.minimum(places, n - 1) + 1, -1)
    return np.flatnonzero(np.cumsum(turns[:-1]) > 0)


def windows(marked: DataFrame) -> DataFrame:
    """(h, c, doc_id) of the windows around shared anchors, once for each text; marked has doc_id, text, shared."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        at, first, second = [], [], []
        for k, (x, shared) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
            hashes = word_hashes((x.as_py() or "").encode().split())
            if len(hashes) < WINDOW:
                continue
            some = _near(shared.values.to_numpy().view(np.uint64), hashes)
            h, c = window_hashes(hashes)
            h, pick = np.unique(h[some], return_index=True)
            at.append(np.full(len(h), k))
            first.append(h)
            second.append(c[some][pick])
        none = [np.zeros(0, np.uint64)]
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(first or none).view(np.int64)), pa.array(np.concatenate(second or none).astype(np.uint32).view(np.int32)), batch.column(0).take(pa.array(np.concatenate(at or none).astype(np.int64)))], ["h", "c", "doc_id"]
        )

    return map_batches(marked.select("doc_id", "text", "shared"), f"h bigint, c int, doc_id {marked.schema['doc_id'].dataType.simpleString()}", rows)


def _cut(text: str | None, repeats: np.ndarray | None) -> tuple[list[bytes], list[bytes]]:
    """All words, and those outside the repeated windows."""
    words = (text or "").encode().split()
    if repeats is None or len(words) < WINDOW:
        return words, words
    starts = np.flatnonzero(np.isin(window_hashes(word_hashes(words))[0], repeats))
    turns = np.zeros(len(words) + 1, np.int64)
    turns[starts] += 1
    turns[starts + WINDOW] -= 1
    gone = np.cumsum(turns[:-1]) > 0
    return words, [w for w, g in zip(words, gone.tolist(), strict=True) if not g]


def _texts_of(documents: DataFrame, of: DataFrame, ids: DataFrame) -> DataFrame:
    """documents joined with ``of`` on doc_id; if the ids are few, texts without one do not enter the shuffle."""
    if ids.count() <= IDS:
        documents = documents.join(F.broadcast(ids), "doc_id", "left_semi")
    return documents.hint("merge").join(of, "doc_id")


class FingerprintIndex:
    """Sorted immutable runs in a shared folder, and the manifest that says which of them count."""

    KINDS = ("texts", "anchors", "verified", "windows")

    def __init__(self, spark: SparkSession, root: str | None = None, fan: int = FAN):
        """Opens the index at root (a new one if nothing is there), or makes one below spark.checkpoint.dir."""
        self.spark, self.fan, self.version = spark, fan, 0
        self.root = (root or scratch(spark, "fingerprints")).rstrip("/")
        self.runs: dict[str, list[str]] = {kind: [] for kind in self.KINDS}
        if root:
            self._open()

    def _open(self) -> None:
        try:
            rows = self.spark.read.schema("kind string, run string, version int").json(f"{self.root}/manifest")
            self.version = rows.agg(F.max("version")).first()[0] or 0
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return
        for r in rows.where(F.col("version") == self.version).collect():  # a few runs of each kind
            self.runs[r.kind].append(r.run)

    def _commit(self, old: list[str]) -> None:
        """Writes the manifest, then deletes the runs that no manifest of this index needs any more."""
        self.version += 1
        listed = [(kind, run, self.version) for kind in self.KINDS for run in self.runs[kind]]
        rows = self.spark.createDataFrame(listed, "kind string, run string, version int")
        rows.select("kind", "run", "version").coalesce(1).write.mode("append").json(f"{self.root}/manifest")
        delete(self.spark, *old)

    def _write(self, kind: str, rows: DataFrame) -> str:
        by = rows.columns if kind == "anchors" else rows.columns[:1]
        path = f"{self.root}/{kind}-{uuid.uuid4().hex}"
        rows.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(path)
        return path

    def run(self, kind: str) -> DataFrame | None:
        """All runs of a kind as one table."""
        return self.spark.read.parquet(*self.runs[kind]) if self.runs[kind] else None

    def add(self, **new: DataFrame) -> None:
        """One run of each kind; kinds with more than ``fan`` runs are compacted."""
        old = []
        for kind, rows in new.items():
            self.runs[kind].append(self._write(kind, rows))
            if len(self.runs[kind]) > self.fan:
                old += self.runs[kind]
                self.runs[kind] = [self._write(kind, self.run(kind))]
        self._commit(old)

    def ingest(self, batch: DataFrame, history: DataFrame | None = None, *, tokens: DataFrame | None = None, keep: bool = True) -> tuple[DataFrame, DataFrame]:
        """((doc_id, repeats), (doc_id, whole_sha256)): hashes of the windows of each document of the batch that an earlier
        one has, and the documents whose whole text an earlier one has.

        history has doc_id and text of (at least) the documents in the runs; tokens is ``tokenised`` of the batch, if it
        is there already.  Without keep the batch adds no run: the last batch of a table that will not grow.
        """
        some = tokens if tokens is not None else tokenised(batch)
        long_ = some.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= WINDOW)).withColumn("sha", F.unhex("whole_sha256"))
        texts = long_.groupBy("sha").agg(F.min("doc_id").alias("lo"), F.min_by("anchors", "doc_id").alias("anchors"))
        old_texts, old, verified, known = (self.run(kind) for kind in self.KINDS)
        if old_texts is None:
            texts = stored(texts.withColumn("seen", F.lit(None).cast(texts.schema["lo"].dataType)), "texts")
        else:
            texts = stored(texts.join(old_texts.groupBy("sha").agg(F.min("lo").alias("seen")), "sha", "left"), "texts")
        copies = long_.select("doc_id", "whole_sha256", "sha").join(texts.select("sha", F.least("lo", "seen").alias("lo")), "sha").where("doc_id > lo")
        copies = stored(copies.select("doc_id", "whole_sha256").distinct(), "copies")
        new = stored(texts.where("seen IS NULL").select(F.explode("anchors").alias("anchor"), F.col("lo").alias("doc_id")), "postings")
        spans = new.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
        if old is None:
            shared = stored(spans.where("lo < hi").select("anchor"), "shared")
            fresh = shared
        else:
            before = old.groupBy("anchor").agg(F.min("doc_id").alias("before"))
            shared = stored(spans.hint("merge").join(before, "anchor", "left").where("lo < hi OR before IS NOT NULL").select("anchor"), "shared")
            fresh = shared.join(verified, "anchor", "left_anti")

        def around(documents: DataFrame, postings: DataFrame, what: DataFrame, name: str) -> DataFrame:
            of = stored(postings.join(what, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared")), "of")
            got = stored(windows(_texts_of(documents.select("doc_id", "text"), of, of.select("doc_id"))), name)
            discard(of)
            return got

        own = around(batch, new, shared, "windows")
        others = [around(history, old, fresh, "old-windows")] if old is not None else []
        first = own.groupBy("h", "c").agg(F.min("doc_id").alias("lo"))
        for x in others:
            first = first.unionByName(x.groupBy("h", "c").agg(F.min("doc_id").alias("lo")))
        first = stored(first.groupBy("h", "c").agg(F.min("lo").alias("lo")), "first")
        earliest = first
        if known is not None:
            seen = known.groupBy("h", "c").agg(F.min("lo").alias("seen"))
            earliest = first.hint("merge").join(seen, ["h", "c"], "left").select("h", "c", F.least("lo", "seen").alias("lo"))
        hits = own.hint("merge").join(earliest, ["h", "c"]).where("doc_id > lo").groupBy("doc_id").agg(F.collect_set("h").alias("repeats"))
        out = stored(hits, "repeats")
        if keep:
            self.add(texts=texts.where("seen IS NULL").select("sha", "lo"), anchors=new.select("anchor", "doc_id"), verified=fresh.select("anchor"), windows=first.select("h", "c", "lo"))
        discard(own, *others, first, shared, new, texts)
        release(self.spark)
        return out, copies


def _cuts(ids: DataFrame, batches: int) -> list:
    """doc_ids at which the batches of rising doc_id begin, from a sample of a thousand ids; fewer if ids are few."""
    some = sorted(r[0] for r in ids.where("doc_id IS NOT NULL").orderBy(F.xxhash64("doc_id"), "doc_id").limit(1000).collect())
    return sorted({some[len(some) * k // batches] for k in range(1, batches)} - set(some[:1])) if some else []


def repeats(df: DataFrame, *, batches: int = 4, fan: int = FAN) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((doc_id, repeats), (doc_id, whole_sha256) of copies, ``tokenised``) of a whole table, ingested in batches of rising doc_id."""
    df = df.select("doc_id", "text")
    tokens = stored(tokenised(df), "tokens")
    index = FingerprintIndex(df.sparkSession, fan=fan)
    cuts = _cuts(tokens.select("doc_id"), batches)
    out, same, key = None, None, F.col("doc_id")
    for k in range(len(cuts) + 1):
        low = key >= F.lit(cuts[k - 1]) if k else F.lit(True)
        inside = low & (key < F.lit(cuts[k])) if k < len(cuts) else low
        got, copies = index.ingest(df.where(inside), df.where(key < F.lit(cuts[k - 1])) if k else None, tokens=tokens.where(inside), keep=k < len(cuts))
        out, same = (got, copies) if out is None else (out.unionByName(got), same.unionByName(copies))
    delete(df.sparkSession, index.root)
    return out, same, tokens


def digest(df: DataFrame, *, batches: int = 4) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words, joined by one space)."""
    found, copies, tokens = repeats(df, batches=batches)
    kind = df.schema["doc_id"].dataType.simpleString()

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        whole, gone, kept = [], [], []
        for x, r in zip(batch.column(1), batch.column(2), strict=True):
            words, left = _cut(x.as_py(), r.values.to_numpy().view(np.uint64))
            whole.append(hashlib.sha256(b" ".join(words)).hexdigest())
            gone.append(len(words) - len(left))
            kept.append(hashlib.sha256(b" ".join(left)).hexdigest())
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(whole, pa.string()), pa.array(gone, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "whole_sha256", "gone", "left"])

    texts = _texts_of(df.select("doc_id", "text"), found, found.select("doc_id"))
    cut = map_batches(texts.select("doc_id", "text", "repeats"), f"doc_id {kind}, whole_sha256 string, gone bigint, left string", rows).distinct()
    plain = tokens.select("doc_id", "n_words", "whole_sha256")
    # a copy may share its doc_id with another text, of which only the windows go
    gone = cut.unionByName(copies.join(cut, ["doc_id", "whole_sha256"], "left_anti").withColumn("gone", F.lit(None).cast("bigint")).withColumn("left", F.lit(hashlib.sha256(b"").hexdigest())))
    joined = plain.join(gone, ["doc_id", "whole_sha256"], "left")
    lost = F.when(F.col("left").isNull(), F.lit(0).cast("bigint")).otherwise(F.coalesce("gone", "n_words"))
    return joined.select("doc_id", "n_words", lost.alias("n_removed"), F.coalesce("left", "whole_sha256").alias("kept_sha256"))


def remove(df: DataFrame, *, batches: int = 4, length: str | None = "n_chars") -> DataFrame:
    """The same rows and columns without the repeated words; the white space around what is kept stays as it was.

    Documents that lose nothing keep their text as it is, and null texts stay null; length names the column, if
    there is one, that holds the text's number of characters.
    """
    found, copies, tokens = repeats(df, batches=batches)
    discard(tokens)
    place = df.columns.index("text")

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = batch.column(0).flatten()
        new = []
        for x, r, same in zip(columns[place], batch.column(1), batch.column(2), strict=True):
            text = x.as_py()
            new.append(text if text is None or not (r.is_valid or same.is_valid) else _without(text, r.values.to_numpy().view(np.uint64) if r.is_valid else NOTHING, same.as_py() or ()))
        return pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if k == place else c for k, c in enumerate(columns)], df_names)

    df_names = df.columns
    whole = df.select(F.struct(*[df[c] for c in df.columns]).alias("row"))
    same = copies.groupBy("doc_id").agg(F.collect_set("whole_sha256").alias("same"))
    lost = found.join(same, "doc_id", "full_outer")
    joined = whole.join(lost, F.col("row.doc_id") == lost["doc_id"], "left").select("row", "repeats", "same")
    out = map_batches(joined, df.schema, rows)
    return out.withColumn(length, F.length("text").cast(df.schema[length].dataType)) if length in df.columns else out


NOTHING = np.zeros(0, np.uint64)


def _without(text: str, repeated: np.ndarray, same: tuple[str, ...] = ()) -> str:
    """The text without the words of repeated windows, or without any if the digest of its words is among ``same``."""
    words = text.encode().split()
    if len(words) < WINDOW:
        return text
    starts = np.flatnonzero(np.isin(window_hashes(word_hashes(words))[0], repeated))
    turns = np.zeros(len(words) + 1, np.int64)
    turns[starts] += 1
    turns[starts + WINDOW] -= 1
    gone = np.cumsum(turns[:-1]) > 0
    if same and not gone.all() and hashlib.sha256(b" ".join(words)).hexdigest() in same:
        gone[:] = True
    if not gone.any():
        return text
    raw, out, at, kept_from = text.encode(), [], 0, 0
    for word, g in zip(words, gone.tolist(), strict=True):
        at = raw.index(word, at)
        if g:
            out.append(raw[kept_from:at])
            kept_from = at + len(word)
        at += len(word)
    out.append(raw[kept_from:])
    return b"".join(out).decode()
