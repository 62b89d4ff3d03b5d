"""Near-duplicates by SimHash and covering locality-sensitive hashing.

A fingerprint bit is the majority of that bit over the 64-bit hashes of a text's shingles.  To find every
pair of fingerprints at most r bits apart, each bit gets a vector of r + 1 binary digits; each non-zero
vector v gives a table that keeps the bits whose vector has an odd inner product with v.  The vectors of
up to r differing bits leave some v without any of them, so in that table the pair has the same key: no
pair is missed, whatever the data.  There are 2^(r+1) - 1 tables, each of about half the bits.

Texts with one fingerprint are one node from the start, so copies never meet in a bucket.  Within a bucket
components are grown one member at a time, against the members not reached yet, and written as links to
the component's smallest; no bucket writes more links than it has members.  A bucket holds distinct
fingerprints only, 8 bytes each.  Components over all buckets come from hooking to the
smallest neighbour and contracting, on stored tables.

Null text counts as empty: no shingles, fingerprint zero, linked like any other.  Repeated rows and ties
share a component; an empty table gives an empty result; other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, map_batches, release, stored
from .substring_dedup import rolled, word_hashes

BITS, SEED = 64, 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """A-Z in lower case, words between ASCII white space, shingles joined by a space; 0 without a word."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    size = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(size[:-1] + 1)])
    ends = starts + size
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    begin, past = starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist()
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(begin), 65536):
        some = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[at : at + 65536], past[at : at + 65536], strict=True)], ">u8")
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(begin)).tobytes(), "big")


def fingerprints(df: DataFrame, *, shingle: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id and bits, the fingerprint as a signed 64-bit integer."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = np.array([fingerprint(x.as_py(), shingle) for x in batch.column(1)], np.uint64).view(np.int64)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(got)], ["doc_id", "bits"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, bits bigint", rows)


def covering_masks(radius: int) -> list[int]:
    """One mask for each non-zero vector v: bits whose vector (dealt evenly over all non-zero ones) is odd on v."""
    n = 2 ** (radius + 1) - 1
    return [sum(1 << bit for bit in range(BITS) if ((bit % n + 1) & v).bit_count() % 2) for v in range(1, n + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def links_within(fps: np.ndarray, radius: int) -> list[np.ndarray]:
    """(smallest, member) links that join each component of one bucket; fps are distinct."""
    found, rest = [], np.sort(fps)
    while len(rest) > 1:
        first, rest = rest[0], rest[1:]
        wave, reached = [first], []
        while wave and len(rest):
            x = wave.pop()
            near = np.bitwise_count(rest ^ x) <= radius
            if near.any():
                new = rest[near]
                rest = rest[~near]
                reached.append(new)
                wave += new.tolist() if len(new) > 1 else [new[0]]
        if reached:
            members = np.concatenate(reached)
            found.append(np.stack([np.full(len(members), first, np.uint64), members], axis=1))
    return found


def _bucket_links(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, held_fp = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def links(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            cuts = np.flatnonzero(np.diff(key)) + 1
            starts = np.concatenate([[0], cuts])
            sizes = np.diff(np.concatenate([starts, [len(key)]]))
            out = []
            for lag in range(1, 8):  # small buckets all at once
                near = np.flatnonzero((key[lag:] == key[:-lag]) & (np.bitwise_count(fp[lag:] ^ fp[:-lag]) <= radius)) if len(key) > lag else np.zeros(0, np.int64)
                near = near[(sizes <= 8)[np.searchsorted(starts, near, "right") - 1]] if len(near) else near
                if len(near):
                    out.append(np.stack([fp[near], fp[near + lag]], axis=1))
            for k in np.flatnonzero(sizes > 8):
                out += links_within(fp[starts[k] : starts[k] + sizes[k]], radius)
            pairs = np.unique(np.concatenate(out), axis=0).view(np.int64) if out else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

        for batch in batches:
            key = np.concatenate([held_key, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([held_fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if not len(key):
                continue
            whole = np.searchsorted(key, key[-1])  # the last bucket may go on in the next batch
            held_key, held_fp = key[whole:], fp[whole:]
            if whole:
                yield links(key[:whole], fp[:whole])
        if len(held_key):
            yield links(held_key, held_fp)

    return run


def links(nodes: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column bits) with the same components as all pairs within the radius."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("bits").bitwiseAND(F.lit(_signed(m)))) for k, m in enumerate(covering_masks(radius))])
    dealt = nodes.select(F.explode(keys).alias("key"), "bits").repartition("key").sortWithinPartitions("key", "bits")
    return dealt.mapInArrow(_bucket_links(radius), "a bigint, b bigint").distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node that it reaches) of every node that has a link (a, b).

    Each round hooks every node of the graph to its smallest neighbour, follows hooks to their roots, and
    contracts the links to what their ends are hooked to; it stops when no link is left.  Links of a dense
    group meet after one contraction, so later rounds hold few.  Smallest neighbours are combined before
    the shuffle, and both sides of the joins are stored tables, so that a node with very many links is split.
    """
    open_ = stored(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "links")
    label = None
    while True:
        ends = open_.select(F.col("a").alias("x"), F.col("a").alias("y")).unionByName(open_.select(F.col("b").alias("x"), F.col("a").alias("y")))
        hook = stored(ends.groupBy("x").agg(F.min("y").alias("y")), "hooks")
        further = hook.select(F.col("x").alias("y"), F.col("y").alias("z"))
        to = stored(hook.join(further, "y").select("x", F.col("z").alias("to")), "targets")
        while True:  # each time twice as far
            root = to.select(F.col("x").alias("to"), F.col("to").alias("z"))
            further = stored(to.join(root, "to").select("x", F.col("z").alias("to"), (F.col("z") != F.col("to")).alias("moved")), "targets")
            to = further.select("x", "to")
            if further.where("moved").isEmpty():
                break
        if label is None:
            label = to.select(F.col("x").alias("node"), F.col("to").alias("label"))
        else:
            label = stored(label.join(to, label.label == to.x, "left").select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = open_.join(to.select(F.col("x").alias("a"), F.col("to").alias("p")), "a").select("b", "p")
        both = left.join(to.select(F.col("x").alias("b"), F.col("to").alias("q")), "b").where("p <> q")
        open_ = stored(both.select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")).distinct(), "links")
        if not open_.limit(1).count():
            break
    return label


def classes(df: DataFrame, *, shingle: int = 4, radius: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id, the smallest doc_id that links reach."""
    docs = stored(fingerprints(df, shingle=shingle, text=text, key=key), "fingerprints")
    nodes = stored(docs.groupBy("bits").agg(F.min("doc_id").alias("least")), "nodes")
    label = components(links(nodes, radius))
    rooted = stored(nodes.join(label, nodes.bits == label.node, "left").select("bits", "least", F.coalesce("label", "bits").alias("root")), "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of = rooted.select("bits", "root").join(stored(least, "least"), "root").select(F.col("bits").alias("node"), "component_id")
    return docs.join(of, docs.bits == of.node).select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


# Near copies by similarity: rare shingles give the candidates, all shingles the verdict.

#: One text in so many gives the common shingles; at most so many of them are told to the workers.
SAMPLED, COMMON = 16, 200_000
#: Bits of a sketch, in which each shingle flips one.
SKETCH = 2048
#: Buckets up to this size are paired at once.
SMALL = 8


def shingle_set(words: list[bytes], shingle: int) -> np.ndarray:
    """Sorted distinct hashes of the shingles; the whole sequence if there are fewer words."""
    return np.unique(rolled(word_hashes(words), min(shingle, len(words)))) if words else np.zeros(0, np.uint64)


def common_shingles(df: DataFrame, *, shingle: int = 5, text: str = "text", key: str = "doc_id") -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of shingles that stand in four texts or more of a sample; they only set an order."""

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingle_set((x.as_py() or "").encode().lower().split(), shingle) for x in batch.column(0)]
        seen, n = np.unique(np.concatenate(sets), return_counts=True) if sets else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        return pa.RecordBatch.from_arrays([pa.array(seen.view(np.int64)), pa.array(n.astype(np.int64))], ["h", "n"])

    some = df.where(F.pmod(F.xxhash64(df[key]), F.lit(SAMPLED)) == 0).select(df[text])
    counts = map_batches(some, "h bigint, n bigint", rows).groupBy("h").agg(F.sum("n").alias("n")).where("n >= 4")
    got = counts.orderBy(F.desc("n"), "h").limit(COMMON).collect()
    seen, n = np.array([r.h for r in got], np.int64).view(np.uint64), np.array([r.n for r in got], np.int64)
    order = np.argsort(seen)
    return seen[order], n[order]


def rare_first(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A set's hashes (sorted) in an order that is the same for all texts: common ones last, then by hash."""
    seen, n = common
    if not len(seen) or not len(shingles):
        return shingles
    at = np.minimum(np.searchsorted(seen, shingles), len(seen) - 1)
    return shingles[np.argsort(np.where(seen[at] == shingles, n[at], 0), kind="stable")]


def prefix_length(n: int, similarity: float) -> int:
    """Sets of at least the similarity share a member among so many first ones of each, in any common order."""
    return n - int(np.ceil(similarity * n - 1e-9)) + 1 if n else 0


def sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles in each of SKETCH places: two sketches differ in no more bits than the sets in members."""
    return np.packbits((np.bincount((shingles >> np.uint64(40)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1).astype(np.uint8)).tobytes()


def word_fingerprint(words: list[bytes]) -> int:
    """64 bits, each the majority over the distinct words; like texts have like ones."""
    bits = np.unpackbits(word_hashes(sorted(set(words))).astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(bits)).view(">i8")[0])


def signatures(df: DataFrame, *, shingle: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, digest (of the words in order), shingles (how many distinct), bits, sketch and first, the rarest shingles."""
    common = common_shingles(df, shingle=shingle, text=text, key=key)

    def rows(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        digests, counts, bits, sketches, first = [], [], [], [], []
        for x in batch.column(1):
            words = (x.as_py() or "").encode().lower().split()
            own = shingle_set(words, shingle)
            digests.append(xxhash.xxh3_128_digest(b" ".join(words)))
            counts.append(len(own))
            bits.append(word_fingerprint(words) if words else 0)
            sketches.append(sketch(own))
            first.append(rare_first(own, common)[: prefix_length(len(own), similarity)].view(np.int64))
        columns = [pa.array(digests, pa.binary()), pa.array(counts, pa.int32()), pa.array(bits, pa.int64()), pa.array(sketches, pa.binary()), pa.array(first, pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "digest", "shingles", "bits", "sketch", "first"])

    kind = df.schema[key].dataType.simpleString()
    return map_batches(df.select(df[key].alias("doc_id"), df[text]), f"doc_id {kind}, digest binary, shingles int, bits bigint, sketch binary, first array<bigint>", rows)


def _allowed(n: np.ndarray, place: np.ndarray, m, at, similarity: float) -> np.ndarray:
    """Whether sets of n and m members, whose first common one stands at these places, can be similar enough."""
    fits = np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9
    return fits & (1 + np.minimum(n - place, m - at) - 1 >= similarity / (1 + similarity) * (n + m) - 1e-9)


def _near(p: np.ndarray, q: np.ndarray, of: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets of together ``of`` members may be similar enough by their sketches, which never rule out a pair that is."""
    return np.bitwise_count(p ^ q).sum(axis=1, dtype=np.int64) <= (1 - similarity) / (1 + similarity) * of + 1e-9


def _met(p: np.ndarray, q: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether rows i and j name an earlier bucket (p the last one, q the one before; 0: none) that holds both."""
    return (p[i] != 0) & ((p[i] == p[j]) | (p[i] == q[j])) | (q[i] != 0) & ((q[i] == p[j]) | (q[i] == q[j]))


def _by_bucket(work, schema: pa.Schema):
    """Runs work on whole buckets of rows that are sorted by their first column."""

    def arrow(columns) -> pa.RecordBatch:
        made = [pa.array(np.ma.getdata(x), f.type, mask=np.ma.getmaskarray(x) if np.ma.isMaskedArray(x) else None) for x, f in zip(columns, schema, strict=True)]
        return pa.RecordBatch.from_arrays(made, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            new = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(batch.num_columns)]
            rows = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            if not len(rows[0]):
                continue
            whole = np.searchsorted(rows[0], rows[0][-1])  # the last bucket may go on in the next batch
            held = [x[whole:] for x in rows]
            if whole:
                yield arrow(work(*[x[:whole] for x in rows]))
        if held is not None and len(held[0]):
            yield arrow(work(*held))

    return run


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("more", pa.bool_())])
#: Texts of a bucket that one task holds against the bucket; larger buckets are searched in so many parts.
BLOCK = 2_000


def _distinct_pairs(doc: np.ndarray, at: np.ndarray) -> np.ndarray:
    both = np.sort(np.stack([doc[at[:, 0]], doc[at[:, 1]]], axis=1), axis=1)
    return np.unique(both[both[:, 0] < both[:, 1]], axis=0)


def _sizes(key: np.ndarray) -> np.ndarray:
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(key)) + 1, [len(key)]])
    return np.repeat(np.diff(cuts), np.diff(cuts))


def _small_pairs(similarity: float):
    """All pairs of buckets of up to SMALL texts, but for those that an earlier one has."""

    def work(key, doc, n, place, p, q):
        found = [np.zeros((0, 2), np.int64)]
        for lag in range(1, SMALL):
            if len(key) > lag:
                at = np.flatnonzero(key[lag:] == key[:-lag])
                found.append(np.stack([at, at + lag], axis=1))
        at = np.concatenate(found)
        i, j = at[:, 0], at[:, 1]
        pairs = _distinct_pairs(doc, at[_allowed(n[i], place[i], n[j], place[j], similarity) & ~_met(p, q, i, j)])
        return pairs[:, 0], pairs[:, 1], np.zeros(len(pairs), bool)

    return _by_bucket(work, PAIRS)


def _more_pairs(similarity: float, width: int):
    """For each text that its part of the bucket is to look at, the ``width`` likest members of other components.

    Members are passed over if an earlier bucket holds both texts or if the sketches rule the similarity out, so the rows
    made are the pairs that may be similar, about once each, and not the pairs of unlike texts in all buckets that they
    share.  A row (doc, doc, true) says that a text has further members to try.
    """

    def work(bucket, doc, n, place, bits, p, q, label, seeks, sketch):
        size, bits = _sizes(bucket), np.ascontiguousarray(bits).view(np.uint64)
        sketches = np.frombuffer(b"".join(sketch), np.uint64).reshape(-1, SKETCH // 64)
        found, rest = [np.zeros((0, 2), np.int64)], []
        for a in np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1]).tolist():
            own = slice(a, a + int(size[a]))
            for i in (a + np.flatnonzero(seeks[own])).tolist():
                other = a + np.flatnonzero((label[own] != label[i]) & _allowed(n[own], place[own], n[i], place[i], similarity))
                other = other[~_met(p, q, i, other)]
                other = other[_near(sketches[other], sketches[i], n[other].astype(np.int64) + n[i], similarity)]
                if len(other) > width:
                    rest.append(doc[i])
                    other = other[np.argsort(np.bitwise_count(bits[other] ^ bits[i]), kind="stable")[:width]]
                found.append(np.stack([np.full(len(other), i), other], axis=1))
        both = _distinct_pairs(doc, np.concatenate(found))
        rest = np.unique(np.array(rest, np.int64))
        return np.concatenate([both[:, 0], rest]), np.concatenate([both[:, 1], rest]), np.arange(len(both) + len(rest)) >= len(both)

    return _by_bucket(work, PAIRS)


def _searched(large: DataFrame, label: DataFrame) -> DataFrame:
    """Rows of the buckets with several components, once for each part of the bucket, with what the part is to seek.

    A part seeks for its share of the texts outside the bucket's largest component, so a bucket of any size is worked
    on by as many tasks as it has parts; a row of it is a few numbers.
    """
    own = large.join(label, large.doc == label.node, "left").select(*large.columns, F.coalesce("label", "doc").alias("label"))
    groups = own.groupBy("key", "label").agg(F.count("*").alias("_m"))
    open_ = groups.groupBy("key").agg(F.max(F.struct("_m", "label")).alias("_top"), F.sum("_m").alias("_size"), F.count("*").alias("_groups")).where("_groups > 1")
    outside = (F.col("_size") - F.col("_top._m")).alias("_outside")
    rows = own.join(open_.select("key", F.col("_top.label").alias("_label"), outside), "key")
    parts = F.ceil(F.col("_outside") / BLOCK).cast("int")
    dealt = rows.withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).withColumn("_of", F.pmod(F.xxhash64("doc"), parts))
    seeks = (F.col("label") != F.col("_label")) & (F.col("_of") == F.col("part"))
    return dealt.select(F.xxhash64("key", "part").alias("bucket"), *[c for c in large.columns if c != "key"], "label", seeks.alias("seeks"))


def _verified(pairs: DataFrame, docs: DataFrame, df: DataFrame, shingle: int, similarity: float, text: str, key: str) -> DataFrame:
    """The pairs whose sets have the similarity: sketches tell most of the others, whole texts the rest."""
    own = docs.select("doc_id", "sketch", "shingles")

    def close(batch: pa.RecordBatch) -> pa.RecordBatch:
        p, q = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(-1, SKETCH // 64) for k in (2, 3))
        return batch.select(["a", "b"]).filter(pa.array(_near(p, q, batch.column(4).to_numpy(zero_copy_only=False), similarity)))

    sides = pairs.join(own.select(F.col("doc_id").alias("a"), F.col("sketch").alias("p"), F.col("shingles").alias("n")), "a")
    sides = sides.join(own.select(F.col("doc_id").alias("b"), F.col("sketch").alias("q"), F.col("shingles").alias("m")), "b")
    near = stored(map_batches(sides.select("a", "b", "p", "q", (F.col("n") + F.col("m")).cast("bigint").alias("of")), "a bigint, b bigint", close), "close")
    texts = df.select(df[key].alias("_key"), df[text].alias("_text"))
    left = near.join(texts, near.a == texts["_key"]).select("a", "b", F.col("_text").alias("left"))
    both = left.join(texts, left.b == texts["_key"]).select("a", "b", "left", F.col("_text").alias("right"))

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3), strict=True):
            p, q = (shingle_set((t.as_py() or "").encode().lower().split(), shingle) for t in (x, y))
            common = len(np.intersect1d(p, q, assume_unique=True))
            keep.append(common >= similarity * (len(p) + len(q) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return stored(map_batches(both, "a bigint, b bigint", verify).distinct(), "similar")


def _buckets(members: DataFrame) -> DataFrame:
    """Members (key, doc, text, n, place, bits) of buckets with two texts or more, with _m (how many), _c (the first) and p and q.

    text is a hash that tells a doc's texts apart.  Of buckets that hold the same texts only the first in the common order
    stays: it is before the others in each of these texts, so no pair has its first common shingle in the others.  p and q
    are the last two buckets (small or large ones, like its own) that hold the text before this one, or 0; a pair that has
    one of them in common met there, and in its first common bucket it has none.

    Most keys have one text only.  Bare counts tell these, so that what is grouped is the members of shared keys.
    """
    several = stored(members.groupBy("key").count().where("count > 1").select("key"), "shared-keys")
    release(members.sparkSession)
    members = stored(members.join(several, "key", "left_semi"), "shared-members")
    release(members.sparkSession)
    texts = [F.bit_xor(F.col("text")).alias("_x"), F.bit_xor(F.xxhash64("text")).alias("_y")]
    sizes = members.groupBy("key").agg(F.count("*").alias("_m"), F.min(F.struct("doc", "text", "n", "place")).alias("_c"), *texts)
    first = sizes.groupBy("_m", "_x", "_y").agg(F.min(F.struct(F.col("_c.place").alias("place"), "key", "_c")).alias("_f"))
    shared = members.join(first.select(F.col("_f.key").alias("key"), "_m", F.col("_f._c").alias("_c")), "key")
    before = Window.partitionBy("doc", "text", F.col("_m") > SMALL).orderBy("place")
    return shared.select("*", *[F.coalesce(F.lag("key", k).over(before), F.lit(0)).alias(c) for k, c in ((1, "p"), (2, "q"))])


def similar_links(df: DataFrame, *, shingle: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(a, b): links between documents whose sets of shingles have a Jaccard similarity of at least ``similarity``.

    key is a bigint.  Sets that similar share one of their first members in any order common to all texts, so
    every such pair meets in a bucket, and the first one in which it meets is enough.  Pairs are dropped by the sets' sizes, places and sketches only where
    these rule the similarity out; all others are verified on whole texts.  Texts of equal words are one node.
    In buckets of over SMALL texts each is first held against the bucket's first text, by a join that adaptive
    execution can split.  What is not yet joined goes on to further rounds: texts outside their bucket's largest
    component are held against ever more members of other components, the likest first, until no pair of different
    components that the sketches leave is untried.  Large buckets are searched in parts, by as many tasks.
    """
    docs = stored(signatures(df, shingle=shingle, similarity=similarity, text=text, key=key), "signatures")
    nodes = docs.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("least"))
    nodes = stored(nodes, "texts")
    equal = stored(docs.where("doc_id IS NOT NULL").join(nodes, "digest").where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b")), "equal")
    chosen = stored(docs.join(nodes.select(F.col("least").alias("doc_id"), "digest"), ["doc_id", "digest"]).dropDuplicates(["doc_id", "digest"]), "chosen")
    discard(docs, nodes)
    release(df.sparkSession)
    chosen = chosen.withColumn("text", F.xxhash64("doc_id", "digest"))
    members = chosen.select(F.posexplode("first").alias("place", "key"), F.col("doc_id").alias("doc"), "text", F.col("shingles").alias("n"), "bits").select("key", "doc", "text", "n", "place", "bits")
    shared = stored(_buckets(members), "members")
    release(df.sparkSession)
    small = shared.where(F.col("_m") <= SMALL).select("key", "doc", "n", "place", "p", "q").repartition("key").sortWithinPartitions("key", "doc")
    large = shared.where(F.col("_m") > SMALL)
    fits = F.least("n", "_c.n") >= similarity * F.greatest("n", "_c.n") - 1e-9
    reach = F.least(F.col("n") - F.col("place"), F.col("_c.n") - F.col("_c.place")) >= similarity / (1 + similarity) * (F.col("n") + F.col("_c.n")) - 1e-9
    with_centre = large.where((F.col("doc") > F.col("_c.doc")) & fits & reach).select(F.col("_c.doc").alias("a"), F.col("doc").alias("b"))
    tried = stored(small.mapInArrow(_small_pairs(similarity), "a bigint, b bigint, more boolean").select("a", "b").unionByName(with_centre).distinct(), "pairs")
    near = _verified(tried, chosen, df, shingle, similarity, text, key)
    sketches = chosen.select(F.col("doc_id").alias("doc"), "text", "sketch")
    width = SMALL
    while True:
        live = _searched(large.select("key", "doc", "text", "n", "place", "bits", "p", "q"), components(near)).join(sketches, ["doc", "text"])
        live = live.select("bucket", "doc", "n", "place", "bits", "p", "q", "label", "seeks", "sketch").repartition("bucket").sortWithinPartitions("bucket", "doc")
        found = stored(live.mapInArrow(_more_pairs(similarity, width), "a bigint, b bigint, more boolean").distinct(), "pairs")
        new = stored(found.where("NOT more").select("a", "b").join(tried, ["a", "b"], "left_anti"), "untried")
        more, untried = not found.where("more").isEmpty(), not new.isEmpty()
        if untried:
            near = stored(near.unionByName(_verified(new, chosen, df, shingle, similarity, text, key)), "similar")
            tried = stored(tried.unionByName(new), "tried")
        if not more:
            return near.unionByName(equal).distinct()
        width *= SMALL


def keep_one(df: DataFrame, *, shingle: int = 5, similarity: float = 0.8, text: str = "text", key: str = "doc_id") -> DataFrame:
    """df without the rows that have a smaller doc_id in their group; all columns stay, and rows without a key.

    A group is joined by links of both kinds: fingerprints of 4-word shingles at most 4 bits apart, and sets
    of ``shingle``-word shingles of at least the given similarity.
    """
    docs = stored(fingerprints(df, text=text, key=key).where("doc_id IS NOT NULL"), "fingerprints")
    nodes = stored(docs.groupBy("bits").agg(F.min("doc_id").alias("least")), "nodes")
    equal = docs.join(nodes, "bits").where("doc_id <> least").select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    found = stored(links(nodes, 4), "bit-links")
    named = found.join(nodes.select(F.col("bits").alias("a"), F.col("least").alias("x")), "a").join(nodes.select(F.col("bits").alias("b"), F.col("least").alias("y")), "b")
    alike = equal.unionByName(named.select(F.col("x").alias("a"), F.col("y").alias("b")))
    label = components(alike.unionByName(similar_links(df, shingle=shingle, similarity=similarity, text=text, key=key)))
    gone = label.where("node <> label").select(F.col("node").alias("_gone"))
    return df.join(gone, df[key] == gone["_gone"], "left_anti")
