"""Set algebra, de-duplication, eligibility and balanced partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from annolith.functions.scalar import hash_slot, primary_uid


def keep_first(rows: DataFrame, key: str | list[str], *order: str | Column) -> DataFrame:
    """The first row of each key in a stated order.

    A minimum of structs, combined before the shuffle: a key with a third of all rows is no window in one task.
    """
    keys = [key] if isinstance(key, str) else key
    marks = [F.col(o) if isinstance(o, str) else o for o in order]
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*rows.columns), F.struct(*marks)).alias("_first"))
    return first.select("_first.*")


def repeated(rows: DataFrame, key: str | list[str], *order: str | Column) -> DataFrame:
    """What ``keep_first`` leaves out, for the quarantine beside the accepted rows."""
    keys = [key] if isinstance(key, str) else key
    by = W.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_n", F.row_number().over(by)).where("_n > 1").drop("_n")


def conflicts(rows: DataFrame, key: str | list[str], value: str) -> DataFrame:
    """Keys with more than one value: an assertion that must give no rows."""
    keys = [key] if isinstance(key, str) else key
    return rows.groupBy(*keys).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.count("*").alias("n")).where("_lo <> _hi").select(*keys, "n")


def conflict_checked_union(*frames: DataFrame, key: str, value: str) -> tuple[DataFrame, DataFrame]:
    """Earlier frames win; the second frame of the result lists keys on which they disagree."""
    tagged = [f.withColumn("_source", F.lit(k)) for k, f in enumerate(frames)]
    every = tagged[0]
    for f in tagged[1:]:
        every = every.unionByName(f)
    return keep_first(every, key, "_source", value).drop("_source"), conflicts(every, key, value)


def ordered_distinct(rows: DataFrame, key: str, pos: str) -> DataFrame:
    return rows.groupBy(key).agg(F.min(pos).alias(pos))


def eligible(master: DataFrame, available: DataFrame, completed: DataFrame, *excluded: DataFrame, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """First mentions in the master list whose episode is available and that are neither completed nor excluded."""
    out = ordered_distinct(master, uid, pos).withColumn("_primary", primary_uid(uid))
    out = out.join(available.select(F.col(uid).alias("_primary")).distinct(), "_primary", "left_semi").drop("_primary")
    for gone in (completed, *excluded):
        out = out.join(gone.select(uid).distinct(), uid, "left_anti")
    return out


def slotted(rows: DataFrame, slots: int, *, cap: int | None = None, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Stable hash slots; with cap only the first of each slot."""
    out = rows.withColumn("slot", hash_slot(uid, slots))
    if cap is None:
        return out
    return out.withColumn("_n", F.row_number().over(W.partitionBy("slot").orderBy(pos))).where(F.col("_n") <= cap).drop("_n")


def even_pick(rows: DataFrame, count: int, *, order: str) -> DataFrame:
    """count rows evenly spaced over an ordered list of idle slots (a short list: one row for each worker)."""
    total = rows.agg(F.count("*").alias("_n"))
    placed = numbered(rows, [order]).withColumnRenamed("row_index", "_i").join(F.broadcast(total))  # one row
    take = F.least(F.lit(count), F.col("_n"))
    # Row i is chosen if it is k * n div take for some k.
    k = F.ceil(F.col("_i") * take / F.col("_n"))
    return placed.where((take > 0) & (k < take) & (F.floor(k * F.col("_n") / take) == F.col("_i"))).drop("_i", "_n")


def top_donor(remaining: DataFrame, *, least: int = 1, slot: str = "slot", count: str = "remaining") -> DataFrame:
    """The slot with most left to do; of equals the highest slot; no row below the floor."""
    return remaining.where(F.col(count) >= least).agg(F.max(F.struct(count, slot)).alias("_m")).where("_m IS NOT NULL").select(f"_m.{slot}", f"_m.{count}")


def remaining(assigned: DataFrame, available: DataFrame, completed: DataFrame, *, uid: str = "uid", slot: str = "slot") -> DataFrame:
    """For each slot how many assigned uids are available and not completed."""
    left = assigned.join(available.select(uid).distinct(), uid, "left_semi").join(completed.select(uid).distinct(), uid, "left_anti")
    return left.groupBy(slot).agg(F.count("*").alias("remaining"))


def _turns(load: list[int], size: int, n: int) -> list[tuple[int, list[int]]]:
    """(rows, owners in turn) by which n rows of one size go to the least loaded owner; load is brought up to date.

    Owner k stands at (load, k) and moves on by ``size`` with each row.  The owners less than one size ahead of the
    first take turns, round after round, until the next owner's place is reached; then that one joins them.
    """
    runs, every = [], range(len(load))
    while n:
        order = sorted(every, key=lambda k: (load[k], k))
        first = order[0]
        group = [k for k in order if size <= 0 and k == first or size > 0 and (load[k], k) < (load[first] + size, first)]
        after = order[len(group)] if size > 0 and len(group) < len(order) else None
        rounds = n if after is None else min(-(-(load[after] - load[k]) // size) + ((load[after] - load[k]) % size == 0 and k < after) for k in group)
        count = min(n, rounds * len(group))
        for k, owner in enumerate(group):
            load[owner] += size * (count // len(group) + (k < count % len(group)))
        runs.append((count, group))
        n -= count
    return runs


def longest_first_split(rows: DataFrame, owners: list[str], *, uid: str = "uid", size: str = "size") -> DataFrame:
    """Longest first to the least loaded owner, ties by the owners' order: sequential by nature.  Sizes are whole numbers.

    The driver sees the histogram of sizes and makes, for each size, a few runs of owners that take turns (at most
    about twice as many as there are owners, however many rows the size has); the rows find their place by number.
    """
    load, dealt = [0] * len(owners), []
    for value, n in rows.groupBy(size).count().orderBy(F.desc(size)).toLocalIterator():
        at = 0
        for count, group in _turns(load, value, n):
            dealt.append((value, at, at + count, group))
            at += count
    schema = rows.select(size).schema.add("_from", T.LongType()).add("_to", T.LongType()).add("_owners", T.ArrayType(T.IntegerType()))
    runs = rows.sparkSession.createDataFrame(dealt, schema).groupBy(size).agg(F.collect_list(F.struct("_from", "_to", "_owners")).alias("_runs"))
    placed = rows.withColumn("_n", F.row_number().over(W.partitionBy(size).orderBy(uid)) - 1).join(runs, size)
    run = F.get(F.filter("_runs", lambda r: (F.col("_n") >= r["_from"]) & (F.col("_n") < r["_to"])), F.lit(0))
    turn = ((F.col("_n") - F.col("_run._from")) % F.size("_run._owners")).cast("int")
    names = F.array(*[F.lit(o) for o in owners])
    return placed.withColumn("_run", run).withColumn("owner", F.get(names, F.get("_run._owners", turn))).drop("_n", "_runs", "_run")


def cover_errors(parts: DataFrame, source: DataFrame, *, uid: str = "uid") -> DataFrame:
    """uids that partitions share, lack or add; no rows prove a disjoint and complete cover."""
    counts = parts.groupBy(uid).agg(F.count("*").alias("_n"))
    both = counts.join(source.select(uid).distinct().withColumn("_in", F.lit(True)), uid, "full_outer")
    error = F.when(F.col("_n").isNull(), "missing").when(F.col("_in").isNull(), "not_in_source").when(F.col("_n") > 1, "overlap")
    return both.withColumn("error", error).where("error IS NOT NULL").select(uid, "error")


def coverage_errors(actual: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that are missing, unexpected or repeated."""
    counts = actual.groupBy(*keys).agg(F.count("*").alias("_n"))
    both = counts.join(expected.select(*keys).distinct().withColumn("_in", F.lit(True)), keys, "full_outer")
    error = F.when(F.col("_n").isNull(), "missing").when(F.col("_in").isNull(), "unexpected").when(F.col("_n") > 1, "duplicate")
    return both.withColumn("error", error).where("error IS NOT NULL").select(*keys, "error")


def ledger_union(*ledgers: DataFrame, uid: str = "uid") -> DataFrame:
    """What any ledger, or an earlier union, has ever held: a node that answers nothing loses nothing."""
    out = ledgers[0].select(uid)
    for more in ledgers[1:]:
        out = out.unionByName(more.select(uid))
    return out.distinct()


def numbered(rows: DataFrame, order: list[str], *, per_range: int = 100_000, ranges: int = 256) -> DataFrame:
    """Adds row_index, the place of each row in the stated order, without one task that sorts everything.

    The order's range is cut at keys of a seeded sample (a few thousand rows reach the driver).  The cuts are
    literals from then on, so a range holds the same rows whenever and wherever it is computed again; sizes
    of the ranges give the offsets, and a row number within each range the rest.
    """
    n = rows.count()
    parts = max(1, min(ranges, -(-n // per_range)))
    keys = []
    if parts > 1:
        sample = rows.select(*order).sample(min(1.0, 50 * parts / n), seed=7).orderBy(*order).collect()
        keys = [sample[len(sample) * k // parts] for k in range(1, parts)] if sample else []
    here = F.struct(*order)
    types = [rows.schema[c].dataType for c in order]
    cuts = [F.struct(*[F.lit(k[c]).cast(t).alias(c) for c, t in zip(order, types, strict=True)]) for k in keys]
    part = F.size(F.filter(F.array(*cuts), lambda k: k <= here)) if cuts else F.lit(0)
    ranged = rows.withColumn("_range", part)
    sizes = dict(ranged.groupBy("_range").count().collect())  # a row for each range
    start, at = {}, 0
    for k in sorted(sizes):
        start[k], at = at, at + sizes[k]
    offset = F.create_map(*[F.lit(x) for pair in start.items() for x in pair])[F.col("_range")] if start else F.lit(0)
    place = F.row_number().over(W.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn("row_index", offset.cast("bigint") + place).drop("_range")


def labelled_batches(rows: DataFrame, size: int, *, order: str | list[str], prefix: str = "manifest-", limit: int | None = None) -> DataFrame:
    """Fixed-size batches in a stated order, numbered before any later filter: adds row_index and batch."""
    out = numbered(rows, [order] if isinstance(order, str) else order)
    out = out.withColumn("_batch", F.floor(F.col("row_index") / size)).withColumn("batch", F.concat(F.lit(prefix), F.lpad(F.col("_batch").cast("string"), 6, "0")))
    if limit is not None:
        out = out.where(F.col("_batch") < limit)
    return out.drop("_batch")


def first_per_batch(rows: DataFrame, n: int, *, batch: str = "batch", order: str = "row_index") -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(batch).orderBy(order))).where(F.col("_n") <= n).drop("_n")


def failed_first(rows: DataFrame, failed: DataFrame, *, uid: str = "uid", pos: str = "pos") -> DataFrame:
    """Stable: rows that failed before come first.  Adds row_index, the place in that order, and sorts by it.

    The place comes from the keys alone; a number given to sorted rows as they pass changes with their partitions.
    """
    flagged = rows.join(failed.select(uid).distinct().withColumn("_failed", F.lit(1)), uid, "left")
    placed = numbered(flagged.withColumn("_failed", -F.coalesce("_failed", F.lit(0))), ["_failed", pos])
    return placed.orderBy("row_index").drop("_failed")
