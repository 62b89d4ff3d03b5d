"""What leaves the engine besides records: content-named packs, an outbox with its ledger, rejections, error rows, figures.

Each is a table and a rule about it; Spark's own commit makes a write whole.  A second run of any of them adds nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.operators.sets import conflicts, keep_first


def packs(lines: DataFrame, *, by: tuple[str, ...] = ("task", "source_key", "batch"), order: str = "uid", value: str = "value", size: int = 10_000) -> DataFrame:
    """Adds pack, the digest of what stands in a pack: its lines in order of ``order``.

    A group is dealt by hash into packs of about ``size`` lines, so no group, however large, is one task's work; what is
    gathered for a name is the digests of one pack.  Equal groups have equal packs wherever they are made.
    """
    counts = lines.groupBy(*by).agg(F.count("*").alias("_n"))
    dealt = lines.join(counts, list(by)).withColumn("_k", F.pmod(F.xxhash64(order), F.ceil(F.col("_n") / size)))
    marks = F.array_sort(F.collect_list(F.struct(order, F.sha2(value, 256).alias("d"))))
    names = dealt.groupBy(*by, "_k").agg(F.sha2(F.array_join(F.transform(marks, lambda m: m["d"]), "\n"), 256).alias("pack"))
    return dealt.join(names, [*by, "_k"]).drop("_n", "_k")


def write_packs(packed: DataFrame, path: str, *, by: tuple[str, ...] = ("task", "source_key", "batch"), order: str = "uid") -> None:
    """One folder for each pack, its lines sorted; packs that are there already are not written again by the caller's anti-join."""
    packed.repartition(*by, "pack").sortWithinPartitions(*by, "pack", order).write.mode("append").partitionBy(*by, "pack").json(path)


def expanded_packs(packed: DataFrame, wanted: DataFrame, *, uid: str = "uid") -> tuple[DataFrame, DataFrame]:
    """(one record for each wanted uid, wanted uids that no pack holds); of several the one in the smallest pack."""
    mine = packed.join(wanted.select(uid).distinct(), uid, "left_semi")
    return keep_first(mine, uid, "pack"), wanted.select(uid).distinct().join(packed.select(uid).distinct(), uid, "left_anti")


def enqueue(outbox: DataFrame, rows: DataFrame, *, path: str = "path", value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(rows to append, conflicts): a path enters once; the same path with another content is an error to stop at."""
    marked = rows.select(path, value, F.sha2(value, 256).alias("sha256"), F.octet_length(value).alias("bytes"))
    held = outbox.select(path, "sha256")
    fresh = keep_first(marked, path, "sha256").join(held.select(path).distinct(), path, "left_anti")
    return fresh, conflicts(marked.select(path, "sha256").unionByName(held), path, "sha256")


def admitted(queue: DataFrame, *, files: int, size: int, lane: str = "lane", order: str = "path") -> DataFrame:
    """Adds admitted: the first rows of each lane until its files or its bytes are used up (back-pressure)."""
    by = W.partitionBy(lane).orderBy(order).rowsBetween(W.unboundedPreceding, W.currentRow)
    return queue.withColumn("admitted", (F.count("*").over(by) <= files) & (F.sum("bytes").over(by) <= size))


def pending(outbox: DataFrame, ledger: DataFrame, *, path: str = "path") -> DataFrame:
    """What was accepted and is not in the ledger of published paths."""
    return outbox.join(ledger.select(path).distinct(), path, "left_anti")


def totals(queue: DataFrame) -> DataFrame:
    """Files and bytes of a queue; zero for an empty one."""
    return queue.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).cast("bigint").alias("bytes"))


def publish_stream(outbox: DataFrame, target: str, ledger: str, checkpoint: str):
    """Follows a stream of outbox rows: each batch goes to the target, then its paths to the ledger.

    A batch that runs again after a crash writes what its ledger lacks; both are plain appends below the checkpoint's
    exactly-once offsets.  Returns the query, which ends when what is there has been published.
    """

    def publish(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        try:
            done = spark.read.parquet(ledger).select("path")
        except Exception as e:  # the first batch finds no ledger
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            done = batch.select("path").limit(0)
        fresh = batch.dropDuplicates(["path"]).join(done, "path", "left_anti")
        fresh.write.mode("append").parquet(target)
        fresh.select("path", "sha256", F.lit(number).alias("batch")).write.mode("append").parquet(ledger)

    return outbox.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: The schema and status of a persisted rejection, and the tasks that may have one.
REJECTION_SCHEMA, REJECTED, REJECTABLE = "provider-content-rejection/v1", "provider_rejected", ("ecot", "grd")


def rejection_identity(uid: Column, task: Column, provider: Column, model: Column, contract: Column) -> Column:
    """Digest of what a rejection belongs to: the JSON of its identity with sorted keys and a blank after marks."""
    quote = lambda c: F.to_json(F.array(c)).substr(F.lit(2), F.length(F.to_json(F.array(c))) - 2)
    parts = [F.concat(F.lit(f'"{k}": '), quote(c)) for k, c in sorted({"contract_id": contract, "model": model, "provider": provider, "task": task, "uid": uid}.items())]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), 256)


def rejections(rows: DataFrame) -> DataFrame:
    """Rows to keep (identity, task, reason, schema_version, status) of answers that a provider refused; one for each identity."""
    ident = rejection_identity(F.col("uid"), F.col("task"), F.col("provider"), F.col("model"), F.col("contract_id"))
    made = rows.where(F.col("task").isin(*REJECTABLE)).select(ident.alias("identity"), "task", "reason", F.lit(REJECTION_SCHEMA).alias("schema_version"), F.lit(REJECTED).alias("status"))
    return keep_first(made, "identity", "reason")


def not_rejected(requests: DataFrame, saved: DataFrame) -> DataFrame:
    """Requests whose identity no saved rejection has: refused content is not asked for again."""
    ident = rejection_identity(F.col("uid"), F.col("task"), F.col("provider"), F.col("model"), F.col("contract_id"))
    return requests.withColumn("_identity", ident).join(saved.select(F.col("identity").alias("_identity")).distinct(), "_identity", "left_anti").drop("_identity")


def error_rows(results: DataFrame) -> DataFrame:
    """One row for each record with errors: its locator, the tasks in order, and the first error's text."""
    bad = results.where("error IS NOT NULL").groupBy("source_record_uid", "input_locator")
    return bad.agg(F.array_sort(F.collect_set("task")).alias("tasks"), F.min_by("error", "task").alias("error"))


def shard_digest(lines: DataFrame, *, shard: str = "shard", line: str = "line", value: str = "value") -> DataFrame:
    """(shard, lines, digest): whether a shard is the one that was read; sums of hashes, so no shard is gathered."""
    h = F.xxhash64(line, value)
    return lines.groupBy(shard).agg(F.count("*").alias("lines"), F.bit_xor(h).alias("digest"))


def audited_rewrite(lines: DataFrame, reviewed: DataFrame, before: DataFrame, *, shard: str = "shard", line: str = "line") -> tuple[DataFrame, DataFrame]:
    """(lines of the shards that may be replaced, refused shards with the reason).

    A shard is replaced as a whole: only if every line has its review and the shard still is what ``before`` says.
    """
    now = shard_digest(lines, shard=shard, line=line).join(before.select(shard, F.col("lines").alias("_l"), F.col("digest").alias("_d")), shard, "left")
    count = reviewed.groupBy(shard).agg(F.count_distinct(line).alias("_r"))
    state = now.join(count, shard, "left").withColumn("reason", F.when(~(F.col("lines").eqNullSafe(F.col("_l")) & F.col("digest").eqNullSafe(F.col("_d"))), "input_changed").when(F.coalesce("_r", F.lit(0)) < F.col("lines"), "unreviewed_lines"))
    return reviewed.join(state.where("reason IS NULL").select(shard), shard, "left_semi"), state.where("reason IS NOT NULL").select(shard, "reason")


def observed(rows: DataFrame, name: str, **figures: Column) -> tuple[DataFrame, Observation]:
    """The rows, and figures about them that are there once an action has run: no second pass over the data."""
    seen = Observation(name)
    return rows.observe(seen, *[c.alias(k) for k, c in figures.items()]), seen


def batch_totals(status: DataFrame, *, run: str = "run", order: str = "batch") -> DataFrame:
    """Running totals after each batch of a run: batches, errors, and records written by task (a map)."""
    by = W.partitionBy(run).orderBy(order)
    per = status.groupBy(run, order, "task").agg(F.sum("written").alias("written"), F.sum("errors").alias("errors"))
    tasks = W.partitionBy(run, "task").orderBy(order)
    rows = per.withColumn("written", F.sum("written").over(tasks))
    ends = rows.groupBy(run, order).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("task", "written")))).alias("written"), F.sum("errors").alias("_e"))
    return ends.select(run, order, F.row_number().over(by).cast("bigint").alias("batches"), F.sum("_e").over(by).alias("errors"), "written")
