"""Following live producers with Structured Streaming: ledgers, sealed waits, deferred work, sticky state."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def ledger_stream(spark: SparkSession, path: str, *, files_per_trigger: int | None = None) -> DataFrame:
    """New lines of a folder of ledgers, each file once; offsets live in the query's checkpoint."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path).select(F.trim("value").alias("uid")).where("uid <> ''")


def distinct_ledger(stream: DataFrame) -> DataFrame:
    """Each uid once over the whole life of the query: a monotonic set."""
    return stream.dropDuplicates(["uid"])


def follow_ledger(spark: SparkSession, path: str, target: str, checkpoint: str) -> None:
    """Appends uids not seen before to a table and stops when what is there has been read."""
    query = distinct_ledger(ledger_stream(spark, path)).writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def waits(wanted: DataFrame, available: DataFrame, sealed: bool, *, uid: str = "uid") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(ready, waiting, missing for good): absent upstream rows wait until the producer is sealed."""
    there = available.select(uid).distinct()
    ready, absent = wanted.join(there, uid, "left_semi"), wanted.join(there, uid, "left_anti")
    none = absent.where(F.lit(False))
    return (ready, none, absent) if sealed else (ready, absent, none)


def ready_and_deferred(jobs: DataFrame, upstream: DataFrame, *, key: str = "uid") -> DataFrame:
    """Adds ready: whether a job's upstream result is there; the rest is carried to the next trigger."""
    return jobs.join(upstream.select(key).distinct().withColumn("_there", F.lit(True)), key, "left").withColumn("ready", F.col("_there").isNotNull()).drop("_there")


def late_publications(accepted: DataFrame, jobs: DataFrame, published: DataFrame, *, key: str = "path") -> DataFrame:
    """Accepted records that are neither queued nor published."""
    return accepted.join(jobs.select(key), key, "left_anti").join(published.select(key), key, "left_anti")


def outbox_drained(status: DataFrame, now: float, *, max_age: float) -> DataFrame:
    """Adds drained: a fresh heartbeat of a live process with all counters at zero."""
    counters = ("pending_files", "pending_bytes", "accepted", "inflight")
    zero = F.lit(True)
    for c in counters:
        zero = zero & (F.coalesce(F.col(c), F.lit(1)) == 0)
    return status.withColumn("drained", F.coalesce((F.lit(now) - F.col("updated_at") <= max_age) & F.col("alive") & zero, F.lit(False)))


def sticky_backoff(failures: DataFrame, threshold: int, seconds: float) -> DataFrame:
    """A stream of (key, t) failures to (key, t, conservative), which never turns false again.

    The state of a key is the times inside the last window, ``threshold`` of them at most, and the mode.
    """

    def step(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        times, mode = state.get if state.exists else ([], False)
        times, out = list(times), []
        for t in sorted(t for pdf in parts for t in pdf["t"].tolist()):
            times = [x for x in times if x >= t - seconds][-(threshold - 1) :] + [t] if threshold > 1 else [t]
            mode = bool(mode or len(times) >= threshold)
            out.append((key[0], t, mode))
        state.update((times, mode))
        yield pd.DataFrame(out, columns=["key", "t", "conservative"])

    return failures.groupBy("key").applyInPandasWithState(step, "key string, t double, conservative boolean", "times array<double>, mode boolean", "append", GroupStateTimeout.NoTimeout)


def attempt_counts(finished: DataFrame, *, limit: int) -> DataFrame:
    """A stream of finished attempts (uid) to running counts, and whether the uid is out of attempts."""
    return finished.groupBy("uid").agg(F.count("*").alias("attempts")).withColumn("quarantined", F.col("attempts") >= limit)


def windowed_counts(events: DataFrame, *, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """An extension beyond the batch operators: events by type in tumbling windows, late ones dropped by watermark."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))
