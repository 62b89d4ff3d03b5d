"""Counters over time: trailing rates with resets, sticky bursts, recent medians, phase totals."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def trailing_rate(samples: DataFrame, *, key: str = "task", time: str = "t", value: str = "units", pid: str | None = "pid", seconds: float = 900, least: float = 60) -> DataFrame:
    """Adds rate_per_minute over the trailing window; a new pid or a falling counter starts afresh.

    Null with less than ``least`` seconds of data.
    """
    by = W.partitionBy(key).orderBy(time)
    reset = F.col(value) < F.lag(value).over(by)
    if pid:
        reset = reset | (F.col(pid) != F.lag(pid).over(by))
    runs = samples.withColumn("_run", F.sum(F.when(reset, 1).otherwise(0)).over(by))
    frame = W.partitionBy(key, "_run").orderBy(time).rangeBetween(-seconds, 0)
    span = F.col(time) - F.first(time).over(frame)
    rate = (F.col(value) - F.first(value).over(frame)) * 60 / span
    return runs.withColumn("window_seconds", span).withColumn("rate_per_minute", F.when(span >= least, rate)).drop("_run")


def events_per_minute(events: DataFrame, *, key: str, time: str, seconds: float = 900) -> DataFrame:
    frame = W.partitionBy(key).orderBy(time).rangeBetween(-seconds, 0)
    return events.withColumn("in_window", F.count("*").over(frame)).withColumn("per_minute", F.col("in_window") * 60 / seconds)


def sticky_burst(failures: DataFrame, threshold: int, *, key: str, time: str, seconds: float) -> DataFrame:
    """Adds in_window and conservative, which stays true once ``threshold`` failures fell into one window."""
    by = W.partitionBy(key).orderBy(time)
    rows = failures.withColumn("in_window", F.count("*").over(by.rangeBetween(-seconds, 0)))
    return rows.withColumn("conservative", F.max(F.col("in_window") >= threshold).over(by.rangeBetween(W.unboundedPreceding, 0)))


def recent_median(durations: DataFrame, *, key: str, order: str, value: str, last: int = 2048) -> DataFrame:
    n = F.row_number().over(W.partitionBy(key).orderBy(F.desc(order)))
    return durations.withColumn("_n", n).where(F.col("_n") <= last).groupBy(key).agg(F.percentile(value, 0.5).alias("median"), F.count("*").alias("n"))


def phase_totals(samples: DataFrame) -> DataFrame:
    return samples.groupBy("phase").agg(F.sum("active").alias("active"), F.sum("completed").alias("completed"), F.sum("seconds_sum").alias("seconds_sum"), F.max("seconds_max").alias("seconds_max"))


def every_nth_row(rows: DataFrame, n: int, *, key: str, order: str) -> DataFrame:
    """Each n-th row of a key: where progress is reported."""
    return rows.withColumn("_n", F.row_number().over(W.partitionBy(key).orderBy(order))).where(F.col("_n") % n == 0).drop("_n")


def finished_attempts(attempts: DataFrame, finished: DataFrame, available: DataFrame, completed: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Counts one more attempt for each uid of a finished lease that is available and not completed."""
    from annolith.functions.scalar import primary_uid

    left = finished.withColumn("_primary", primary_uid(uid)).join(available.select(F.col(uid).alias("_primary")).distinct(), "_primary", "left_semi").drop("_primary")
    more = left.join(completed.select(uid).distinct(), uid, "left_anti").select(uid, F.lit(1).cast("bigint").alias("attempts"))
    return attempts.select(uid, F.col("attempts").cast("bigint")).unionByName(more).groupBy(uid).agg(F.sum("attempts").alias("attempts"))
