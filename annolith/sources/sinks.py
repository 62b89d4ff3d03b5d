"""Sinks: shards of JSON lines, keyed unit tables, quarantine and uid lists, all through Spark's own commit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from annolith.operators.sets import conflicts, keep_first


def new_records(records: DataFrame, published: DataFrame | None, *, keys: tuple[str, ...] = ("task", "uid")) -> DataFrame:
    """One record for each key that is not published yet: a second run writes nothing."""
    first = keep_first(records, list(keys), F.sha2(F.to_json(F.struct(*records.columns)), 256))
    return first if published is None else first.join(published.select(*keys).distinct(), list(keys), "left_anti")


def write_shards(records: DataFrame, path: str, *, by: tuple[str, ...] = ("task", "source_key", "batch"), order: str = "uid") -> None:
    """Appends JSON lines below task, source and batch.  Salted by uid, so that one huge batch is no single task."""
    salted = records.withColumn("_salt", F.pmod(F.xxhash64(order), F.lit(16)))
    salted.repartition(*by, "_salt").drop("_salt").sortWithinPartitions(*by, order).write.mode("append").partitionBy(*by).json(path)


def merge_units(*units: DataFrame, key: tuple[str, ...] = ("identity_sha256", "uid", "task", "unit_key")) -> tuple[DataFrame, DataFrame]:
    """(units, conflicts): equal values under a key are one unit; different ones are a conflict to stop at."""
    every = units[0]
    for more in units[1:]:
        every = every.unionByName(more)
    hashed = every.withColumn("_sha", F.sha2("value", 256))
    return hashed.dropDuplicates([*key, "_sha"]).drop("_sha"), conflicts(hashed, list(key), "_sha")


def identity(*parts: str) -> Column:
    """Digest of what a unit depends on."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)


def cleared(units: DataFrame, published: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Units still needed: those whose final record is not durable yet."""
    return units.join(published.select(uid, "task").distinct(), [uid, "task"], "left_anti")


def write_uid_list(uids: DataFrame, invalid: DataFrame, path: str, *, uid: str = "uid") -> int:
    """Sorted distinct uids as text, only if nothing is invalid.  Returns how many rows were invalid."""
    bad = invalid.count()
    if not bad:
        uids.select(F.col(uid).alias("value")).distinct().orderBy("value").write.mode("overwrite").text(path)
    return bad


def copy_missing(wanted: DataFrame, there: DataFrame, target: DataFrame, *, keys: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """(rows to copy, counts): units of the wanted uids that the target lacks; nothing is overwritten."""
    mine = there.join(wanted.select("uid").distinct(), "uid", "left_semi")
    fresh = mine.join(target.select(*keys).distinct(), list(keys), "left_anti")
    return fresh, fresh.agg(F.count("*").alias("units"), F.count_distinct("uid").alias("uids"), F.coalesce(F.sum(F.octet_length("value")), F.lit(0)).alias("bytes"))
