"""Keyed lookups: aliases, catalog members, resume work lists and content-hash caches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sets import conflicts, keep_first

#: Aliases in the order in which they count.
ALIASES = ("uid", "source_uid", "path", "name", "stem")
VIDEO_SUFFIX = r"(?i)\.(?:mp4|mov|mkv|webm|avi|m4v)$"


def aliases(rows: DataFrame, *, uid: str = "uid", source_uid: str = "source_uid", path: str = "path", is_video: Column | None = None) -> DataFrame:
    """A row for each alias of each row: alias and its priority; file names only stand for videos."""
    video = F.coalesce(F.col(path).rlike(VIDEO_SUFFIX), F.lit(False)) if is_video is None else is_video
    name = F.element_at(F.split(path, "/"), -1)
    stem = F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
    pairs = F.array(*[F.struct(F.lit(k).alias("priority"), c.alias("alias")) for k, c in enumerate((F.col(uid), F.col(source_uid), F.when(video, F.col(path)), F.when(video, name), F.when(video, stem)))])
    return rows.select("*", F.explode(F.filter(pairs, lambda p: F.coalesce(p["alias"], F.lit("")) != "")).alias("_p")).select(*rows.columns, "_p.priority", "_p.alias")


def alias_conflicts(index: DataFrame, value: str) -> DataFrame:
    return conflicts(index, "alias", value)


def multi_key_lookup(probes: DataFrame, index: DataFrame, value: str, *, uid: str = "uid") -> DataFrame:
    """For each probe the value under its first alias, by priority, that the index has (null if none).

    probes and index come from ``aliases``; of equal aliases in the index the smallest value counts.
    """
    table = index.groupBy("alias").agg(F.min(value).alias(value))
    hits = probes.join(table, "alias", "left")
    best = hits.groupBy(uid).agg(F.min(F.when(F.col(value).isNotNull(), F.struct("priority", value))).alias("_b"))
    return best.select(uid, F.col(f"_b.{value}").alias(value), F.col("_b.priority").alias("priority"))


def with_members(samples: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Catalog rows with the byte range of their member, and the rows whose member is missing."""
    of = members.select("shard", "member", F.col("data_offset").alias("offset"), "length")
    joined = samples.join(of, ["shard", "member"], "left")
    return joined.where(F.col("offset").isNotNull()), joined.where(F.col("offset").isNull())


def needed(rows: DataFrame, tasks: list[str], completed: DataFrame, *, uid: str = "uid") -> DataFrame:
    """(uid, task) still to do.  The tasks are a literal array, so no join makes the pairs; the anti-join precedes all work."""
    pairs = rows.select(uid, F.explode(F.array(*[F.lit(t) for t in tasks])).alias("task"))
    return pairs.join(completed.select(uid, "task").distinct(), [uid, "task"], "left_anti")


def by_hash_name(rows: DataFrame, listing: DataFrame, *, uid: str = "uid", path: str = "path", size: str = "size") -> DataFrame:
    """uids whose object, named by the SHA-256 of the uid, is in a listing and not empty."""
    names = listing.where(F.col(size) > 0).select(F.regexp_extract(path, r"([0-9a-f]{64})\.[^/]*$", 1).alias("_h")).where("_h <> ''").distinct()
    return rows.withColumn("_h", F.sha2(uid, 256)).join(names, "_h", "left_semi").drop("_h")


def parse_listing(lines: DataFrame, *, value: str = "value") -> DataFrame:
    """Pipe-separated listings: path in the first field, size in the fifth; '0.00 B' and short lines give no row."""
    f = F.split(F.col(value), r"\|")
    trimmed = lambda k: F.trim(F.get(f, F.lit(k)))
    return lines.where(F.size(f) >= 5).select(trimmed(0).alias("path"), F.when(trimmed(4) == "0.00 B", 0).otherwise(1).alias("size"))


def uncached(requests: DataFrame, cache: DataFrame, *, key: str = "request_hash") -> DataFrame:
    """Requests without a recorded answer."""
    return requests.join(cache.select(key).distinct(), key, "left_anti")


def best_cached(answers: DataFrame, *, key: str, variants: tuple[str, ...] = ("recovered-v2", "recovered-v1", "base"), valid: str = "valid") -> DataFrame:
    """Of the valid answers under a key, that of the first variant."""
    rank = F.array_position(F.array(*[F.lit(v) for v in variants]), F.col("variant"))
    return keep_first(answers.where(F.col(valid)).withColumn("_rank", rank), key, "_rank").drop("_rank")


def media_reference(records: DataFrame, overrides: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Path, offset and length of a record's media: an override, else the item, else the locator; error if none."""
    joined = records.join(overrides.select(uid, F.col("path").alias("_path")), uid, "left")
    path = F.coalesce("_path", "item_path", "locator_path")
    own = F.col("_path").isNull()
    return joined.withColumn("media_path", path).withColumn("media_offset", F.when(own, F.col("locator_offset"))).withColumn("media_length", F.when(own, F.col("locator_length"))).withColumn("error", F.when(path.isNull(), "media_missing")).drop("_path")
