"""Scans: manifests, catalogs, directories, tar shards, JSON lines, uid lists, logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions.scalar import blank_to_null, primary_view, shard_location, task_name
from annolith.operators.lookup import VIDEO_SUFFIX, with_members
from annolith.operators.sets import labelled_batches

MANIFEST = (
    "struct<uid:string,record_uid:string,video_path:string,task_description:string,task_name:string,source_key:string,actor:string,dataset_family:string,"
    "original_source_key:string,split:string,physical_source_locator:string,duration_seconds:double,clip:struct<duration_sec:double>>"
)
ITEM = "struct<media_id:string,type:string,mime_type:string,member:string,relative_path:string,container_format:string,view:string,sha256:string>"
SOURCE = (
    f"struct<schema_version:string,uid:string,source_key:string,split:string,task_name:string,dialogue:struct<turns:array<struct<role:string,content:string>>>,"
    f"media:struct<layout:string,items:array<{ITEM}>>,provenance:struct<source_record_uid:string,source_locator:string>>"
)
#: The marker file's schema id of a physical dataset, and the name's ending of one beside its release.
RELEASE_SCHEMA, PHYSICAL_SUFFIX = "cosmos3_video_physical_webdataset_v1", "-physical-webdataset"


def json_lines(spark: SparkSession, path: str, schema: str, *, recursive: bool = False) -> DataFrame:
    """file, line (its place in the file), raw, record (parsed by an explicit schema) and corrupt.

    Whole lines of text: nothing is inferred, so sparse fields stay.  Blank lines go.  line numbers order a
    file's rows; splits of a large file keep their order, as ids grow along a file.
    """
    rows = spark.read.option("recursiveFileLookup", str(recursive).lower()).text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    lines = rows.withColumn("line", F.row_number().over(W.partitionBy("file").orderBy("_block", "_id"))).where(F.trim("raw") != "")
    return parsed_lines(lines, schema)


def parsed_lines(lines: DataFrame, schema: str) -> DataFrame:
    """Lines (file, line, raw) with record, parsed by an explicit schema, and corrupt for what is no JSON object."""
    parsed = lines.withColumn("record", F.from_json("raw", schema))
    return parsed.select("file", "line", "raw", "record", (F.try_parse_json("raw").isNull() | ~F.ltrim("raw").startswith("{")).alias("corrupt"))


def complete_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, raw, partial_bytes): lines up to each file's last newline; what follows is only counted.

    Files are read as split text: a file whose lines, each with a newline, are one byte longer than the file ends in a
    partial line.  A file that holds nothing else gives one row with neither line nor raw.
    """
    rows = spark.read.option("recursiveFileLookup", "true").option("lineSep", "\n").text(path)
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("_size"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"), F.col("value").alias("raw"))
    whole = rows.groupBy("file").agg(F.sum(F.octet_length("raw") + 1).alias("_sum"), F.max(F.struct("_block", "_id", F.octet_length("raw").alias("n"))).alias("_last"))
    both = rows.join(whole, "file").withColumn("_open", F.col("_sum") == F.col("_size") + 1)
    last = F.col("_open") & (F.struct("_block", "_id") == F.struct("_last._block", "_last._id"))
    numbered = both.withColumn("line", F.row_number().over(W.partitionBy("file").orderBy("_block", "_id")))
    kept = numbered.where(~last | (F.col("line") == 1))
    return kept.select("file", F.when(~last, F.col("line")).alias("line"), F.when(~last, F.rtrim(F.regexp_replace("raw", "\r$", ""))).alias("raw"), F.when(F.col("_open"), F.col("_last.n")).otherwise(0).alias("partial_bytes"))


def repaired_lines(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(whole lines, files with an unterminated last line and its bytes): the tail goes to quarantine, nothing is cut in place."""
    rows = complete_lines(spark, path)
    return rows.where("line IS NOT NULL"), rows.where("partial_bytes > 0").select("file", "partial_bytes").distinct()


def manifest(spark: SparkSession, path: str, *, sources: list[str] | None = None) -> DataFrame:
    """Source records of a video manifest; see ``manifest_records``."""
    return manifest_records(json_lines(spark, path, MANIFEST), sources=sources)


def manifest_records(lines: DataFrame, *, sources: list[str] | None = None) -> DataFrame:
    """Source records of a manifest's parsed lines, in their order.

    The source filter compares the raw key, so a row without one never meets its own default.  error is
    'invalid_json', 'uid_missing' or 'duplicate_uid'; a caller that wants failures to be fatal counts them.
    """
    rows = lines.select("file", "line", "raw", "corrupt", "record.*")
    if sources:
        rows = rows.where(F.col("corrupt") | F.col("source_key").isin(*sources))
    uid = F.trim(F.coalesce(F.nullif("uid", F.lit("")), "record_uid"))
    rows = rows.withColumn("_uid", uid)
    first = rows.where("NOT corrupt").groupBy("_uid").agg(F.min(F.struct("file", "line")).alias("_first"))
    rows = rows.join(first, "_uid", "left")
    folder = F.regexp_replace("file", "[^/]*$", "")
    video = F.when(F.col("video_path").startswith("/"), F.col("video_path")).otherwise(F.concat(folder, F.col("video_path")))
    duration = F.coalesce(F.nullif("duration_seconds", F.lit(0.0)), F.col("clip.duration_sec"))
    error = F.when(F.col("corrupt"), "invalid_json").when(F.coalesce("_uid", F.lit("")) == "", "uid_missing").when(F.struct("file", "line") != F.col("_first"), "duplicate_uid")
    return rows.select(
        F.col("_uid").alias("uid"), F.coalesce(F.nullif("source_key", F.lit("")), F.lit("video_manifest")).alias("source_key"), *[blank_to_null(c).alias(c) for c in ("actor", "dataset_family", "original_source_key")],
        F.coalesce(F.nullif("split", F.lit("")), F.lit("train")).alias("split"), F.coalesce(task_name("task_description", "task_name"), F.lit("")).alias("task_name"), video.alias("path"), F.element_at(F.split(video, "/"), -1).alias("member"),
        "physical_source_locator", F.when(duration > 0, duration).alias("duration"), "file", "line", error.alias("error"),
    )


def batches(rows: DataFrame, size: int, *, order: tuple[str, ...] = ("file", "line"), limit: int | None = None) -> DataFrame:
    """Adds batch, row_index and batch_source_key (its first row's)."""
    out = labelled_batches(rows, size, order=list(order), limit=limit)
    first = out.groupBy("batch").agg(F.min_by("source_key", "row_index").alias("batch_source_key"))
    return out.join(first, "batch")


def catalog(spark: SparkSession, root: str, *, sources: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(source records, rows whose member is missing) of a physical dataset's samples and members catalogs.

    Pairing by row group becomes an equi-join on shard and member; the source filter reaches the scan.
    """
    folder = f"{root}/catalog" if _there(spark, f"{root}/catalog") else root
    return catalog_records(spark.read.parquet(f"{folder}/samples.parquet"), spark.read.parquet(f"{folder}/members.parquet"), root, sources=sources)


def catalog_records(samples: DataFrame, members: DataFrame, root: str, *, sources: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The same of the two catalogs as tables."""
    if sources:
        samples = samples.where(F.col("source_key").isin(*sources))
    views = F.from_json("video_members_json", "map<string,string>")
    rows = samples.withColumn("_views", views).withColumn("view", primary_view("_views")).withColumn("member", F.element_at("_views", F.col("view"))).drop("_views")
    found, missing = with_members(rows, members)
    text = members.select("shard", F.col("member").alias("_text"), F.col("data_offset").alias("text_offset"), F.col("length").alias("text_length"))
    found = found.withColumn("_text", F.concat("key", F.lit(".txt"))).join(text, ["shard", "_text"], "left")
    records = found.select(
        F.col("record_uid").alias("uid"), "source_key", F.lit("train").alias("split"), F.coalesce(task_name("task_description", "task_name"), F.lit("")).alias("task_name"), "view", "member", "key", "shard",
        F.concat(F.lit(root.rstrip("/") + "/"), shard_location("shard")).alias("path"), "offset", "length", "text_offset", "text_length", F.when(F.col("target_duration_ns") > 0, F.col("target_duration_ns") / 1e9).alias("duration"),
        F.when(shard_location("shard").isNull(), "shard_name_invalid").alias("error"),
    )
    return records, missing


def videos(spark: SparkSession, path: str, *, limit: int | None = None) -> DataFrame:
    """Videos of a folder tree in order of path; uid is the digest of the bytes, which stay in the scan."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(F.col("path").rlike(VIDEO_SUFFIX))
    rows = files.select(F.concat(F.lit("direct-video:"), F.sha2("content", 256)).alias("uid"), "path", F.element_at(F.split("path", "/"), -1).alias("member"), F.col("length"))
    return rows if limit is None else rows.orderBy("path").limit(limit)


def uid_list(spark: SparkSession, path: str) -> DataFrame:
    """uid and pos of the lines that are not blank."""
    rows = spark.read.text(path).select(F.trim("value").alias("uid"), F.monotonically_increasing_id().alias("pos"))
    return rows.where("uid <> ''")


def temporal_index(index: DataFrame, temporal: DataFrame, *, sources: list[str] | None = None) -> DataFrame:
    """Tars of an index with rows to do."""
    out = index.join(temporal.select("tar", "target_rows"), "tar").where("target_rows > 0")
    return out.where(F.col("source_key").isin(*sources)) if sources else out


def ranged_bytes(rows: DataFrame, read, *, path: str = "path", offset: str = "offset", length: str = "length", key: str = "uid", attempts: int = 3, backoff: float = 0.5) -> DataFrame:
    """(key, content, attempts, error) by ``read(path, offset, length)``, called on the executors; offset and length may be null (the whole object).

    A failed or short read is tried again after a wait that doubles.  Payloads go straight to the next step of the same
    task and are never shuffled by this function.
    """
    import time

    import pandas as pd

    def one(p, o, n):
        error = None
        for turn in range(attempts):
            if turn:
                time.sleep(backoff * 2 ** (turn - 1))
            try:
                got = read(p, None if pd.isna(o) else int(o), None if pd.isna(n) else int(n))
            except Exception as e:  # the store's own failures are data
                error = type(e).__name__
                continue
            if got and (pd.isna(n) or len(got) == int(n)):
                return got, turn + 1, None
            error = "short_read" if got is not None else "not_found"
        return None, attempts, error

    def run(parts):
        for pdf in parts:
            got = [one(p, o, n) for p, o, n in zip(pdf["path"], pdf["offset"], pdf["length"], strict=True)]
            yield pd.DataFrame({"key": pdf["key"], "content": [g[0] for g in got], "attempts": [g[1] for g in got], "error": [g[2] for g in got]})

    chosen = rows.select(F.col(key).cast("string").alias("key"), F.col(path).alias("path"), F.col(offset).alias("offset"), F.col(length).alias("length"))
    return chosen.mapInPandas(run, "key string, content binary, attempts int, error string")


def objects(rows: DataFrame, read, **options) -> DataFrame:
    """Whole objects by path, each read once however many rows name it; an empty object is an error."""
    whole = rows.select(F.col("path").alias("uid"), "path").distinct().select("uid", "path", F.lit(None).cast("bigint").alias("offset"), F.lit(None).cast("bigint").alias("length"))
    return ranged_bytes(whole, read, **options).withColumnRenamed("key", "path")


def gathered_media(items: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Readable items (pos, mime_type, content) of each record in order; error where none of them can be read."""
    good = F.col("content").isNotNull()
    rows = items.groupBy(uid).agg(F.array_sort(F.collect_list(F.when(good, F.struct("pos", "mime_type", "content")))).alias("media"), F.count("*").alias("items"))
    return rows.withColumn("error", F.when(F.size("media") == 0, "no_readable_media"))


def _open_file(path: str):
    """A seekable reader of a path on any file system that Arrow knows."""
    from pyarrow import fs

    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def tar_records(spark: SparkSession, path: str, *, kinds: tuple[str, ...] = ("video", "frame"), open_file=_open_file) -> DataFrame:
    """Records of WebDataset tars: tar, record (JSON), members (name, offset, length) listed by it, in order.

    A listing names the tars; each is read by one task from header to header, so that its media are skipped and a tar of
    any size takes the memory of one record.  ``open_file`` reads a path on the executors.
    """
    import json
    import tarfile

    import pandas as pd

    def records_of(tar: str):
        with open_file(tar) as stream, tarfile.open(fileobj=stream, mode="r:") as archive:
            open_, listed = None, set()
            for member in archive:
                if member.name.endswith(".json"):
                    if open_:
                        yield open_
                    raw = archive.extractfile(member).read().decode()
                    items = (json.loads(raw).get("media") or {}).get("items") or []
                    wanted = any(str(i.get("type") or "").lower() in kinds for i in items)
                    listed = {str(i["member"]) for i in items if i.get("member")}
                    open_ = (tar, raw, []) if wanted else None
                elif open_ is not None and member.name in listed:
                    open_[2].append({"member": member.name, "offset": member.offset_data, "length": member.size})
                archive.members = []  # tarfile would keep every header
            if open_:
                yield open_

    def run(parts):
        columns = ["tar", "record", "members"]
        for pdf in parts:
            for tar in pdf["path"]:
                rows = []
                for row in records_of(tar):
                    rows.append(row)
                    if len(rows) == 256:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
                yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.tar").load(path).select("path")
    return files.repartition("path").mapInPandas(run, "tar string, record string, members array<struct<member:string,offset:bigint,length:bigint>>")


def _there(spark: SparkSession, path: str, form: str = "binaryFile") -> bool:
    """Whether a path can be listed; only a missing path counts as an answer, other errors are raised."""
    from pyspark.errors import AnalysisException

    try:
        spark.read.format(form).load(path).select("path").limit(1).count()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise
    return True


def physical_root(spark: SparkSession, path: str) -> str | None:
    """The physical dataset at a path, or beside it: a marker file of the right schema, both catalogs and shards."""
    for root in (path.rstrip("/"), path.rstrip("/") + PHYSICAL_SUFFIX):
        parts = (f"{root}/RELEASE.json", f"{root}/catalog/samples.parquet", f"{root}/catalog/members.parquet", f"{root}/shards")
        if all(_there(spark, p) for p in parts):
            marker = spark.read.option("wholetext", "true").text(parts[0])
            if marker.where(F.get_json_object("value", "$.schema") == RELEASE_SCHEMA).limit(1).count():
                return root
    return None


def input_kind(spark: SparkSession, path: str) -> str:
    """'video', 'manifest', 'catalog' (a physical dataset), 'tar' (a folder with an index) or 'videos'; ValueError for anything else."""
    import re

    if re.search(VIDEO_SUFFIX, path) and _there(spark, path):
        return "video"
    if path.lower().endswith(".jsonl") and _there(spark, path):
        return "manifest"
    if not _there(spark, path):
        raise ValueError(f"unsupported_input:{path}")
    if physical_root(spark, path):
        return "catalog"
    return "tar" if _there(spark, f"{path.rstrip('/')}/TAR_INDEX.jsonl") else "videos"


def load(spark: SparkSession, path: str, kind: str | None = None, **options) -> DataFrame | tuple[DataFrame, DataFrame]:
    """The reader of a kind of input: 'manifest', 'catalog', 'video(s)', 'tar' or 'uids'; without a kind, by what the path holds."""
    readers = {"manifest": manifest, "catalog": catalog, "video": videos, "videos": videos, "tar": tar_records, "uids": uid_list}
    if kind is None:
        kind = input_kind(spark, path)
        path = physical_root(spark, path) if kind == "catalog" else path
    if kind not in readers:
        raise ValueError(f"no reader for {kind!r}")
    return readers[kind](spark, path, **options)


def payload_order(items: Column) -> Column:
    """Media items with their place, for a join with their bytes that keeps the order."""
    return F.transform(items, lambda x, k: F.struct(k.alias("pos"), x["member"].alias("member"), x["mime_type"].alias("mime_type")))
