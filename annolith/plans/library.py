"""Queries of the library's smaller operators: scans of records as text, tables of units, scalars, points, joins, figures.

Inputs are made of the star-schema tables row by row; every query reads its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions import pyfuncs, scalar
from annolith.operators import ecot, grids, inventory, lookup, points, provider, rates, records, reuse, sets, timeline
from annolith.operators import events as ev
from annolith.sources import outbox, readers, sinks
from annolith.streaming import follow

from .catalogue import USER_EVENTS, user_events
from .registry import query, table

big = lambda c: F.col(c).cast("bigint").alias(c)
text = lambda c: F.col(c).cast("string")
none = lambda: F.lit(None).cast("string")


# Scans


@query("""WITH c AS (SELECT c_custkey AS k, c_name, c_mktsegment, c_nationkey AS n FROM customer), v AS (SELECT *, CASE WHEN k % 10 = 3 THEN '' ELSE 'u' || (k % 900) END AS uid FROM c WHERE c_mktsegment <> 'MACHINERY' OR k % 4 = 1)
SELECT k AS line, nullif(trim(uid), '') AS uid, CASE WHEN k % 4 = 1 THEN 'video_manifest' ELSE c_mktsegment END AS source_key, CASE WHEN k % 3 = 0 THEN NULL ELSE 'a' || n END AS actor, CASE WHEN k % 5 = 0 THEN 'test' ELSE 'train' END AS split, CASE WHEN k % 2 = 0 THEN 'do it' ELSE c_name END AS task_name,
CASE WHEN k % 6 = 0 THEN '/abs/' ELSE 'dir/' END || k || '.mp4' AS path, CASE WHEN n = 0 THEN CAST(k AS DOUBLE) WHEN n > 0 THEN CAST(n AS DOUBLE) END AS duration,
CASE WHEN uid = '' THEN 'uid_missing' WHEN k <> min(k) OVER (PARTITION BY uid) THEN 'duplicate_uid' END AS error FROM v""")
def manifest_records(spark, sf_dir):
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    clip = F.struct(k.cast("double").alias("duration_sec"))
    row = F.struct(
        F.when(k % 10 == 3, "").otherwise(F.concat(F.lit("u"), k % 900)).alias("uid"), F.concat(F.when(k % 6 == 0, "/abs/").otherwise(""), k, F.lit(".mp4")).alias("video_path"), F.when(k % 2 == 0, " do  it ").alias("task_description"), F.col("c_name").alias("task_name"),
        F.when(k % 4 != 1, F.col("c_mktsegment")).alias("source_key"), F.when(k % 3 == 0, " ").otherwise(F.concat(F.lit("a"), "c_nationkey")).alias("actor"), F.when(k % 5 == 0, "test").alias("split"), F.col("c_nationkey").cast("double").alias("duration_seconds"), clip.alias("clip"),
    )
    kept = c.where("c_mktsegment <> 'MACHINERY' OR c_custkey % 4 = 1")
    lines = kept.select(F.lit("dir/m.jsonl").alias("file"), k.alias("line"), F.to_json(row).alias("raw"))
    out = readers.manifest_records(readers.parsed_lines(lines, readers.MANIFEST))
    return out.select("line", "uid", "source_key", "actor", "split", "task_name", "path", "duration", "error")


@query("""WITH p AS (SELECT p_partkey AS k, p_brand, p_name, p_size AS n FROM part), s AS (SELECT *, 'train-' || lpad(CAST(k % 500 AS VARCHAR), 6, '0') || '.tar' AS shard, CASE WHEN k % 3 = 0 THEN 'ego' WHEN k % 3 = 1 THEN 'head_left' ELSE 'aux' END AS view FROM p)
SELECT 'r' || k AS uid, p_brand AS source_key, p_name AS task_name, view, view || k || '.mp4' AS member, 'root/shards/' || printf('%02x', (k % 500) % 64) || '/' || shard AS path, k * 512 AS "offset", CAST(n + 1 AS BIGINT) AS length, CASE WHEN n % 2 = 0 THEN CAST(n AS BIGINT) END AS text_length, CASE WHEN n > 10 THEN n / 2 END AS duration FROM s WHERE k % 7 > 0""")
def catalog_records(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    shard = F.concat(F.lit("train-"), F.lpad((k % 500).cast("string"), 6, "0"), F.lit(".tar"))
    view = F.when(k % 3 == 0, "ego").when(k % 3 == 1, "head_left").otherwise("aux")
    member = F.concat(view, k.cast("string"), F.lit(".mp4"))
    views = F.to_json(F.map_concat(F.create_map(view, member), F.create_map(F.lit("zoom"), F.lit("other.mp4"))))
    samples = p.select(k.cast("string").alias("key"), F.concat(F.lit("r"), k).alias("record_uid"), F.col("p_brand").alias("source_key"), F.col("p_name").alias("task_name"), none().alias("task_description"), views.alias("video_members_json"), shard.alias("shard"), F.when(F.col("p_size") > 10, F.col("p_size").cast("bigint") * 500_000_000).otherwise(0).alias("target_duration_ns"))
    members = p.where(k % 7 > 0).select(shard.alias("shard"), member.alias("member"), (k * 512).alias("data_offset"), (F.col("p_size") + 1).cast("bigint").alias("length"))
    texts = p.where("p_size % 2 = 0").select(shard.alias("shard"), F.concat(k.cast("string"), F.lit(".txt")).alias("member"), k.alias("data_offset"), F.col("p_size").cast("bigint").alias("length"))
    found, _ = readers.catalog_records(samples, members.unionByName(texts), "root")
    return found.select("uid", "source_key", "task_name", "view", "member", "path", "offset", "length", "text_length", "duration")


@query("SELECT s_name AS tar, o.n AS target_rows FROM supplier JOIN (SELECT l_suppkey, count(*) FILTER (l_returnflag = 'R') AS n FROM lineitem GROUP BY 1) o ON l_suppkey = s_suppkey WHERE n > 0 AND s_nationkey IN (1, 3, 5, 7, 9)")
def temporal_index(spark, sf_dir):
    index = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("tar"), text("s_nationkey").alias("source_key"), "s_suppkey")
    rows = table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.count_if(F.col("l_returnflag") == "R").alias("target_rows"))
    temporal = rows.join(index, F.col("l_suppkey") == F.col("s_suppkey")).select("tar", "target_rows")
    return readers.temporal_index(index, temporal, sources=["1", "3", "5", "7", "9"]).select("tar", "target_rows")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 > 0 AND (c_custkey % 7 = 0 OR c_custkey % 5 > 0)")
def listed_objects(spark, sf_dir):
    """Objects named by the digest of their uid; empty ones and short lines do not count."""
    c, k = table(spark, sf_dir, "customer"), F.col("c_custkey")
    path = F.concat(F.lit("x/"), F.sha2(k.cast("string"), 256), F.lit(".jsonl"))
    lines = c.where(k % 3 > 0).select(F.when(k % 7 == 0, F.concat(path, F.lit("|a|b|c|1.00 KB|d"))).otherwise(F.concat(F.lit(" "), path, F.lit(" | a|b|c| "), F.when(k % 5 == 0, "0.00 B").otherwise("3 B"))).alias("value")).unionByName(c.where(k % 3 == 0).select(path.alias("value")))
    return lookup.by_hash_name(c.select(k.cast("string").alias("uid"), k), lookup.parse_listing(lines)).select("c_custkey")


@query("SELECT o_orderkey AS uid, CASE WHEN o_orderkey % 5 = 0 THEN 'new/' || o_orderkey WHEN o_orderkey % 3 = 0 THEN 'item/' || o_orderkey WHEN o_orderkey % 2 = 0 THEN 'loc' END AS media_path, CASE WHEN o_orderkey % 5 > 0 THEN o_orderkey * 2 END AS media_offset, CASE WHEN o_orderkey % 5 > 0 AND o_orderkey % 3 > 0 AND o_orderkey % 2 > 0 THEN 'media_missing' END AS error FROM orders")
def media_references(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select(k.alias("uid"), F.when(k % 3 == 0, F.concat(F.lit("item/"), k)).alias("item_path"), F.when(k % 2 == 0, "loc").alias("locator_path"), (k * 2).alias("locator_offset"), k.alias("locator_length"))
    overrides = o.where(k % 5 == 0).select(k.alias("uid"), F.concat(F.lit("new/"), k).alias("path"))
    return lookup.media_reference(rows, overrides).select("uid", "media_path", "media_offset", "error")


# Records that leave, units that stay


def _values(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    return o.select((k % 700).cast("string").alias("uid"), F.when(k % 2 == 0, "grd").otherwise("sta").alias("task"), F.concat(F.lit("v"), k % 1400).alias("value"), F.col("o_orderstatus").alias("source_key"), F.lit("b0").alias("batch"), k.alias("o"))


VALUES = "v AS (SELECT CAST(o_orderkey % 700 AS VARCHAR) AS uid, CASE WHEN o_orderkey % 2 = 0 THEN 'grd' ELSE 'sta' END AS task, 'v' || (o_orderkey % 1400) AS value, o_orderstatus AS source_key, o_orderkey AS o FROM orders)"


@query(f"WITH {VALUES} SELECT uid, task, count(*) AS n FROM (SELECT DISTINCT uid, task, 1 FROM v WHERE NOT (task = 'sta' AND CAST(uid AS INTEGER) < 300)) GROUP BY ALL")
def new_records(spark, sf_dir):
    v = _values(spark, sf_dir)
    published = v.where("task = 'sta' AND CAST(uid AS INT) < 300").select("task", "uid")
    return sinks.new_records(v.select("task", "uid", "value"), published).groupBy("uid", "task").agg(F.count("*").alias("n"))


@query(f"WITH {VALUES}, d AS (SELECT DISTINCT uid, task, value FROM v) SELECT 'units' AS figure, count(*) AS n FROM d UNION ALL SELECT 'conflicts', count(*) FROM (SELECT uid, task FROM d GROUP BY ALL HAVING count(*) > 1)")
def merged_units(spark, sf_dir):
    v = _values(spark, sf_dir).select(F.lit("i").alias("identity_sha256"), "uid", "task", F.lit("k").alias("unit_key"), "value")
    units, bad = sinks.merge_units(v.where("value < 'v5'"), v)
    return units.agg(F.count("*").alias("n")).select(F.lit("units").alias("figure"), "n").unionByName(bad.agg(F.count("*").alias("n")).select(F.lit("conflicts").alias("figure"), "n"))


@query(f"""WITH {VALUES} SELECT o, sha256('{{"uid":"' || uid || '","task":"' || task || '"}}') AS identity, task || '/' || substr(sha256(uid), 1, 2) || '/' || sha256(uid) || '.jsonl' AS path FROM v""")
def unit_identities(spark, sf_dir):
    return _values(spark, sf_dir).select("o", sinks.identity("uid", "task").alias("identity"), scalar.checkpoint_path("task", "uid").alias("path"))


@query(f"WITH {VALUES} SELECT uid, task, value FROM v WHERE NOT (source_key = 'F' AND task = 'grd') AND (uid, task) NOT IN (SELECT uid, task FROM v WHERE source_key = 'F' AND task = 'grd')")
def cleared_units(spark, sf_dir):
    v = _values(spark, sf_dir)
    return sinks.cleared(v.select("uid", "task", "value"), v.where("source_key = 'F' AND task = 'grd'"))


@query(f"WITH {VALUES}, w AS (SELECT * FROM v WHERE CAST(uid AS INTEGER) < 400), f AS (SELECT * FROM w WHERE (uid, task) NOT IN (SELECT uid, task FROM v WHERE source_key = 'O')) SELECT count(*) AS units, count(DISTINCT uid) AS uids, CAST(coalesce(sum(strlen(value)), 0) AS BIGINT) AS bytes FROM f")
def copied_units(spark, sf_dir):
    v = _values(spark, sf_dir).select("uid", "task", "value", "source_key")
    return sinks.copy_missing(v.where("CAST(uid AS INT) < 400").select("uid"), v, v.where("source_key = 'O'"), keys=("uid", "task"))[1]


@query(f"WITH {VALUES} SELECT task, source_key, sha256(string_agg(sha256(value), chr(10) ORDER BY uid, sha256(value))) AS pack, count(*) AS lines FROM v GROUP BY ALL")
def content_packs(spark, sf_dir):
    packed = outbox.packs(_values(spark, sf_dir).select("task", "source_key", "batch", "uid", "value"), size=1 << 40)
    return packed.groupBy("task", "source_key", "pack").agg(F.count("*").alias("lines"))


@query("WITH p AS (SELECT CAST(o_orderkey % 600 AS VARCHAR) AS uid, CAST(o_orderkey % 4 AS VARCHAR) AS pack, o_orderkey AS o FROM orders WHERE o_orderstatus <> 'P'), w AS (SELECT CAST(c_custkey AS VARCHAR) AS uid FROM customer) SELECT uid, min(pack) AS pack FROM w LEFT JOIN p USING (uid) GROUP BY uid")
def expanded_packs(spark, sf_dir):
    packed = table(spark, sf_dir, "orders").where("o_orderstatus <> 'P'").select((F.col("o_orderkey") % 600).cast("string").alias("uid"), (F.col("o_orderkey") % 4).cast("string").alias("pack"))
    found, lost = outbox.expanded_packs(packed, table(spark, sf_dir, "customer").select(text("c_custkey").alias("uid")))
    return found.select("uid", "pack").unionByName(lost.select("uid", none().alias("pack")))


@query("""WITH r AS (SELECT 'p' || (o_orderkey % 2000) AS path, 'v' || (o_orderkey % 3000) AS value FROM orders), h AS (SELECT 'p' || p_partkey AS path, 'v' || p_partkey AS value FROM part WHERE p_partkey < 500), a AS (SELECT * FROM r UNION ALL SELECT * FROM h)
SELECT 'fresh' AS part, path FROM r WHERE path NOT IN (SELECT path FROM h) GROUP BY path UNION ALL SELECT 'conflict', path FROM a GROUP BY path HAVING count(DISTINCT value) > 1""")
def enqueued(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.concat(F.lit("p"), F.col("o_orderkey") % 2000).alias("path"), F.concat(F.lit("v"), F.col("o_orderkey") % 3000).alias("value"))
    held = table(spark, sf_dir, "part").where("p_partkey < 500").select(F.concat(F.lit("p"), "p_partkey").alias("path"), F.sha2(F.concat(F.lit("v"), "p_partkey"), 256).alias("sha256"))
    fresh, bad = outbox.enqueue(held, rows)
    return fresh.select(F.lit("fresh").alias("part"), "path").unionByName(bad.select(F.lit("conflict").alias("part"), "path"))


@query("""SELECT l_orderkey, l_linenumber, l_suppkey, count(*) OVER w <= 300 AND sum(CAST(l_quantity AS BIGINT)) OVER w <= 6000 AS admitted FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_suppkey, max(l_quantity) AS l_quantity FROM lineitem GROUP BY ALL) WINDOW w AS (PARTITION BY l_suppkey ORDER BY l_orderkey * 100 + l_linenumber ROWS UNBOUNDED PRECEDING)""")
def admitted_rows(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber", "l_suppkey").agg(F.max("l_quantity").cast("bigint").alias("bytes")).withColumn("path", F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return outbox.admitted(l, files=300, size=6000, lane="l_suppkey").select("l_orderkey", "l_linenumber", "l_suppkey", "admitted")


@query("SELECT count(*) AS files, coalesce(CAST(sum(strlen(text)) AS BIGINT), 0) AS bytes FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def pending_totals(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("path"), F.octet_length("text").cast("bigint").alias("bytes"))
    return outbox.totals(outbox.pending(d, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("path"))))


@query("""SELECT o_orderkey, sha256('{"contract_id": "c", "model": "' || o_orderpriority || '", "provider": "dashscope", "task": "' || CASE WHEN o_orderkey % 2 = 0 THEN 'grd' ELSE 'ecot' END || '", "uid": "' || o_custkey || '"}') AS identity FROM orders WHERE o_orderkey % 3 > 0""")
def saved_rejections(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    rows = o.select("o_orderkey", text("o_custkey").alias("uid"), F.when(k % 3 == 0, "sta").when(k % 2 == 0, "grd").otherwise("ecot").alias("task"), F.lit("dashscope").alias("provider"), F.col("o_orderpriority").alias("model"), F.lit("c").alias("contract_id"), k.cast("string").alias("reason"))
    ident = outbox.rejection_identity(*[F.col(c) for c in ("uid", "task", "provider", "model", "contract_id")])
    return rows.withColumn("identity", ident).join(outbox.rejections(rows), "identity", "left_semi").select("o_orderkey", "identity")


@query("SELECT CAST(o_custkey AS VARCHAR) AS source_record_uid, string_agg(DISTINCT o_orderstatus, ',' ORDER BY o_orderstatus) AS tasks, arg_min(o_orderpriority, (o_orderstatus, o_orderpriority)) AS error FROM orders WHERE o_orderkey % 6 = 0 GROUP BY o_custkey")
def error_rows(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(text("o_custkey").alias("source_record_uid"), F.lit("x").alias("input_locator"), F.col("o_orderstatus").alias("task"), F.when(F.col("o_orderkey") % 6 == 0, F.col("o_orderpriority")).alias("error"))
    first = o.groupBy("source_record_uid", "input_locator", "task").agg(F.min("error").alias("error"))
    return outbox.error_rows(first).select("source_record_uid", F.array_join("tasks", ",").alias("tasks"), "error")


@query("""WITH s AS (SELECT l_suppkey % 50 AS shard, l_orderkey * 10 + l_linenumber AS line, CAST(max(l_partkey) AS VARCHAR) AS value FROM lineitem GROUP BY ALL), c AS (SELECT shard, count(*) FILTER (line % 97 = 0) AS missing FROM s GROUP BY shard)
SELECT shard, CASE WHEN shard % 5 = 0 THEN 'input_changed' WHEN missing > 0 THEN 'unreviewed_lines' END AS reason FROM c""")
def rewritten_shards(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy((F.col("l_suppkey") % 50).alias("shard"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line")).agg(F.max("l_partkey").cast("string").alias("value"))
    changed = l.withColumn("value", F.when(F.col("shard") % 5 == 0, F.concat("value", F.lit("x"))).otherwise(F.col("value")))
    good, refused = outbox.audited_rewrite(changed, changed.where("line % 97 > 0"), outbox.shard_digest(l))
    return good.select("shard", none().alias("reason")).distinct().unionByName(refused.select("shard", "reason"))


@query("""WITH p AS (SELECT o_orderstatus AS run, o_orderpriority AS batch, o_custkey % 3 AS t, count(*) AS written, count(*) FILTER (o_orderkey % 9 = 0) AS errors FROM orders GROUP BY ALL), b AS (SELECT run, batch, sum(errors) AS e, max(CASE WHEN t = 1 THEN written END) AS w FROM p GROUP BY ALL)
SELECT run, batch, row_number() OVER x AS batches, CAST(sum(e) OVER x AS BIGINT) AS errors, CAST(sum(w) OVER x AS BIGINT) AS written_1 FROM b WINDOW x AS (PARTITION BY run ORDER BY batch ROWS UNBOUNDED PRECEDING)""")
def batch_totals(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("run"), F.col("o_orderpriority").alias("batch"), (F.col("o_custkey") % 3).cast("string").alias("task")).agg(F.count("*").alias("written"), F.count_if(F.col("o_orderkey") % 9 == 0).alias("errors"))
    out = outbox.batch_totals(o)
    return out.select("run", "batch", "batches", "errors", F.try_element_at("written", F.lit("1")).alias("written_1"))


# Scalars


@query("""SELECT p_partkey, CASE WHEN p_partkey % 4 = 0 THEN lower(trim(p_type)) WHEN p_size % 5 = 0 THEN 'video/quicktime' WHEN p_size % 5 = 1 THEN 'image/png' WHEN p_size % 5 = 2 THEN 'video/mp4' WHEN p_size % 5 = 3 THEN 'image/jpeg' ELSE 'application/octet-stream' END AS mime,
CASE WHEN p_partkey % 6 = 0 THEN 'human' ELSE 'robot' END AS embodiment, p_partkey % 3 = 0 AS sha_ok, 's' || p_partkey || ':' || CASE WHEN p_partkey % 2 = 0 THEN 'frame:' || p_size ELSE 'media:' || (p_size + 1) END AS window_key, length('data:a/b;base64,') + (p_size + 2) // 3 * 4 AS uri_size,
'see [MEDIA_URL_REDACTED] ' || p_size AS redacted, round_even(p_size / 3.0 + 0.25, 6) AS at FROM part""")
def scalars_of_media(spark, sf_dir):
    p, k, n = table(spark, sf_dir, "part"), F.col("p_partkey"), F.col("p_size")
    member = F.when(n % 5 == 0, "x/a.MOV").when(n % 5 == 1, "b.png").otherwise("c.bin")
    kind = F.when(n % 5 == 2, "Video").when(n % 5 == 3, "frame")
    return p.select(
        "p_partkey", scalar.mime_type(F.when(k % 4 == 0, F.concat(F.lit(" "), "p_type")).otherwise(" "), member, kind).alias("mime"), scalar.embodiment(F.when(k % 6 == 0, "EgoDex clips").otherwise(F.col("p_brand")), F.col("p_type")).alias("embodiment"),
        scalar.sha_pattern(F.when(k % 3 == 0, F.sha2(k.cast("string"), 256)).otherwise(F.upper(F.sha2(k.cast("string"), 256)))).alias("sha_ok"), scalar.window_key(F.concat(F.lit("s"), k), F.when(k % 2 == 0, n), n + 1).alias("window_key"),
        scalar.data_uri_size(F.lit("a/b"), n).cast("bigint").alias("uri_size"), scalar.redact_urls(F.concat(F.lit("see https://h/"), k, F.lit("?q "), n)).alias("redacted"),
        scalar.offset_seconds(n / F.lit(3.0), F.lit(0.25)).alias("at"),
    )


PROGRESS = {"Half done. Task not yet complete.": "Half done; Task not yet complete.", "The task is not complete because it waits": "The task is not complete because it waits; Task not yet complete.", "Cup moved. The task is not complete": "Cup moved; Task not yet complete.", "All tasks are complete!": "All tasks are complete; Task complete.", "The subtask is complete": "The subtask is complete.", "If the task is complete": "If the task is complete."}


@query("SELECT o_orderkey, ([" + ", ".join(f"'{v}'" for v in PROGRESS.values()) + f"])[o_orderkey % {len(PROGRESS)} + 1] AS progress, CASE o_orderkey % 4 WHEN 0 THEN 'past frames' WHEN 1 THEN 'the video shows' END AS leak, CASE o_orderkey % 3 WHEN 0 THEN 'stack cups' WHEN 1 THEN 'sort nuts' ELSE 'fold it' END AS prompt_task FROM orders")
def progress_texts(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    said = F.get(F.array(*[F.lit(t) for t in PROGRESS]), (k % len(PROGRESS)).cast("int"))
    leak = F.when(k % 4 == 0, "Seen in Past Frames.").when(k % 4 == 1, "As the video shows").otherwise("A cup.")
    prompt = F.when(k % 3 == 0, "a\nGlobal task context:\nuser: hi assistant: <think>no</think> stack cups").when(k % 3 == 1, "Current goal is: sort nuts. Last 3 steps: x").otherwise("Task: fold it")
    return o.select("o_orderkey", scalar.progress_sentence(scalar.completion_suffix(said)).alias("progress"), scalar.leaked_phrase(leak).alias("leak"), scalar.prompt_task_name(prompt).alias("prompt_task"))


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'tpm' WHEN 1 THEN 'rpm' ELSE 'unknown' END AS rate, o_orderkey % 4 = 0 OR o_orderkey % 5 = 0 AS fatal, o_orderkey % 2 = 0 AND o_orderkey % 7 = 0 AS rejected, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 50 AS DOUBLE) WHEN o_orderkey % 3 = 1 THEN CAST(greatest(0, o_orderkey % 100 - 40) AS DOUBLE) END AS wait, 'ab' || o_orderkey AS answer FROM orders""")
def response_classes(spark, sf_dir):
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey")
    body = F.concat(F.lit('{"error":{"code":"'), F.when(k % 7 == 0, scalar.REJECTION_CODE).otherwise("other"), F.lit('","message":"Input image is bad"}}'))
    now = F.lit("2024-01-01 00:00:40").cast("timestamp")
    date = F.date_format(F.timestamp_seconds(F.lit(1704067200) + k % 100), "EEE, dd MMM yyyy HH:mm:ss 'GMT'")
    content = F.when(k % 2 == 0, F.concat(F.lit('[{"text":"ab"},{"text":"'), k, F.lit('"}]'))).otherwise(F.concat(F.lit('"ab'), k, F.lit('"')))
    return o.select(
        "o_orderkey", scalar.rate_kind(F.when(k % 3 == 0, "TPM limit").when(k % 3 == 1, "requestRateLimit").otherwise("x")).alias("rate"), scalar.fatal_response(F.when(k % 4 == 0, 403).otherwise(500), F.when(k % 5 == 0, "Account Balance is low").otherwise("ok")).alias("fatal"),
        scalar.media_rejection(F.when(k % 2 == 0, 400).otherwise(500), body).alias("rejected"), scalar.retry_after(F.when(k % 3 == 0, (k % 50).cast("string")).when(k % 3 == 1, date).otherwise(" "), now).alias("wait"),
        scalar.response_text(F.concat(F.lit('{"choices":[{"message":{"content":'), content, F.lit("}}]}"))).alias("answer"),
    )


@query("SELECT event_id, sha256('{\"a\":' || (event_id % 5) || ',' || substr(replace(props, ' ', ''), 2)) AS compact, sha256('{\"a\": ' || (event_id % 5) || ', \"k\": ' || (props->>'$.k') || '}') AS spaced, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def canonical_digests(spark, sf_dir):
    """Canonical forms of the same object, written with its keys in another order, and the object found in an answer."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k")
    raw = F.concat(F.lit('{"k": '), k, F.lit(', "a":'), F.col("event_id") % 5, F.lit("}"))
    return e.select("event_id", pyfuncs.json_digest("sorted-compact")(raw).alias("compact"), pyfuncs.json_digest("spaced")(raw).alias("spaced"), F.get_json_object(pyfuncs.first_json_object_unfenced(F.concat(F.lit("so: "), raw, F.lit(" {"))), "$.k").cast("bigint").alias("k"))


PIXELS = "p AS (SELECT l_orderkey AS o, l_linenumber AS n, l_partkey % 1001 AS v, 320 + l_suppkey % 7 * 160 AS w, l_suppkey % 300 AS lo FROM lineitem)"


@query(f"WITH {PIXELS} SELECT o, n, round(v / 1000.0 * (w - 1), 6) AS pixel, CAST(round_even(v / 1000.0 * (w - 1) / (w - 1) * 1000, 0) AS BIGINT) AS back, CAST(round_even((lo + v / 1000.0 * 199) / (w + 299) * 1000, 0) AS BIGINT) AS crop, count(*) AS copies FROM p GROUP BY ALL")
def pixels(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("n"), (F.col("l_partkey") % 1001).alias("v"), (320 + F.col("l_suppkey") % 7 * 160).alias("w"), (F.col("l_suppkey") % 300).alias("lo"))
    at = scalar.grid_to_pixel(F.col("v"), F.col("w"))
    rows = l.select("o", "n", F.round(at, 6).alias("pixel"), scalar.pixel_to_grid(at, F.col("w")).cast("bigint").alias("back"), scalar.crop_to_full(F.col("v"), F.col("lo"), F.col("lo") + 200, F.col("w") + 300).cast("bigint").alias("crop"))
    return rows.groupBy("o", "n", "pixel", "back", "crop").agg(F.count("*").alias("copies"))


@query("""WITH b AS (SELECT p_partkey AS k, p_size * 10 AS x, p_partkey % 700 AS y, 640 AS w, 480 AS h FROM part), c AS (SELECT k, x, y, x + 120 AS x2, y + CASE WHEN k % 9 = 0 THEN 0 ELSE 90 END AS y2, w, h FROM b),
e AS (SELECT k, y AS y0, y2 AS y9, CAST(x AS DOUBLE) / 1000 * w AS x1, CAST(x2 AS DOUBLE) / 1000 * w AS x2, CAST(y AS DOUBLE) / 1000 * h AS y1, CAST(y2 AS DOUBLE) / 1000 * h AS y2, w, h FROM c),
p AS (SELECT *, CAST(greatest(0, floor(x1 - (x2 - x1) * 0.25::DOUBLE)) AS BIGINT) AS a, CAST(greatest(0, floor(y1 - (y2 - y1) * 0.25::DOUBLE)) AS BIGINT) AS b, CAST(least(w, ceil(x2 + (x2 - x1) * 0.25::DOUBLE)) AS BIGINT) AS c, CAST(least(h, ceil(y2 + (y2 - y1) * 0.25::DOUBLE)) AS BIGINT) AS d FROM e)
SELECT k, CASE WHEN y9 > y0 AND c - a >= 2 AND d - b >= 2 THEN concat_ws(',', a, b, c, d) END AS crop FROM p""")
def crops(spark, sf_dir):
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    x, y = (F.col("p_size") * 10).cast("double"), (k % 700).cast("double")
    box = F.array(x, y, x + 120, y + F.when(k % 9 == 0, 0.0).otherwise(90.0))
    return p.select(k.alias("k"), F.array_join(scalar.expanded_crop(box, F.lit(640), F.lit(480), 0.25), ",").alias("crop"))


# Steps, windows and frames


@query("""WITH i AS (SELECT o_custkey AS uid, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_totalprice FROM orders), f AS (SELECT *, (pos - 1) * 10 AS a, (pos - 1) * 10 + 4 + k % 8 AS b FROM i), e AS (SELECT *, max(a) FILTER (pos = 1) OVER (PARTITION BY uid) AS lo, last_value(b) OVER w AS hi, count(*) OVER (PARTITION BY uid) AS n, 60.0 AS top FROM f WINDOW w AS (PARTITION BY uid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
r AS (SELECT *, CASE WHEN pos = n THEN top ELSE top * least(1.0, greatest(0.0, (b - lo) / CAST(hi - lo AS DOUBLE))) END AS x FROM e WHERE hi > lo), m AS (SELECT *, coalesce(max(x) OVER (PARTITION BY uid ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM r), kept AS (SELECT * FROM m WHERE x > before + 1e-6)
SELECT uid, row_number() OVER v AS pos, 'order ' || k AS subtask, round(before, 6) AS start_s, round(CASE WHEN lead(pos) OVER v IS NULL THEN top ELSE x END, 6) AS end_s FROM kept WINDOW v AS (PARTITION BY uid ORDER BY pos)""")
def provider_frames(spark, sf_dir):
    pos = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    i = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), pos.alias("pos"), F.concat(F.lit(" Order "), "o_orderkey").alias("description"), F.col("o_orderpriority").alias("skill"), F.col("o_orderkey").alias("k"))
    i = i.withColumn("start_frame", (F.col("pos") - 1) * 10).withColumn("end_frame", (F.col("pos") - 1) * 10 + 4 + F.col("k") % 8).withColumn("has_video", F.lit(True)).withColumn("frame_count", F.lit(0)).withColumn("duration", F.lit(60.0))
    out = timeline.provider_frames_to_steps(i)
    return out.select("uid", big("pos"), "subtask", F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"))


@query("""WITH s AS (SELECT o_custkey AS uid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS j, o_orderstatus AS st FROM orders), c AS (SELECT uid, j // 3 AS chunk, j % 3 AS pos, st, max(j // 3) OVER (PARTITION BY uid) + 1 AS k FROM s),
m AS (SELECT uid, chunk, pos, st, k * 10.0 AS d, CASE WHEN lead(pos) OVER w IS NULL THEN chunk * 10.0 + 10 ELSE chunk * 10.0 + (pos + 1) * 4 * 10 / 12.0 END AS e FROM c WINDOW w AS (PARTITION BY uid, chunk ORDER BY pos)),
g AS (SELECT *, CASE WHEN st = lag(st) OVER v THEN 0 ELSE 1 END AS n FROM m WINDOW v AS (PARTITION BY uid ORDER BY chunk, pos)), i AS (SELECT *, sum(n) OVER (PARTITION BY uid ORDER BY chunk, pos) AS island FROM g),
a AS (SELECT uid, island, any_value(st) AS st, arg_max(e, (chunk, pos)) AS e, max(d) AS d, count(*) AS merged FROM i GROUP BY uid, island)
SELECT uid, row_number() OVER z AS pos, st AS subtask, round(coalesce(lag(e) OVER z, 0), 6) AS start_s, round(CASE WHEN lead(e) OVER z IS NULL THEN d ELSE e END, 6) AS end_s, merged FROM a WINDOW z AS (PARTITION BY uid ORDER BY island)""")
def merged_chunks(spark, sf_dir):
    by = W.partitionBy("o_custkey").orderBy("o_orderkey")
    s = table(spark, sf_dir, "orders").withColumn("j", F.row_number().over(by) - 1).withColumn("uid", F.col("o_custkey"))
    chunk, pos = F.floor(F.col("j") / 3).cast("int"), F.col("j") % 3
    rows = s.select("uid", chunk.alias("chunk"), pos.alias("pos"), F.col("o_orderstatus").alias("subtask"), *[F.lit("None").alias(f) for f in timeline.SEMANTIC[1:]], (pos * 4.0).alias("start_s"), ((pos + 1) * 4.0).alias("end_s"), F.lit(12.0).alias("local_duration"), (chunk * 10.0).alias("chunk_start"), F.lit(10.0).alias("span"))
    rows = rows.withColumn("duration", (F.max("chunk").over(W.partitionBy("uid")) + 1) * 10.0)
    out = timeline.merge_chunks(rows)
    return out.select("uid", big("pos"), "subtask", F.round("start_s", 6).alias("start_s"), F.round("end_s", 6).alias("end_s"), "merged")


@query("""WITH s AS (SELECT o_orderkey AS uid, 1 AS pos, (o_orderkey % 40) / 8 AS a, (o_orderkey % 40) / 8 + 2.5 AS b, 6.0 AS d FROM orders), g AS (SELECT *, unnest(range(CAST(ceil(a * 2 - 1e-9) AS BIGINT), CAST(ceil(least(b, d) * 2 - 1e-9) AS BIGINT))) AS f FROM s)
SELECT uid, f AS anchor_frame, round(least(d, f / 2 + 4), 6) AS future_end_s, round(least(d, f / 2 + 4) - f / 2, 6) AS future_s, least(d, f / 2 + 4) - f / 2 < 4 AS padded, '1:frame:' || f AS window_key FROM g WHERE f / 2 < least(b, d) AND f % 3 > 0""")
def future_windows(spark, sf_dir):
    """The clips after each anchor that no unit has recorded yet."""
    a = (F.col("o_orderkey") % 40) / 8
    steps = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"), F.lit(1).alias("pos"), a.alias("start_s"), (a + 2.5).alias("end_s"), F.lit(6.0).alias("duration"))
    windows = grids.future_windows(grids.anchors(steps))
    left = grids.pending(windows, windows.where("anchor_frame % 3 = 0"))
    return left.select("uid", big("anchor_frame"), "future_end_s", "future_s", "padded", "window_key")


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 40 AS n FROM orders) SELECT k, CASE WHEN n = 0 THEN '' WHEN n <= 12 THEN array_to_string(range(0, n), ',') ELSE array_to_string([CAST(floor(i * (n - 1) / 11) AS BIGINT) FOR i IN range(0, 12)], ',') END AS fallback, CAST(greatest(0, least(n - 1, round_even(k % 100 / 7.0 * 5, 0))) AS BIGINT) AS nearest, CASE WHEN k % 5 >= k % 3 THEN array_to_string(range(k % 3, least(k % 5 + 1, n)), ',') ELSE '' END AS cut FROM o""")
def frame_choices(spark, sf_dir):
    k = F.col("o_orderkey")
    n = (k % 40).cast("int")
    cut = grids.media_slice(grids.int_range(F.lit(0), n), (k % 3).cast("int"), (k % 5).cast("int"))
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.array_join(grids.fallback_frames(n), ",").alias("fallback"), grids.nearest_frame(k % 100 / F.lit(7.0), F.lit(5.0), n).cast("bigint").alias("nearest"), F.array_join(cut, ",").alias("cut"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 13 AS a, o_orderkey % 13 + 20 + o_orderkey % 17 AS b FROM orders), i AS (SELECT k, a, b, list_sort(list_distinct([x FOR x IN [k % 60, k % 31, k % 23] IF x BETWEEN a AND b])) AS own FROM o),
s AS (SELECT *, list_concat(own, [x FOR x IN list_distinct([CAST(round_even(a + j * ((b - a) / (8 - len(own) - 1)), 0) AS BIGINT) FOR j IN range(0, 8 - len(own))]) IF NOT list_contains(own, x)]) AS both_ FROM i)
SELECT k, array_to_string(list_sort(list_concat(both_, [x FOR x IN range(a, b + 1) IF NOT list_contains(both_, x)][1:8 - len(both_)])), ',') AS frames FROM s""")
def bounded_choice(spark, sf_dir):
    k = F.col("o_orderkey")
    a = (k % 13).cast("int")
    frames = grids.bounded(a, a + 20 + (k % 17).cast("int"), F.array((k % 60).cast("int"), (k % 31).cast("int"), (k % 23).cast("int")), 8)
    return table(spark, sf_dir, "orders").select(k.alias("k"), F.array_join(frames, ",").alias("frames"))


@query(f"WITH {USER_EVENTS}, n AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY t, event_id) AS i, row_number() OVER (PARTITION BY uid ORDER BY t DESC, event_id DESC) AS z FROM ue) SELECT 'nth' AS part, event_id FROM n WHERE i % 10 = 0 UNION ALL SELECT 'latest', event_id FROM n WHERE z <= 3 UNION ALL SELECT 'frame', event_id FROM ue WHERE event_id % 7 = 0")
def picked_rows(spark, sf_dir):
    e = user_events(spark, sf_dir).withColumn("at", F.struct("t", "event_id"))
    nth, latest, frames = rates.every_nth_row(e, 10, key="uid", order="at"), reuse.latest_first(e, key="uid", order="at", n=3), grids.every_nth(e.withColumnRenamed("event_id", "frame"), 7).withColumnRenamed("frame", "event_id")
    return nth.select(F.lit("nth").alias("part"), "event_id").unionByName(latest.select(F.lit("latest").alias("part"), "event_id")).unionByName(frames.select(F.lit("frame").alias("part"), "event_id"))


@query("""WITH o AS (SELECT o_custkey AS uid, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS pos, o_orderstatus AS st FROM orders) SELECT uid, string_agg(pos || ':' || lower(st), ';' ORDER BY pos) AS steps FROM o GROUP BY uid""")
def episode_timelines(spark, sf_dir):
    pos = F.row_number().over(W.partitionBy("o_custkey").orderBy("o_orderkey"))
    steps = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), pos.alias("pos"), F.concat(F.lit(" "), "o_orderstatus").alias("subtask"), *[F.lit("").alias(f) for f in timeline.SEMANTIC[1:]], F.lit("x").alias("_private"))
    out = timeline.timeline(timeline.normalised(records.public_scope(steps)))
    return out.select("uid", F.array_join(F.transform("subtasks", lambda s: F.concat_ws(":", s["pos"], s["subtask"])), ";").alias("steps"))


# Events


@query(f"""WITH {USER_EVENTS}, i AS (SELECT uid, event_id, CAST(floor(t / 3600) AS BIGINT) AS f FROM ue) SELECT event_id, (SELECT max(f) FROM i b WHERE b.uid = i.uid AND b.f < i.f) AS previous_index FROM i""")
def previous_index(spark, sf_dir):
    e = user_events(spark, sf_dir).select("uid", "event_id", F.floor(F.col("t") / 3600).alias("contact_media_index"))
    return ev.previous_index(e).select("event_id", "previous_index")


@query(f"""WITH {USER_EVENTS}, i AS (SELECT uid, event_id, CAST(floor(t / 3600) AS BIGINT) AS f FROM ue WHERE event_type IN ('purchase', 'error')) SELECT event_id, greatest(0, 10, f - 3, coalesce((SELECT max(f) FROM i b WHERE b.uid = i.uid AND b.f < i.f) + 1, 0)) AS first_frame, least(99999, 700, f - 1) AS last_frame FROM i""")
def image_intervals(spark, sf_dir):
    e = user_events(spark, sf_dir).where("event_type IN ('purchase', 'error')")
    rows = e.select("uid", "event_id", F.floor(F.col("t") / 3600).alias("contact_media_index"), F.lit(10).alias("start_i"), F.lit(700).alias("end_i"), F.lit(100_000).alias("media_count"))
    return ev.image_intervals(rows).select("event_id", big("first_frame"), big("last_frame"))


@query("""WITH s AS (SELECT c_custkey AS uid, unnest([1, 2, 3, 4]) AS pos FROM customer), o AS (SELECT o_orderkey AS e, o_custkey AS uid, (o_orderkey % 460) / 10.0 AS t, CAST(o_orderkey % 4 + 1 AS INTEGER) AS step FROM orders), f AS (SELECT *, CAST(greatest(0, least(399, round_even(t * 10, 0))) AS BIGINT) AS frame FROM o),
j AS (SELECT *, round(frame / 10.0, 6) AS a_s, CASE WHEN frame / 10.0 < 40 THEN CAST(floor(frame / 100.0) AS INTEGER) + 1 END AS hit FROM f)
SELECT e, frame AS target_frame, CASE WHEN t > 39.9 + 1.5 THEN 'outside_target_view' WHEN hit IS DISTINCT FROM step AND NOT ((abs(a_s - (step - 1) * 10) <= 0.5 OR abs(a_s - step * 10) <= 0.5) AND abs(hit - step) = 1) THEN 'subtask_mismatch' END AS error FROM j""")
def remapped_views(spark, sf_dir):
    steps = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("pos")).select("uid", F.col("pos").cast("string").alias("step_id"), "pos", ((F.col("pos") - 1) * 10.0).alias("start_s"), (F.col("pos") * 10.0).alias("end_s"))
    k = F.col("o_orderkey")
    step = (k % 4 + 1).cast("int")
    events_ = table(spark, sf_dir, "orders").select(k.alias("event_id"), F.col("o_custkey").alias("uid"), (k % 460 / 10).alias("t"), step.cast("string").alias("step_id"), ((step - 1) * 10.0).alias("step_start_s"), (step * 10.0).alias("step_end_s"), F.lit(10.0).alias("fps"), F.lit(400).alias("frame_count"))
    return ev.remap_to_view(events_, steps).select(F.col("event_id").alias("e"), big("target_frame"), "error")


@query("""WITH p AS (SELECT o_custkey AS uid, o_orderstatus AS s, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS pos, o_orderkey AS k FROM orders) SELECT k, CASE WHEN k % 3 > 0 THEN 'r' || k WHEN pos % 2 = 0 THEN 'p' || k END AS event_id FROM p""")
def inherited_ids(spark, sf_dir):
    pos = F.row_number().over(W.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderstatus").alias("step_id"), pos.alias("pos"), F.col("o_orderkey").alias("k"))
    reviews = o.withColumn("event_id", F.when(F.col("k") % 3 > 0, F.concat(F.lit("r"), "k")))
    return ev.inherit_ids(reviews, o.where("pos % 2 = 0").withColumn("event_id", F.concat(F.lit("p"), "k"))).select("k", "event_id")


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey AS uid, CASE WHEN o_orderkey % 5 = 0 THEN ' ' WHEN o_orderkey % 7 = 0 THEN 'same' ELSE 'e' || o_orderkey END AS id, CASE WHEN o_orderkey % 4 = 0 THEN -1.0 ELSE 1.0 END AS t, o_orderkey % 8 <> 0 AS acc FROM orders), d AS (SELECT *, count(*) OVER (PARTITION BY uid, id) AS n FROM e)
SELECT k, concat_ws(',', CASE WHEN id = ' ' THEN 'empty_event_id' END, CASE WHEN n > 1 THEN 'duplicate_event_id' END, CASE WHEN t < 0 AND acc THEN 'invalid_contact_time' END) AS errors FROM d""")
def event_errors(spark, sf_dir):
    k = F.col("o_orderkey")
    e = table(spark, sf_dir, "orders").select(k.alias("k"), F.col("o_custkey").alias("uid"), F.lit("s").alias("step_id"), F.when(k % 5 == 0, " ").when(k % 7 == 0, "same").otherwise(F.concat(F.lit("e"), k)).alias("event_id"), F.when(k % 4 == 0, -1.0).otherwise(1.0).alias("contact_time_seconds"), (k % 8 != 0).alias("accepted"))
    return ev.event_errors(e).select("k", F.array_join("errors", ",").alias("errors"))


@query("SELECT o_orderkey AS e, CAST(j AS BIGINT) AS sample, round_even((o_orderkey % 90 + j * 3) / 30.0, 6) AS time_seconds, round_even(5 - (o_orderkey % 90 + j * 3) / 30.0, 6) AS time_to_contact_seconds, CASE WHEN o_orderkey % 10 / 4.0 > (o_orderkey % 90 + j * 3) / 30.0 THEN 'intervening_contact' END AS error FROM orders, (SELECT unnest([0, 1, 2]) AS j)")
def observed_frames(spark, sf_dir):
    k = F.col("o_orderkey")
    frames = F.transform(F.array(F.lit(0), F.lit(1), F.lit(2)), lambda j: (k % 90 + j * 3).cast("int"))
    s = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), k.alias("event_id"), F.lit(5.0).alias("t"), F.lit(30.0).alias("fps"), (k % 10 / 4).alias("previous_t"), F.lit(0.0).alias("step_start_s"), frames.alias("sampled"))
    return ev.exploded_observations(s).select(F.col("event_id").alias("e"), big("sample"), "time_seconds", "time_to_contact_seconds", "error")


@query("""WITH v AS (SELECT o_custkey AS uid, CASE WHEN o_orderkey % 3 = 0 THEN 'accepted' WHEN o_orderkey % 3 = 1 THEN 'rejected' ELSE 'unreviewed' END AS verdict, o_orderkey % 11 AS asked, o_orderkey % 7 AS seen FROM orders) SELECT uid, count(*) FILTER (verdict = 'accepted') AS accepted, count(*) FILTER (verdict <> 'accepted') AS rejected, CAST(sum(greatest(0, asked - seen)) AS BIGINT) AS unseen FROM v GROUP BY uid""")
def verdict_totals(spark, sf_dir):
    k = F.col("o_orderkey")
    v = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.when(k % 3 == 0, "accepted").when(k % 3 == 1, "rejected").otherwise("unreviewed").alias("verdict"), ev.observation_counts(k % 11, k % 7).alias("u"))
    return ev.verdict_counts(v).join(v.groupBy("uid").agg(F.sum("u").alias("unseen")), "uid")


@query("""WITH b AS (SELECT c_custkey AS uid, unnest([1, 2, 3]) AS i FROM customer), s AS (SELECT uid, i, i * 10 AS a, i * 10 + 10 AS z FROM b), p AS (SELECT o_orderkey AS e, o_custkey AS uid, o_orderkey % 50 AS t FROM orders) SELECT e, CAST(min(i) AS BIGINT) AS pos FROM p JOIN s ON p.uid = s.uid AND t BETWEEN a AND z GROUP BY e""")
def index_in_interval(spark, sf_dir):
    """Closed image ranges: an index on a shared edge belongs to the first."""
    spans = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), F.explode(F.sequence(F.lit(1), F.lit(3))).alias("pos")).withColumn("start_s", F.col("pos") * 10).withColumn("end_s", F.col("pos") * 10 + 10)
    at = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.col("o_orderkey").alias("e"), (F.col("o_orderkey") % 50).alias("t"))
    return timeline.points_in_intervals(at, spans, closed=True, width=10.0).select("e", big("pos"))


# Points


def _points(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("uid"), F.col("l_linenumber").alias("pair_index")).agg(F.min("l_partkey").alias("p"))
    return l.withColumn("event_id", F.lit("e")).withColumn("point_id", F.concat(F.lit("H"), "pair_index")).unionByName(l.withColumn("event_id", F.lit("e")).withColumn("point_id", F.concat(F.lit("O"), "pair_index")))


POINTS = "b AS (SELECT l_orderkey AS uid, l_linenumber AS i, min(l_partkey) AS p FROM lineitem GROUP BY ALL), pt AS (SELECT uid, i, p, unnest(['H', 'O']) AS r FROM b)"


@query(f"""WITH {POINTS} SELECT uid, r || i AS point_id, CASE WHEN p % 5 = 0 THEN NULL ELSE p % 3 > 0 END AS accepted, CASE WHEN p % 5 = 0 THEN 'unreviewed_point' WHEN p % 7 = 0 THEN 'duplicate_review' WHEN p % 11 = 0 THEN 'incomplete_review' END AS error FROM pt""")
def point_verdicts(spark, sf_dir):
    pts = _points(spark, sf_dir)
    one = pts.where("p % 5 > 0").select("uid", "event_id", "point_id", F.when(F.col("p") % 3 > 0, "Yes").otherwise("No").alias("on"), F.lit("Yes").alias("clear"), F.when(F.col("p") % 11 == 0, " ").otherwise("r").alias("reason"), "p")
    reviews = one.unionByName(one.where("p % 7 = 0"))
    return points.verdicts(pts.select("uid", "event_id", "point_id"), reviews, ("on", "clear")).select("uid", "point_id", "accepted", "error")


@query(f"WITH {POINTS} SELECT uid, CAST(i AS BIGINT) AS pair_index FROM b WHERE p % 3 > 0 AND p % 4 > 0 AND p % 9 > 0")
def reviewed_pairs(spark, sf_dir):
    pts = _points(spark, sf_dir)
    said = pts.withColumn("accepted", F.when(F.col("point_id").startswith("H"), F.col("p") % 3 > 0).otherwise(F.col("p") % 4 > 0))
    xy = F.array(F.lit(1.0), F.lit(2.0))
    pairs = pts.where("point_id LIKE 'H%'").select("uid", "event_id", "pair_index", F.when(F.col("p") % 9 > 0, xy).alias("h_xy"), xy.alias("o_xy"))
    return points.reviewed_pairs(pairs, said).select("uid", big("pair_index"))


@query(f"""WITH {POINTS}, s AS (SELECT uid, i, CASE WHEN p % 3 = 0 THEN 'left' WHEN p % 3 = 1 THEN 'right' END AS side FROM b) SELECT uid, count(*) FILTER (r = 'H' AND side = 'left') AS left_hand, count(*) FILTER (r = 'H' AND side = 'right') AS right_hand, count(*) FILTER (r = 'H' AND side IS NULL) AS unknown_hand, count(*) FILTER (r = 'O') AS object, count(*) FILTER (r = 'O' AND side = 'left') AS left_objects FROM pt JOIN s USING (uid, i) GROUP BY uid""")
def hand_sides(spark, sf_dir):
    pts = _points(spark, sf_dir).withColumn("role", F.when(F.col("point_id").startswith("H"), "hand").otherwise("object")).withColumn("query_frame", F.lit(0))
    labels = pts.where("role = 'hand' AND p % 3 < 2").select("uid", "event_id", "point_id", F.when(F.col("p") % 3 == 0, "left").otherwise("right").alias("hand_side"))
    sided = points.with_sides(pts, labels)
    more = sided.groupBy("uid").agg(F.count_if((F.col("role") == "object") & (F.col("contact_hand_side") == "left")).alias("left_objects"))
    return points.side_counts(sided).select("uid", "left_hand", "right_hand", "unknown_hand", "object").join(more, "uid")


@query(f"""WITH {POINTS} SELECT uid, CAST(i AS BIGINT) AS pair_index, concat_ws(',', CASE WHEN p % 3 = 0 THEN 'H_tracker_invisible_or_missing' END, CASE WHEN p % 4 = 0 THEN 'H_coordinate_missing' WHEN p % 5 = 0 THEN 'H_coordinate_out_of_bounds' END, CASE WHEN p % 6 = 1 THEN 'O_coordinate_out_of_bounds' END) AS reasons FROM b""")
def tracker_visibility(spark, sf_dir):
    p = F.col("p")
    pairs = _points(spark, sf_dir).where("point_id LIKE 'H%'").select("uid", big("pair_index"), F.when(p % 3 == 0, F.lit(False)).when(p % 3 == 1, True).otherwise(True).alias("hand_visible"), F.when(p % 4 > 0, F.array(F.when(p % 5 == 0, 1.5).otherwise(0.5), F.lit(0.25))).alias("hand_xy"), F.lit(True).alias("object_visible"), F.array(F.lit(0.5), F.when(p % 6 == 1, -0.1).otherwise(0.1)).alias("object_xy"))
    return points.visibility_reasons(pairs).select("uid", "pair_index", F.array_join("reasons", ",").alias("reasons"))


@query(f"""WITH {POINTS} SELECT uid, CAST(i AS BIGINT) AS pair_index, CASE WHEN p % 3 > 0 THEN concat_ws(',', CAST(least(1000, greatest(0, round_even(p % 1100 - 50 + 0.5, 0))) AS BIGINT), CAST(p % 1000 AS BIGINT)) END AS h, CASE WHEN p % 3 = 0 THEN 'invalid_pair' END AS error FROM b""")
def normalised_pairs(spark, sf_dir):
    p = F.col("p")
    pairs = _points(spark, sf_dir).where("point_id LIKE 'H%'").select("uid", big("pair_index"), F.when(p % 3 > 0, F.array(p % 1100 - 50 + F.lit(0.5), (p % 1000).cast("double"))).alias("hand_point"), F.array(F.lit(3.0), F.lit(4.0)).alias("o_xy_1000"))
    return points.normalised_pairs(pairs).select("uid", "pair_index", F.array_join("h_xy", ",").alias("h"), "error")


@query(f"""WITH {POINTS} SELECT uid, row_number() OVER (PARTITION BY uid ORDER BY i) - 1 AS pair_index, CAST(round_even(p % 700 / 639.0 * 1000, 0) AS BIGINT) AS x, CASE WHEN p % 700 > 639 THEN 'invalid_coordinate' END AS error FROM b""")
def decoded_points(spark, sf_dir):
    xy = F.array((F.col("p") % 700).cast("double"), F.lit(100.0))
    frames = _points(spark, sf_dir).where("point_id LIKE 'H%'").select("uid", "event_id", F.col("pair_index").alias("detection"), F.lit(640).alias("width"), F.lit(480).alias("height"), F.array(F.struct(xy.alias("h_point"), F.array(F.lit(5.0), F.lit(5.0)).alias("o_point"))).alias("points"))
    return points.decoded_detections(frames).select("uid", big("pair_index"), F.get("h_xy", F.lit(0)).cast("bigint").alias("x"), "error")


@query(f"""WITH {POINTS}, n AS (SELECT uid, count(*) AS n, bool_or(p % 50 = 0) AS far, bool_or(p % 3 = 0) AS fine FROM b GROUP BY uid) SELECT uid, CASE WHEN uid % 5 = 0 THEN 'wrong_count' WHEN far THEN 'invalid_coordinate' WHEN fine THEN 'not_two_decimals' END AS error FROM n""")
def prediction_checks(spark, sf_dir):
    p = F.col("p")
    xy = F.array(F.when(p % 50 == 0, 1.5).when(p % 3 == 0, 0.125).otherwise(0.25), F.lit(0.5))
    said = _points(spark, sf_dir).where("point_id LIKE 'O%'").groupBy("uid").agg(F.collect_list(xy).alias("points")).withColumn("role", F.lit("object"))
    wanted = said.select("uid", "role", (F.size("points") + F.when(F.col("uid") % 5 == 0, 1).otherwise(0)).alias("count"))
    return points.prediction_errors(said, wanted, two_places=True).select("uid", "error")


@query(f"""WITH {POINTS}, k AS (SELECT uid, i, p, row_number() OVER (PARTITION BY uid ORDER BY i) AS n FROM b) SELECT uid, 'left_hand-' || n AS point_id, CASE WHEN p % 50 = 0 THEN 'lost' ELSE 'shown' END AS part FROM k""")
def split_predictions(spark, sf_dir):
    xy = F.array(F.when(F.col("p") % 50 == 0, 1.5).otherwise(0.25), F.lit(0.5))
    said = _points(spark, sf_dir).where("point_id LIKE 'O%'").groupBy("uid").agg(F.transform(F.array_sort(F.collect_list(F.struct("pair_index", xy.alias("xy")))), lambda x: x["xy"]).alias("points")).withColumn("role", F.lit("left_hand"))
    shown, lost = points.split_predictions(said)
    return shown.select("uid", "point_id", F.lit("shown").alias("part")).unionByName(lost.select("uid", "point_id", F.lit("lost").alias("part")))


@query("""WITH m AS (SELECT l_suppkey AS k, l_partkey % 97 AS px, l_orderkey % 89 AS py FROM lineitem), d AS (SELECT *, (px - 40.5) * (px - 40.5) + (py - 30.0) * (py - 30.0) AS d FROM m) SELECT k, arg_min(px, (d, py, px)) AS px, arg_min(py, (d, py, px)) AS py, round(sqrt(min(d)), 6) AS distance FROM d GROUP BY k""")
def nearest_pixels(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), (F.col("l_partkey") % 97).alias("px"), (F.col("l_orderkey") % 89).alias("py"))
    return points.nearest_pixel(m, keys=("k",), x=F.lit(40.5), y=F.lit(30.0)).select("k", "px", "py", F.round("distance", 6).alias("distance"))


@query("""WITH m AS (SELECT l_suppkey AS k, l_linenumber AS mask, min(l_quantity) AS d, max(l_discount) AS s FROM lineitem GROUP BY ALL) SELECT k, CAST(arg_min(mask, (d, -s, mask)) AS BIGINT) AS mask, min(d) AS distance FROM m GROUP BY k""")
def nearest_masks(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("k"), F.col("l_linenumber").alias("mask")).agg(F.min("l_quantity").alias("distance"), F.max("l_discount").alias("score"))
    return points.nearest_mask(m, keys=("k",)).select("k", big("mask"), "distance")


# Inventories, lookups, sets


@query("""WITH o AS (SELECT p_brand AS uid, p_partkey AS pos, p_size FROM part) SELECT uid, pos, CASE WHEN p_size % 6 = 0 THEN 'incomplete_coverage' WHEN p_size % 6 = 1 THEN 'invalid_object_index' WHEN p_size % 6 = 2 THEN 'empty_name' WHEN p_size % 6 = 3 THEN 'changed_unaffected_object' END AS error FROM o WHERE p_size % 6 < 4 UNION ALL SELECT DISTINCT uid, -1, 'invalid_object_index' FROM o""")
def name_edits(spark, sf_dir):
    p, n = table(spark, sf_dir, "part"), F.col("p_size") % 6
    o = p.select(F.col("p_brand").alias("uid"), F.lit(0).alias("frame"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), none().alias("alternate_name"), (n == 4).alias("editable"), n.alias("n"))
    e = o.where("n > 0").select("uid", "frame", "pos", F.when(F.col("n") == 2, " ").when(F.col("n").isin(3, 4), "other").otherwise(F.col("name")).alias("name"), F.col("name").alias("alternate_name"), "n")
    edits = e.unionByName(e.where("n = 1")).drop("n").unionByName(o.select("uid", "frame", F.lit(-1).cast("bigint").alias("pos"), F.lit("x").alias("name"), F.lit("x").alias("alternate_name")).distinct())
    return inventory.name_edit_errors(o.drop("n"), edits).select("uid", "pos", "error")


@query("SELECT o_custkey AS uid, count(*) AS total_frames, count(*) FILTER (o_orderkey % 3 > 0) AS accepted_frames, count(*) FILTER (o_orderkey % 3 = 0) AS rejected_frames, CASE WHEN min(o_orderstatus) <> max(o_orderstatus) THEN 'mixed_review_models' END AS error FROM orders GROUP BY o_custkey")
def partitioned_frames(spark, sf_dir):
    f = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), (F.col("o_orderkey") % 3 > 0).alias("registered"), F.col("o_orderstatus").alias("model"))
    return inventory.partitioned(f).select("uid", "total_frames", "accepted_frames", "rejected_frames", "error")


@query("""WITH p AS (SELECT CAST(o_custkey AS VARCHAR) AS uid, o_orderstatus AS provider, o_orderpriority AS model FROM orders), c AS (SELECT uid, provider, model, count(*) AS n FROM p GROUP BY ALL) SELECT uid, string_agg(provider || '/' || model || '=' || n, ';' ORDER BY provider, model) AS mix FROM c GROUP BY uid HAVING count(*) > 1""")
def provenance_mix(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(text("o_custkey").alias("uid"), F.col("o_orderstatus").alias("provider"), F.col("o_orderpriority").alias("model"))
    return provider.provenance_mix(o).select("uid", F.array_join(F.transform("mix", lambda m: F.concat(m["provider"], F.lit("/"), m["model"], F.lit("="), m["n"])), ";").alias("mix"))


@query("SELECT CASE WHEN o_custkey % 4 = 0 THEN 'not_wanted' WHEN o_orderkey % 3 = 0 THEN 'schema_differs' WHEN o_orderkey % 5 = 0 THEN 'prompt_sha_differs' WHEN o_orderkey % 7 = 0 THEN 'frame_differs' WHEN o_orderkey % 11 = 0 THEN 'empty' END AS reason, count(*) AS n FROM orders GROUP BY 1")
def prior_rejections(spark, sf_dir):
    k = F.col("o_orderkey")
    u = table(spark, sf_dir, "orders").select(text("o_custkey").alias("uid"), k.alias("unit_key"), F.when(k % 5 == 0, "x").otherwise("p").alias("prompt_sha"), F.lit("q").alias("question_sha"), F.when(k % 3 == 0, "x").otherwise("s").alias("schema"), F.when(k % 7 == 0, 9).otherwise(1).alias("frame"), F.when(k % 11 > 0, "v").alias("value"))
    wanted = u.where("CAST(uid AS BIGINT) % 4 > 0").select("uid", "unit_key", F.lit("p").alias("prompt_sha"), F.lit("q").alias("question_sha"), F.lit("s").alias("schema"), F.lit(1).alias("frame"))
    return provider.prior_units(u, wanted).groupBy("reason").agg(F.count("*").alias("n"))


@query("""WITH a AS (SELECT o_orderkey AS k, o_orderpriority AS v, CASE o_orderkey % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'recovered-v1' ELSE 'recovered-v2' END AS variant, o_orderkey % 4 > 0 AS ok, o_custkey AS uid FROM orders), r AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY CASE variant WHEN 'recovered-v2' THEN 1 WHEN 'recovered-v1' THEN 2 ELSE 3 END) AS n FROM a WHERE ok) SELECT uid, variant FROM r WHERE n = 1""")
def cached_answers(spark, sf_dir):
    k = F.col("o_orderkey")
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.when(k % 3 == 0, "base").when(k % 3 == 1, "recovered-v1").otherwise("recovered-v2").alias("variant"), (k % 4 > 0).alias("valid"))
    return lookup.best_cached(a, key="uid").select("uid", "variant")


@query("SELECT o_orderkey AS request FROM orders WHERE o_orderkey % 3 > 0")
def uncached_requests(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("request"), provider.request_hash(text("o_orderkey"), F.col("o_orderstatus")).alias("request_hash"))
    return lookup.uncached(o, o.where("request % 3 = 0")).select("request")


@query("""WITH a AS (SELECT CAST(o_custkey AS VARCHAR) AS uid, o_orderkey AS v FROM orders WHERE o_orderstatus = 'F'), b AS (SELECT CAST(o_custkey AS VARCHAR) AS uid, -o_orderkey AS v FROM orders WHERE o_orderstatus = 'O'), f AS (SELECT uid, min(v) AS v FROM a GROUP BY uid), s AS (SELECT uid, min(v) AS v FROM b GROUP BY uid), c AS (SELECT uid FROM (SELECT * FROM a UNION ALL SELECT * FROM b) GROUP BY uid HAVING min(v) <> max(v))
SELECT coalesce(f.uid, s.uid) AS uid, coalesce(f.v, s.v) AS v, c.uid IS NOT NULL AS conflict FROM f FULL OUTER JOIN s ON f.uid = s.uid LEFT JOIN c ON c.uid = coalesce(f.uid, s.uid)""")
def first_wins(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    a, b = (o.where(F.col("o_orderstatus") == s).select(text("o_custkey").alias("uid"), (F.col("o_orderkey") * sign).alias("v")) for s, sign in (("F", 1), ("O", -1)))
    out, bad = sets.conflict_checked_union(a, b, key="uid", value="v")
    return out.join(bad.select("uid", F.lit(True).alias("c")), "uid", "left").select("uid", "v", F.coalesce("c", F.lit(False)).alias("conflict"))


@query("""WITH f AS (SELECT DISTINCT o_custkey AS uid FROM orders WHERE o_orderstatus = 'P'), r AS (SELECT c_custkey AS uid, c_custkey IN (SELECT uid FROM f) AS failed, row_number() OVER (ORDER BY c_custkey IN (SELECT uid FROM f) DESC, c_custkey) AS n FROM customer) SELECT uid, n FROM r""")
def failed_first(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("uid"), F.col("c_custkey").alias("pos"))
    out = sets.failed_first(c, table(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("uid")))
    return out.select("uid", (F.col("row_index") + 1).alias("n"))


@query("SELECT c_custkey FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer) WHERE i // 64 < 5 AND i % 64 < 10")
def limited_batches(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey")
    return sets.first_per_batch(sets.labelled_batches(c, 64, order="c_custkey", limit=5), 10).select("c_custkey")


# Media, records, figures


@query("""WITH o AS (SELECT p_partkey AS k, p_brand AS uid, p_size AS n, p_name AS name FROM part) SELECT uid, 'grd:segment-' || n || ':frame-' || (k % 7) || ':object-' || k AS geometry_id, n || ',' || n || ',' || (n + 9) || ',' || (n + 8) AS box, name AS label FROM o WHERE k % 4 > 0""")
def frame_geometry(spark, sf_dir):
    n = F.col("p_size")
    o = table(spark, sf_dir, "part").select(F.col("p_brand").alias("uid"), n.alias("segment"), F.lit("s").alias("step_id"), (F.col("p_partkey") % 7).alias("frame"), F.lit(0).alias("media_index"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), F.when(F.col("p_partkey") % 4 > 0, F.array(n, n, n + 9, n + 8)).otherwise(F.array(n)).alias("bbox"))
    return records.frame_geometry(o).select("uid", "geometry_id", F.array_join("canonical.value", ",").alias("box"), "label")


@query("""WITH o AS (SELECT o_custkey AS uid, o_orderkey AS k FROM orders) SELECT uid, 'sta:segment-1:event-' || k || ':observation-' || (k % 3) || ':bbox' AS geometry_id FROM o UNION ALL SELECT uid, 'cpa:segment-1:event-' || k || CASE WHEN k % 2 = 0 THEN ':observation-' || (k % 3) ELSE '' END || ':pair-' || (k % 5) || ':' || r FROM o, (SELECT unnest(['contact_agent', 'contact_object']) AS r) WHERE r = 'contact_agent' OR k % 4 > 0""")
def event_geometry(spark, sf_dir):
    k = F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.lit(1).alias("segment"), F.lit("s").alias("step_id"), k.alias("event"), (k % 3).alias("observation"), F.lit(1.0).alias("time_seconds"), F.array(*[F.lit(v) for v in (1, 2, 3, 4)]).alias("bbox"), (k % 5).alias("pair_index"), F.array(F.lit(1), F.lit(2)).alias("h_xy"), F.when(k % 4 > 0, F.array(F.lit(1), F.lit(2))).alias("o_xy"))
    pairs = o.withColumn("observation", F.when(F.col("event") % 2 == 0, F.col("observation")))
    return records.observation_geometry(o, "sta").select("uid", "geometry_id").unionByName(records.point_geometry(pairs, "cpa").select("uid", "geometry_id"))


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 3 = 0 THEN 'a.tar' WHEN o_orderkey % 3 = 1 THEN 'own.mp4' ELSE 'dir/v.mp4' END AS path, CASE WHEN o_orderkey % 3 = 0 THEN 'm.mp4' END AS member, o_orderkey % 2 = 0 AS temporal FROM orders""")
def media_projection(spark, sf_dir):
    k = F.col("o_orderkey")
    item = F.struct(F.when(k % 2 == 0, "Video").otherwise("text").alias("type"), F.lit("m.mp4").alias("member"), F.when(k % 3 == 1, "own.mp4").otherwise("").alias("relative_path"), F.lit("file").alias("container_format"))
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), F.array(item).alias("items"), F.when(k % 3 == 0, "a.tar").otherwise("dir/v.mp4").alias("locator"))
    out = rows.withColumn("x", F.get(records.media_references(F.col("items"), F.col("locator")), F.lit(0)))
    return out.select("k", F.col("x.relative_path").alias("path"), F.col("x.member").alias("member"), records.is_temporal(F.col("items")).alias("temporal"))


@query("""SELECT o_custkey || ':annotation:grd:m' AS uid, o_orderkey AS k, CASE WHEN o_orderkey % 4 = 0 THEN 'drop' WHEN o_orderkey % 5 = 0 THEN 'defer' ELSE 'keep' END AS decision, o_orderkey % 4 > 0 AS loss, CASE WHEN o_orderkey % 3 = 0 THEN 'src' ELSE CAST(o_custkey AS VARCHAR) END AS source_uid FROM orders""")
def made_records(spark, sf_dir):
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(text("o_custkey").alias("uid"), F.col("o_orderstatus").alias("source_key"), F.lit("train").alias("split"), k.cast("string").alias("prompt"), F.lit("{}").alias("result"), F.when(k % 5 == 0, "deferred").otherwise("accepted").alias("status"), F.lit("r").alias("reason"), F.lit("l").alias("input_locator"), F.when(k % 3 == 0, "src").alias("source_uid"), F.lit("m").alias("media"), F.when(k % 4 == 0, 0).otherwise(2).alias("kept_segments"))
    out = records.make_records(rows, task="grd", model="m", provider="p")
    turn = lambda n: F.get("dialogue.turns", F.lit(n))
    return out.select("uid", turn(0)["content"].cast("bigint").alias("k"), F.col("cleaning.grounding_decision").alias("decision"), turn(1)["loss"].alias("loss"), F.col("provenance.source_record_uid").alias("source_uid"))


@query("SELECT o_custkey || ':annotation:cpa:m:' || o_orderkey AS uid, 'a' || o_orderkey AS answer, CAST(1 AS BIGINT) AS media FROM orders")
def student_records(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(text("o_custkey").alias("uid"), text("o_orderkey").alias("id"), F.lit("q").alias("prompt"), F.concat(F.lit("a"), "o_orderkey").alias("answer_text"), F.lit("frame.png").alias("media"))
    return records.student_records(rows).select("uid", F.get("dialogue.turns", F.lit(1))["content"].alias("answer"), F.size("media").cast("bigint").alias("media"))


@query("""SELECT p_brand AS owner, count(*) AS episodes, round(sum(p_size * 1e9) / 3.6e12, 9) AS hours FROM part GROUP BY p_brand""")
def owner_hours(spark, sf_dir):
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("owner"), (F.col("p_size") * F.lit(1e9)).alias("duration_ns"))
    return reuse.owner_hours(p).select("owner", "episodes", F.round("hours", 9).alias("hours"))


@query("SELECT event_type AS phase, CAST(sum(event_id % 3) AS BIGINT) AS active, CAST(sum(event_id % 5) AS BIGINT) AS completed, max(event_id % 11) AS seconds_max, any_value(k) AS usage FROM (SELECT *, 2 AS k FROM events) GROUP BY event_type")
def phase_figures(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("phase"), (F.col("event_id") % 3).alias("active"), (F.col("event_id") % 5).alias("completed"), F.lit(1).alias("seconds_sum"), (F.col("event_id") % 11).alias("seconds_max"))
    usage = F.array(F.struct(F.lit("a").alias("model"), F.lit(1).alias("n")), F.struct(F.lit("b").alias("model"), F.lit(2).alias("n")), F.struct(F.lit("b").alias("model"), F.lit(3).alias("n")))
    return rates.phase_totals(e).select("phase", "active", "completed", "seconds_max", provider.token_usage(usage, "b")["n"].alias("usage"))


@query("""WITH s AS (SELECT o_orderkey AS k, o_orderkey % 4 AS j, o_orderkey % 3 AS req FROM orders) SELECT k, CASE WHEN k % 7 = 0 THEN 'not_valid_contact' WHEN j = 3 THEN 'selected_index_invalid' WHEN j <> req THEN 'candidate_in_other_step' WHEN k % 5 = 0 THEN 'answer_names_other_step' END AS reason, CASE WHEN k % 7 > 0 AND j < 3 AND j = req AND k % 5 > 0 THEN j * 100 END AS contact_frame FROM s""")
def exact_frames(spark, sf_dir):
    k = F.col("o_orderkey")
    options = F.array(*[F.struct(F.lit(j).alias("media_index"), F.lit(str(j)).alias("subtask_id"), F.lit(j * 100).alias("source_frame")) for j in range(3)])
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), options.alias("candidates"), (k % 4).cast("int").alias("selected_index"), (k % 3).cast("string").alias("requested_step"), F.when(k % 5 == 0, "zz").otherwise((k % 3).cast("string")).alias("answered_step"), (k % 7 > 0).alias("says_valid"))
    return reuse.exact_frames(rows).select("k", "reason", big("contact_frame"))


@query("""WITH a AS (SELECT o_custkey AS uid, o_orderkey AS k, o_orderkey % 3 = 0 AS hidden, o_orderkey % 5 = 0 AS bad FROM orders) SELECT uid, count(*) AS selected, count(*) FILTER (NOT hidden AND NOT bad) AS grounded, count(*) FILTER (hidden OR bad) AS invisible, count(*) FILTER (NOT hidden AND bad) AS errors FROM a GROUP BY uid""")
def observation_boxes(spark, sf_dir):
    k = F.col("o_orderkey")
    a = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.lit("e").alias("event_id"), k.alias("sample"), k.alias("frame"), (k % 3 > 0).alias("target_visible"), F.array(F.lit(1.0), F.lit(2.0), F.when(k % 5 == 0, 0.0).otherwise(9.5), F.lit(9.0)).alias("bbox"))
    boxed = reuse.observation_boxes(a)
    errors = boxed.groupBy("uid").agg(F.count_if(F.col("error").isNotNull()).alias("errors"))
    return reuse.regrouped(boxed).select("uid", "selected", F.col("grounded").cast("bigint").alias("grounded"), F.col("invisible").cast("bigint").alias("invisible")).join(errors, "uid")


@query("""WITH e AS (SELECT o_custkey AS uid, o_orderkey AS k FROM orders) SELECT k, CASE WHEN k % 3 > 0 THEN (k % 90) || ',5,' || (k % 90 + 10) || ',15' END AS box FROM e""")
def seeded_events(spark, sf_dir):
    k = F.col("event_id")
    e = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), F.lit("s").alias("step_id"), F.col("o_orderkey").alias("event_id"))
    x = (k % 90).cast("double")
    said = e.where(k % 3 > 0).select("uid", "step_id", "event_id", F.array(x, F.lit(5.0), x + 10, F.lit(15.0)).alias("bbox"))
    return reuse.seed(e, said.unionByName(said), e.select("uid", "step_id").distinct())[0].select(k.alias("k"), F.array_join("box", ",").alias("box"))


@query("""WITH a AS (SELECT CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN ':view=l' ELSE '' END AS uid, c_custkey AS k FROM customer), n AS (SELECT uid, CAST(CASE WHEN k % 5 = 0 THEN 2 ELSE 0 END + CASE WHEN k % 3 > 0 AND k % 7 > 0 THEN 1 ELSE 0 END AS BIGINT) AS attempts FROM a WHERE k % 5 = 0 OR (k % 3 > 0 AND k % 7 > 0)) SELECT uid, attempts FROM n WHERE attempts >= 1""")
def attempt_counts(spark, sf_dir):
    k = F.col("c_custkey")
    a = table(spark, sf_dir, "customer").select(F.concat(k.cast("string"), F.when(k % 2 == 0, ":view=l").otherwise("")).alias("uid"), k.alias("k"))
    there = a.where("k % 3 > 0").select(F.col("k").cast("string").alias("uid"))
    counts = rates.finished_attempts(a.where("k % 5 = 0").select("uid", F.lit(2).alias("attempts")), a.select("uid"), there, a.where("k % 7 = 0").select("uid"))
    return reuse.exhausted(counts, 1)


@query("""WITH j AS (SELECT o_orderkey AS uid, o_orderkey % 3 > 0 AS ready FROM orders) SELECT uid, ready, CASE WHEN ready THEN 'ready' ELSE 'waiting' END AS state, NOT ready AND uid % 5 > 0 AS late FROM j""")
def deferred_jobs(spark, sf_dir):
    """Upstream rows that are there, what waits for the producer, and accepted work that is neither queued nor published."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"))
    there = o.where("uid % 3 > 0")
    _, waiting, _ = follow.waits(o, there, False)
    late = follow.late_publications(o, there, o.where("uid % 5 = 0"), key="uid").select("uid", F.lit(True).alias("late"))
    out = follow.ready_and_deferred(o, there).join(waiting.select("uid", F.lit("waiting").alias("state")), "uid", "left").join(late, "uid", "left")
    return out.select("uid", "ready", F.coalesce("state", F.lit("ready")).alias("state"), F.coalesce("late", F.lit(False)).alias("late"))


@query("SELECT event_id, event_id % 2 = 0 AND event_id % 3 > 0 AND event_id % 500 >= 40 AS drained FROM events")
def drained_outboxes(spark, sf_dir):
    k = F.col("event_id")
    s = table(spark, sf_dir, "events").select("event_id", (k % 500).cast("double").alias("updated_at"), (k % 2 == 0).alias("alive"), (k % 3 == 0).cast("int").alias("pending_files"), *[F.lit(0).alias(c) for c in ("pending_bytes", "accepted", "inflight")])
    return follow.outbox_drained(s, 100.0, max_age=60.0).select("event_id", "drained")


@query("SELECT p_partkey AS id, upper(p_name) AS rewritten FROM part")
def rewritten_lines(spark, sf_dir):
    """Chunks that come back with another count are halved until they do not."""

    def call(lines: list[str]) -> list[str]:
        return [x.upper() for x in lines] if len(lines) <= 5 else ["lost"]

    lines = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("line"))
    return provider.rewrite_in_batches(lines, call).select("id", "rewritten")


@query("""SELECT o_orderkey AS k, CASE WHEN o_orderkey % 6 = 0 THEN 'ecot_top_level_fields_invalid' WHEN o_orderkey % 6 = 1 THEN 'ecot_completion_judgment_missing' WHEN o_orderkey % 6 = 2 THEN 'ecot_subtask_not_single_goal' WHEN o_orderkey % 6 = 3 THEN 'ecot_privileged_context_leak:the video shows' WHEN o_orderkey % 6 = 4 THEN 'ecot_subtask_completion_mismatch' END AS error, CASE WHEN o_orderkey % 6 = 5 THEN 'move cup ' || o_orderkey || '.' END AS goal FROM orders""")
def parsed_reasoning(spark, sf_dir):
    k = F.col("o_orderkey")
    step = F.concat(F.lit('{"subtask":" Move  CUP '), k, F.when(k % 6 == 2, " then stop").otherwise(""), F.lit('","action":"Move","object":"cup","source":"None","target":"box"}'))
    value = F.concat(F.lit('{"scene_description":"'), F.when(k % 6 == 3, "As the video shows").otherwise("A table"), F.lit('","task_progress":"'), F.when(k % 6 == 1, "Half").when(k % 6 == 4, "Task complete.").otherwise("Half. Task not yet complete."), F.lit('","current_subtask":'), step, F.lit(',"atomic_action":"Move on"'), F.when(k % 6 == 0, ',"x":1').otherwise(""), F.lit("}"))
    return ecot.parse(table(spark, sf_dir, "orders").select(k.alias("k"), value.alias("value"))).select("k", "error", F.col("parsed.current_subtask.subtask").alias("goal"))


@query("""WITH t AS (SELECT o_orderkey AS k, o_orderkey % 4 AS m FROM orders) SELECT k, CASE m WHEN 0 THEN 'a' || k WHEN 1 THEN 's' || k WHEN 2 THEN 'z' || k END AS first, CASE WHEN m < 3 THEN CAST(1 AS BIGINT) END AS steps FROM t""")
def fenced_steps(spark, sf_dir):
    k = F.col("o_orderkey")
    named = lambda p: F.concat(F.lit('[{"n":"' + p), k, F.lit('"}]'))
    raw = F.when(k % 4 == 0, F.concat(F.lit("```json\n"), named("a"), F.lit("\n```"))).when(k % 4 == 1, F.concat(F.lit('{"subtasks":[],"steps":'), named("s"), F.lit("}"))).when(k % 4 == 2, F.concat(F.lit("  "), named("z"))).otherwise("[1, 2]")
    rows = table(spark, sf_dir, "orders").select(k.alias("k"), provider.fenced_steps(raw).alias("s"))
    return rows.select("k", F.get_json_object(F.get("s", F.lit(0)), "$.n").alias("first"), F.when(F.col("s").isNotNull(), F.size("s")).cast("bigint").alias("steps"))
