"""The registered queries of the library's own operators on the star-schema tables, and the SQL that gives the same rows.

Episodes are users, customers or conversations; steps, events and points are their rows.  Every query reads
its whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions import pyfuncs, scalar
from annolith.operators import events as ev
from annolith.operators import contracts, grids, inventory, lookup, points, provider, rates, records, reuse, sets, timeline

from .registry import ORACLES, QUERIES, query, table

def seconds(c: str = "ts") -> Column:
    return (F.unix_micros(F.col(c).cast("timestamp")) - 1704067200000000) / 1e6


SECONDS = "(epoch_us(ts) - 1704067200000000) / 1e6"


def user_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """uid, pos, t (seconds), event_id, event_type, value of the events, by user."""
    e = table(spark, sf_dir, "events")
    pos = F.row_number().over(W.partitionBy("user_id").orderBy("ts", "event_id"))
    return e.select(F.col("user_id").alias("uid"), pos.alias("pos"), seconds().alias("t"), "event_id", "event_type", "value")


USER_EVENTS = f"ue AS (SELECT user_id AS uid, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pos, {SECONDS} AS t, event_id, event_type, value FROM events)"


# Timeline


@query(f"""WITH {USER_EVENTS}, a AS (SELECT *, CASE WHEN event_type = lag(event_type) OVER w THEN 0 ELSE 1 END AS n FROM ue WINDOW w AS (PARTITION BY uid ORDER BY pos)),
b AS (SELECT *, sum(n) OVER (PARTITION BY uid ORDER BY pos) AS island FROM a), c AS (SELECT uid, island, min(pos) AS p, arg_min(event_type, pos) AS event_type, arg_max(t, pos) AS e, count(*) AS merged FROM b GROUP BY ALL)
SELECT uid, CAST(CASE WHEN max(merged) OVER (PARTITION BY uid) > 1 THEN island ELSE p END AS BIGINT) AS pos, event_type, round(e, 3) AS end_s, merged FROM c""")
def merge_adjacent(spark, sf_dir):
    steps = user_events(spark, sf_dir).select("uid", "pos", "event_type", F.col("t").alias("end_s"))
    return timeline.merge_adjacent(steps, signature=F.array("event_type")).select("uid", F.col("pos").cast("bigint").alias("pos"), "event_type", F.round("end_s", 3).alias("end_s"), "merged")


@query(f"WITH {USER_EVENTS}, a AS (SELECT uid, pos, t - lag(t) OVER (PARTITION BY uid ORDER BY pos) AS gap FROM ue) SELECT uid, pos, round(gap, 3) AS gap FROM a WHERE abs(gap) > 3600")
def contiguity_gaps(spark, sf_dir):
    steps = user_events(spark, sf_dir).select("uid", "pos", F.col("t").alias("start_s"), F.col("t").alias("end_s"))
    return timeline.contiguity(steps, tolerance=3600.0).where("NOT contiguous").select("uid", F.col("pos").cast("bigint").alias("pos"), F.round("gap", 3).alias("gap"))


@query(f"""WITH {USER_EVENTS}, a AS (SELECT uid, t, event_type, lead(t) OVER (PARTITION BY uid ORDER BY t, pos) AS n FROM ue), b AS (SELECT * FROM a WHERE n IS NULL OR n - t > 1e-6),
c AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY t) AS pos, lead(t) OVER (PARTITION BY uid ORDER BY t) AS nx FROM b)
SELECT uid, pos, event_type AS subtask, round(CASE WHEN pos = 1 THEN 0 ELSE t END, 3) AS start_s, round(coalesce(nx, 1e8), 3) AS end_s FROM c""")
def segment_to_steps(spark, sf_dir):
    e = user_events(spark, sf_dir)
    segments = e.select("uid", "pos", F.col("t").alias("start"), F.col("event_type").alias("description"), F.lit(None).cast("string").alias("skill"), F.lit(True).alias("has_video"), F.lit(0).alias("media_count"), F.lit(1e8).alias("duration"))
    out = timeline.segments_to_steps(segments)
    return out.select("uid", F.col("pos").cast("bigint").alias("pos"), "subtask", F.round("start_s", 3).alias("start_s"), F.round("end_s", 3).alias("end_s"))


@query("""WITH o AS (SELECT o_custkey AS uid, o_orderkey, o_totalprice / 97 AS duration FROM orders), n AS (SELECT *, CASE WHEN duration <= 300 THEN 1 ELSE greatest(2, ceil(duration / 295)) END AS k FROM o),
c AS (SELECT *, unnest(range(0, CAST(k AS BIGINT))) AS chunk FROM n) SELECT o_orderkey AS uid, chunk, CAST(floor(chunk * (duration / k) * 1000) AS BIGINT) AS start_ms FROM c""")
def chunk_ranges(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"), (F.col("o_totalprice") / 97).alias("duration"))
    return timeline.chunk_ranges(o).select("uid", F.col("chunk").cast("bigint").alias("chunk"), F.floor(F.col("start") * 1000).alias("start_ms"))


@query(f"""WITH {USER_EVENTS}, s AS (SELECT uid, pos, t / 3600 AS a, lead(t) OVER (PARTITION BY uid ORDER BY pos) / 3600 AS b FROM ue), g AS (SELECT uid, pos, b, unnest(range(CAST(greatest(0, ceil(a * 2 - 1e-9)) AS BIGINT), CAST(ceil(b * 2 - 1e-9) AS BIGINT))) AS anchor_frame FROM s WHERE b IS NOT NULL)
SELECT uid, pos, anchor_frame, anchor_frame / 2 AS anchor_s FROM g WHERE anchor_frame / 2 < b""")
def anchor_grid(spark, sf_dir):
    e = user_events(spark, sf_dir)
    end = F.lead("t").over(W.partitionBy("uid").orderBy("pos")) / 3600
    steps = e.select("uid", F.col("pos").cast("bigint").alias("pos"), (F.col("t") / 3600).alias("start_s"), end.alias("end_s"), F.lit(1e9).alias("duration")).where("end_s IS NOT NULL")
    return grids.anchors(steps).select("uid", "pos", F.col("anchor_frame").cast("bigint").alias("anchor_frame"), "anchor_s")


@query(f"""WITH {USER_EVENTS}, p AS (SELECT uid, t AS a, lead(t) OVER (PARTITION BY uid ORDER BY pos) AS b, row_number() OVER (PARTITION BY uid ORDER BY pos) AS k FROM ue WHERE event_type = 'purchase'),
i AS (SELECT * FROM p WHERE b IS NOT NULL), l AS (SELECT uid, max(k) AS last FROM i GROUP BY uid), j AS (SELECT e.event_id, i.k, row_number() OVER (PARTITION BY e.event_id ORDER BY i.k) AS r FROM ue e JOIN i USING (uid) JOIN l USING (uid)
WHERE e.event_type = 'error' AND e.t >= i.a AND (e.t < i.b OR (i.k = l.last AND e.t = i.b))) SELECT event_id, k AS pos FROM j WHERE r = 1""")
def point_in_interval(spark, sf_dir):
    e = user_events(spark, sf_dir)
    by = W.partitionBy("uid").orderBy("pos")
    spans = e.where("event_type = 'purchase'").select("uid", F.col("t").alias("start_s"), F.lead("t").over(by).alias("end_s"), F.row_number().over(by).alias("pos")).where("end_s IS NOT NULL")
    hit = timeline.points_in_intervals(e.where("event_type = 'error'").select("uid", "event_id", "t"), spans, width=6 * 3600.0)
    return hit.select("event_id", F.col("pos").cast("bigint").alias("pos"))


@query("""WITH s AS (SELECT conv_id AS uid, turn AS pos, lower(trim(regexp_replace(role, '\\s+', ' ', 'g'))) AS k FROM conversations), a AS (SELECT uid, CASE WHEN k = lag(k) OVER (PARTITION BY uid ORDER BY pos) THEN 1 ELSE 0 END AS d FROM s)
SELECT uid, CAST(sum(d) AS BIGINT) AS adjacent_identical FROM a GROUP BY uid""")
def adjacent_duplicates(spark, sf_dir):
    c = table(spark, sf_dir, "conversations")
    steps = c.select(F.col("conv_id").alias("uid"), F.col("turn").alias("pos"), F.col("role").alias("subtask"), *[F.lit("None").alias(f) for f in timeline.SEMANTIC[1:]])
    return timeline.adjacent_duplicates(steps)


# Events


@query(f"WITH {USER_EVENTS} SELECT e.event_id, round(max(p.t), 3) AS previous_t FROM ue e LEFT JOIN ue p ON p.uid = e.uid AND p.event_type = 'purchase' AND p.t < e.t - 1e-6 WHERE e.event_type = 'error' GROUP BY e.event_id")
def previous_event_asof(spark, sf_dir):
    e = user_events(spark, sf_dir)
    return ev.previous_event(e, condition=F.col("event_type") == "purchase").where("event_type = 'error'").select("event_id", F.round("previous_t", 3).alias("previous_t"))


@query(f"""WITH {USER_EVENTS}, b AS (SELECT uid, CAST(floor(min(t) / 3600) AS BIGINT) AS a, CAST(floor(max(t) / 3600) AS BIGINT) AS z FROM ue GROUP BY uid), c AS (SELECT uid, unnest(range(a, z + 1)) AS frame FROM b)
SELECT uid, frame FROM c ANTI JOIN (SELECT DISTINCT uid, CAST(floor(t / 3600) AS BIGINT) AS frame FROM ue) USING (uid, frame)""")
def eligible_not_contact(spark, sf_dir):
    contacts = user_events(spark, sf_dir).select("uid", F.floor(F.col("t") / 3600).alias("frame"))
    ends = contacts.groupBy("uid").agg(F.min("frame").alias("a"), F.max("frame").alias("z"))
    candidates = ends.select("uid", F.explode(F.sequence("a", "z")).alias("frame"))
    return ev.without_contacts(candidates, contacts)


def _proposals(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    pos = F.row_number().over(W.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey"))
    return o.select(
        F.col("o_custkey").alias("uid"), F.col("o_orderstatus").alias("step_id"), pos.alias("pos"), F.col("o_orderkey").cast("string").alias("event_id"), F.col("o_totalprice").alias("contact_time_seconds"), F.lit(None).cast("int").alias("contact_media_index"),
        F.col("o_orderpriority").alias("agent_role"), F.col("o_orderstatus").alias("object_name"), F.lit("ship").alias("contact_verb"),
    )


def _reviews(spark, sf_dir):
    o, l = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    a = l.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("q"), F.min("l_returnflag").alias("flag"))
    both = o.join(a, "o_orderkey").withColumn("pos", F.row_number().over(W.partitionBy("o_custkey", "o_orderstatus").orderBy("o_orderkey")))
    return both.select(
        F.col("o_custkey").alias("uid"), F.col("o_orderstatus").alias("step_id"), "pos", F.when(F.col("o_orderkey") % 7 > 0, F.col("o_orderkey").cast("string")).otherwise(F.concat(F.lit("new-"), "o_orderkey")).alias("event_id"),
        (F.col("q") > 50).alias("accepted"), (F.col("n") >= 3).alias("valid_contact"), F.when(F.col("q") % 5 > 0, F.col("q").cast("double")).alias("contact_time_seconds"),
        F.lit(None).cast("int").alias("contact_media_index"), F.when(F.col("flag") != "R", F.col("flag")).alias("agent_role"), F.lit(None).cast("string").alias("object_name"), F.when(F.col("n") > 4, "pack").alias("contact_verb"),
    )


ALIGN = """p AS (SELECT o_custkey AS uid, o_orderstatus AS step_id, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS pos, CAST(o_orderkey AS VARCHAR) AS event_id, o_totalprice AS t, o_orderpriority AS agent_role, o_orderstatus AS object_name, 'ship' AS contact_verb FROM orders),
a AS (SELECT l_orderkey AS o_orderkey, count(*) AS n, sum(CAST(l_quantity AS BIGINT)) AS q, min(l_returnflag) AS flag FROM lineitem GROUP BY 1),
r AS (SELECT o_custkey AS uid, o_orderstatus AS step_id, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) AS pos, CASE WHEN o_orderkey % 7 > 0 THEN CAST(o_orderkey AS VARCHAR) ELSE 'new-' || o_orderkey END AS event_id, q > 50 AS accepted, n >= 3 AS valid_contact,
 CASE WHEN q % 5 > 0 THEN CAST(q AS DOUBLE) END AS t, CASE WHEN flag <> 'R' THEN flag END AS agent_role, CAST(NULL AS VARCHAR) AS object_name, CASE WHEN n > 4 THEN 'pack' END AS contact_verb FROM orders JOIN a USING (o_orderkey)),
m AS (SELECT r.*, i.event_id IS NULL AND l.event_id IS NOT NULL AS by_place, coalesce(i.event_id, l.event_id) AS p_id, coalesce(i.t, l.t) AS p_t, coalesce(i.agent_role, l.agent_role) AS p_role, coalesce(i.object_name, l.object_name) AS p_object, coalesce(i.contact_verb, l.contact_verb) AS p_verb
 FROM r LEFT JOIN p i ON r.uid = i.uid AND r.step_id = i.step_id AND r.event_id = i.event_id LEFT JOIN p l ON r.uid = l.uid AND r.step_id = l.step_id AND r.pos = l.pos)"""


@query(f"""WITH {ALIGN}, f AS (SELECT *, coalesce(accepted AND valid_contact, false) AND t IS NOT NULL AS ok FROM m)
SELECT uid, step_id, pos, CASE WHEN ok THEN event_id ELSE coalesce(p_id, event_id) END AS event_id, CASE WHEN ok THEN 'accepted' ELSE 'rejected' END AS verdict, CASE WHEN ok THEN t ELSE coalesce(p_t, t) END AS contact_time_seconds,
 CASE WHEN ok AND p_id IS DISTINCT FROM event_id THEN p_id END AS proposed_event_id, coalesce(agent_role, p_role) AS agent_role, coalesce(contact_verb, p_verb) AS contact_verb, by_place FROM f
UNION ALL SELECT uid, step_id, pos, event_id, 'unreviewed', t, NULL, agent_role, contact_verb, false FROM p WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.uid = p.uid AND m.step_id = p.step_id AND (m.event_id = p.event_id OR m.p_id = p.event_id))""")
def align_proposal_review(spark, sf_dir):
    out = ev.align(_proposals(spark, sf_dir), _reviews(spark, sf_dir))
    return out.select("uid", "step_id", F.col("pos").cast("bigint").alias("pos"), "event_id", "verdict", "contact_time_seconds", "proposed_event_id", "agent_role", "contact_verb", "by_place")


@query(f"""WITH {ALIGN} SELECT uid, step_id, event_id, coalesce(t, p_t) AS contact_time_seconds, coalesce(agent_role, p_role) AS agent_role, coalesce(object_name, p_object) AS object_name, coalesce(contact_verb, p_verb) AS contact_verb,
 concat_ws(',', CASE WHEN t IS NULL AND p_t IS NOT NULL THEN 'contact_time_seconds' END, CASE WHEN agent_role IS NULL AND p_role IS NOT NULL THEN 'agent_role' END, CASE WHEN object_name IS NULL AND p_object IS NOT NULL THEN 'object_name' END, CASE WHEN contact_verb IS NULL AND p_verb IS NOT NULL THEN 'contact_verb' END) AS inherited FROM m""")
def inherit_missing(spark, sf_dir):
    out = ev.inherit_missing(_reviews(spark, sf_dir), _proposals(spark, sf_dir))
    return out.select("uid", "step_id", "event_id", "contact_time_seconds", "agent_role", "object_name", "contact_verb", F.array_join("inherited", ",").alias("inherited"))


@query(f"""WITH {ALIGN}, x AS (SELECT coalesce(p.uid, r.uid) AS uid, coalesce(p.step_id, r.step_id) AS step_id, coalesce(p.event_id, r.event_id) AS event_id, CASE WHEN p.uid IS NULL OR r.uid IS NULL THEN 'event_set_mismatch' WHEN abs(p.t - r.t) > 1e-6 OR (p.t IS NULL) <> (r.t IS NULL) THEN 'contact_time_mismatch' END AS error
 FROM p FULL OUTER JOIN r ON p.uid = r.uid AND p.step_id = r.step_id AND p.event_id = r.event_id) SELECT error, count(*) AS n FROM x WHERE error IS NOT NULL GROUP BY error""")
def identity_errors(spark, sf_dir):
    return ev.identity_errors(_proposals(spark, sf_dir), _reviews(spark, sf_dir), exact=()).groupBy("error").agg(F.count("*").alias("n"))


def _contacts(spark, sf_dir):
    e = user_events(spark, sf_dir).where("event_type IN ('purchase', 'error')")
    frames = F.col("t") / 60
    return e.select("uid", F.col("pos").cast("bigint").alias("pos"), F.col("event_id").cast("string").alias("event_id"), frames.alias("t"), F.lit(None).cast("int").alias("contact_frame"), F.lit(1.0).alias("fps"), F.lit(1 << 30).alias("frame_count"), F.lit(0.0).alias("step_start_s"), F.lit(1e9).alias("step_end_s"), F.lit("1").alias("step_id"))


@query(f"""WITH {USER_EVENTS}, c AS (SELECT uid, event_id, t / 60 AS t FROM ue WHERE event_type IN ('purchase', 'error')), p AS (SELECT a.uid, a.event_id, a.t, max(b.t) AS pt FROM c a LEFT JOIN c b ON a.uid = b.uid AND b.t < a.t - 1e-6 GROUP BY ALL),
f AS (SELECT *, CAST(greatest(0, round_even(t, 0)) AS BIGINT) AS frame FROM p) SELECT event_id, CAST(greatest(0, ceil(t - 600 - 1e-9), coalesce(floor(pt + 1e-9) + 1, 0)) AS BIGINT) AS first_frame, CAST(least(frame - 1, floor(t + 1e-9)) AS BIGINT) AS last_frame, round(pt, 4) AS previous_t FROM f""")
def observation_intervals(spark, sf_dir):
    out = ev.observation_intervals(_contacts(spark, sf_dir), lookback=600.0)
    return out.select(F.col("event_id").cast("bigint").alias("event_id"), F.col("first_frame").cast("bigint").alias("first_frame"), F.col("last_frame").cast("bigint").alias("last_frame"), F.round("previous_t", 4).alias("previous_t"))


@query()
def observation_sample(spark, sf_dir):
    """Seeded with Python's generator, which SQL does not have."""
    out = ev.observations(ev.observation_intervals(_contacts(spark, sf_dir), lookback=600.0), count=3, seed=7)
    return out.select("event_id", "eligible", F.array_join("sampled", ",").alias("sampled"))


# Lookups, sets and partitions


@query("""WITH i AS (SELECT s_name AS alias, CAST(s_nationkey AS VARCHAR) AS v FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR) FROM supplier), t AS (SELECT alias, min(v) AS v FROM i GROUP BY alias),
p AS (SELECT p_partkey AS uid, 'Supplier#' || lpad(CAST(p_partkey % 150 AS VARCHAR), 9, '0') AS a, CAST(p_partkey % 3000 AS VARCHAR) AS b FROM part)
SELECT uid, coalesce(x.v, y.v) AS nation, CASE WHEN x.v IS NOT NULL THEN 0 WHEN y.v IS NOT NULL THEN 1 END AS priority FROM p LEFT JOIN t x ON x.alias = a LEFT JOIN t y ON y.alias = b""")
def multi_key_lookup(spark, sf_dir):
    none = F.lit(None).cast("string")
    s = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("uid"), F.col("s_suppkey").cast("string").alias("source_uid"), none.alias("path"), F.col("s_nationkey").cast("string").alias("nation"))
    p = table(spark, sf_dir, "part")
    probes = p.select(F.concat(F.lit("Supplier#"), F.lpad((F.col("p_partkey") % 150).cast("string"), 9, "0")).alias("uid"), (F.col("p_partkey") % 3000).cast("string").alias("source_uid"), none.alias("path"), F.col("p_partkey").alias("part"))
    return lookup.multi_key_lookup(lookup.aliases(probes), lookup.aliases(s), "nation", uid="part").select(F.col("part").alias("uid"), "nation", "priority")


@query("""WITH c AS (SELECT doc_id, 'quality' AS task FROM labels WHERE quality = 1 UNION ALL SELECT doc_id, 'toxic' FROM labels), n AS (SELECT doc_id, unnest(['quality', 'toxic']) AS task FROM documents) SELECT doc_id, task FROM n ANTI JOIN c USING (doc_id, task)""")
def resume_needed(spark, sf_dir):
    l = table(spark, sf_dir, "labels")
    done = l.where("quality = 1").select("doc_id", F.lit("quality").alias("task")).unionByName(l.select("doc_id", F.lit("toxic").alias("task")))
    return lookup.needed(table(spark, sf_dir, "documents"), ["quality", "toxic"], done, uid="doc_id")


@query("SELECT min(doc_id) AS doc_id, sha256(text) AS text_sha256 FROM documents GROUP BY text")
def keep_first(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("text_sha256"))
    return sets.keep_first(d, "text_sha256", "doc_id")


@query("SELECT sha256(text) AS text_sha256, count(*) AS n FROM documents GROUP BY text HAVING min(source) <> max(source)")
def conflict_union(spark, sf_dir):
    return sets.conflicts(table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("text_sha256"), "source"), "text_sha256", "source")


@query("""SELECT c_custkey AS uid FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F') AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AND c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey <= 2)""")
def eligible_pending(spark, sf_dir):
    c, o, n = (table(spark, sf_dir, t) for t in ("customer", "orders", "nation"))
    text = F.col("c_custkey").cast("string")
    master = c.select(text.alias("uid"), F.col("c_custkey").alias("pos"))
    there = c.join(n.where("n_regionkey <= 2"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select(text.alias("uid"))
    gone = lambda condition: o.where(condition).select(F.col("o_custkey").cast("string").alias("uid"))
    return sets.eligible(master, there, gone("o_orderstatus = 'F'"), gone("o_orderpriority = '1-URGENT'")).select(F.col("pos").alias("uid"))


SLOTS = "h AS (SELECT doc_id, CAST(CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), 1, 16) AS UBIGINT) % 16 AS INTEGER) AS slot FROM documents)"


@query(f"WITH {SLOTS}, r AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY doc_id) AS n FROM h) SELECT doc_id, slot FROM r WHERE n <= 40")
def hash_slots(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("uid"), F.col("doc_id").alias("pos"))
    return sets.slotted(d, 16, cap=40).select(F.col("pos").alias("doc_id"), "slot")


@query(f"WITH {SLOTS} SELECT slot, count(*) AS n, count(DISTINCT doc_id) AS uids, 0 AS errors FROM h GROUP BY slot")
def partition_cover(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("uid"), F.col("doc_id").alias("pos"))
    parts = sets.slotted(d, 16)
    errors = sets.cover_errors(parts, d).agg(F.count("*").cast("int").alias("errors"))
    return parts.groupBy("slot").agg(F.count("*").alias("n"), F.count_distinct("uid").alias("uids")).join(F.broadcast(errors))  # one row


@query("WITH r AS (SELECT l_suppkey AS slot, count(*) AS remaining FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 10) AND l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O') GROUP BY 1) SELECT slot, remaining FROM r ORDER BY remaining DESC, slot DESC LIMIT 1")
def top_donor(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "part").where("p_size > 10"), F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    left = sets.remaining(l.select(F.col("l_orderkey").alias("uid"), F.col("l_suppkey").alias("slot")), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid")), table(spark, sf_dir, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("uid")))
    return sets.top_donor(left)


@query("WITH i AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_suppkey) - 1 AS i, count(*) OVER () AS n FROM supplier) SELECT s_suppkey FROM i WHERE i IN (SELECT (k * n) // 7 FROM (SELECT unnest(range(0, 7)) AS k), (SELECT count(*) AS n FROM supplier))")
def even_pick(spark, sf_dir):
    return sets.even_pick(table(spark, sf_dir, "supplier").select("s_suppkey"), 7, order="s_suppkey")


@query()
def duration_split(spark, sf_dir):
    """Longest first, which is sequential and not for SQL."""
    l = table(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("uid")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("size"))
    return sets.longest_first_split(l, ["a", "b", "c", "d"])


@query("""WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (ORDER BY c_custkey) - 1 AS i FROM customer), b AS (SELECT *, i // 64 AS k FROM r), f AS (SELECT k, arg_min(c_mktsegment, i) AS batch_source_key FROM b GROUP BY k)
SELECT c_custkey, 'manifest-' || lpad(CAST(k AS VARCHAR), 6, '0') AS batch, batch_source_key FROM b JOIN f USING (k) WHERE c_mktsegment <> 'BUILDING'""")
def batches_before_filter(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("source_key"))
    out = sets.labelled_batches(c, 64, order="c_custkey")
    first = out.groupBy("batch").agg(F.min_by("source_key", "row_index").alias("batch_source_key"))
    return out.join(first, "batch").where("source_key <> 'BUILDING'").select("c_custkey", "batch", "batch_source_key")


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL), e AS (SELECT o_orderkey AS l_orderkey, unnest([1, 2, 3]) AS l_linenumber FROM orders), j AS (SELECT CASE WHEN a.n IS NULL THEN 'missing' WHEN e.l_orderkey IS NULL THEN 'unexpected' WHEN a.n > 1 THEN 'duplicate' END AS error
FROM a FULL OUTER JOIN e ON a.l_orderkey = e.l_orderkey AND a.l_linenumber = e.l_linenumber) SELECT error, count(*) AS n FROM j WHERE error IS NOT NULL GROUP BY error""")
def coverage(spark, sf_dir):
    expected = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))).alias("l_linenumber"))
    return sets.coverage_errors(table(spark, sf_dir, "lineitem"), expected, ["l_orderkey", "l_linenumber"]).groupBy("error").agg(F.count("*").alias("n"))


@query("SELECT DISTINCT o_custkey AS uid FROM orders WHERE o_orderstatus = 'F' UNION SELECT c_custkey FROM customer WHERE c_acctbal < 0")
def ledger_union(spark, sf_dir):
    return sets.ledger_union(table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("uid")), table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("uid")))


# Audits and contracts


def _checked_documents(spark, sf_dir):
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = d.join(l, "doc_id", "left")
    checks = (("short_text", F.length("text") < 200), ("unlabelled", F.col("quality").isNull()), ("low_quality", F.col("quality") == 0), ("wrong_length", F.col("n_chars") != F.length("text")))
    return joined.select(F.col("doc_id").alias("uid"), F.col("source").alias("source_key"), F.lit(False).alias("corrupt"), F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in checks])).alias("failures"))


@query("""WITH j AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id)), f AS (SELECT 'short_text' AS key FROM j WHERE length(text) < 200 UNION ALL SELECT 'unlabelled' FROM j WHERE quality IS NULL UNION ALL SELECT 'low_quality' FROM j WHERE quality = 0 UNION ALL SELECT 'wrong_length' FROM j WHERE n_chars <> length(text))
SELECT 'records' AS figure, '' AS key, count(*) AS n FROM documents UNION ALL SELECT 'unique_uids', '', count(DISTINCT doc_id) FROM documents UNION ALL SELECT 'source', source, count(*) FROM documents GROUP BY source UNION ALL SELECT 'failure', key, count(*) FROM f GROUP BY key
UNION ALL SELECT 'failure', k, 1 FROM (SELECT unnest(['unexpected_record_count', 'unexpected_unique_uid_count']) AS k) WHERE (SELECT count(*) FROM documents) <> 1000""")
def stage_audit(spark, sf_dir):
    rows = _checked_documents(spark, sf_dir).withColumn("uid", F.col("uid").cast("string"))
    return records.audit_summary(rows, expected=1000).select("figure", "key", "n")


# Rates


@query(f"""WITH e AS (SELECT event_id, event_type, {SECONDS} AS t FROM events) SELECT event_id, count(*) OVER w AS in_window, round(count(*) OVER w * 60 / 900.0, 6) AS per_minute FROM e WINDOW w AS (PARTITION BY event_type ORDER BY t RANGE BETWEEN 900 PRECEDING AND CURRENT ROW)""")
def trailing_rate(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "event_type", seconds().alias("t"))
    return rates.events_per_minute(e, key="event_type", time="t").select("event_id", "in_window", F.round("per_minute", 6).alias("per_minute"))


@query(f"""WITH {USER_EVENTS}, c AS (SELECT uid, event_id, t, count(*) OVER (PARTITION BY uid ORDER BY t RANGE BETWEEN 86400 PRECEDING AND CURRENT ROW) AS in_window FROM ue WHERE event_type = 'error') SELECT event_id, in_window, max(in_window >= 3) OVER (PARTITION BY uid ORDER BY t RANGE UNBOUNDED PRECEDING) AS conservative FROM c""")
def burst_sticky(spark, sf_dir):
    e = user_events(spark, sf_dir).where("event_type = 'error'").select("uid", "event_id", "t")
    return rates.sticky_burst(e, 3, key="uid", time="t", seconds=86400).select("event_id", "in_window", "conservative")


@query(f"""WITH {USER_EVENTS}, r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY event_id DESC) AS k FROM ue) SELECT event_type, round(quantile_cont(value, 0.5), 4) AS median, count(*) AS n FROM r WHERE k <= 500 GROUP BY event_type""")
def recent_median(spark, sf_dir):
    e = user_events(spark, sf_dir)
    return rates.recent_median(e, key="event_type", order="event_id", value="value", last=500).select("event_type", F.round("median", 4).alias("median"), "n")


@query(f"""WITH {USER_EVENTS}, c AS (SELECT uid, t, sum(CAST(event_id % 5 AS BIGINT)) OVER (PARTITION BY uid, CAST(floor(t / 400000) AS BIGINT) ORDER BY pos) AS units, CAST(floor(t / 400000) AS BIGINT) AS pid, event_id FROM ue)
SELECT event_id, round(t - first_value(t) OVER w, 3) AS window_seconds, CASE WHEN t - first_value(t) OVER w >= 60 THEN round((units - first_value(units) OVER w) * 60 / (t - first_value(t) OVER w), 6) END AS rate_per_minute FROM c WINDOW w AS (PARTITION BY uid, pid ORDER BY t RANGE BETWEEN 90000 PRECEDING AND CURRENT ROW)""")
def durable_rate(spark, sf_dir):
    e = user_events(spark, sf_dir).withColumn("pid", F.floor(F.col("t") / 400000))
    e = e.withColumn("units", F.sum(F.col("event_id") % 5).over(W.partitionBy("uid", "pid").orderBy("pos")))
    out = rates.trailing_rate(e, key="uid", time="t", value="units", pid="pid", seconds=90000, least=60)
    return out.select("event_id", F.round("window_seconds", 3).alias("window_seconds"), F.round("rate_per_minute", 6).alias("rate_per_minute"))


# Text and scalars


@query("SELECT event_id, CAST(props->>'$.k' AS BIGINT) AS k FROM events")
def first_json_object(spark, sf_dir):
    """The object of an answer with text and a fence around it."""
    e = table(spark, sf_dir, "events").select("event_id", F.concat(F.lit("Answer:\n```json\n"), "props", F.lit("\n```\nand more {")).alias("raw"))
    return e.select("event_id", F.get_json_object(pyfuncs.first_json_object("raw"), "$.k").cast("bigint").alias("k"))


@query("SELECT doc_id, sha256(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS text_sha256 FROM documents")
def text_normalise(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(scalar.collapse("text"), 256).alias("text_sha256"))


@query("""WITH t AS (SELECT p_partkey, CASE WHEN p_size > 25 THEN NULL ELSE repeat(p_name || ' ', p_size) END AS d, p_brand || '  ' || p_type AS n FROM part), c AS (SELECT p_partkey, trim(regexp_replace(coalesce(d, ''), '\\s+', ' ', 'g')) AS d, trim(regexp_replace(n, '\\s+', ' ', 'g')) AS n FROM t)
SELECT p_partkey, CASE WHEN length(d) BETWEEN 1 AND 80 THEN d WHEN length(n) BETWEEN 1 AND 80 THEN n WHEN d <> '' THEN trim(substr(d, 1, 80)) ELSE trim(substr(n, 1, 80)) END AS task_name FROM c""")
def name_choice(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    d = F.when(F.col("p_size") <= 25, F.expr("repeat(p_name || ' ', p_size)"))
    return p.select("p_partkey", scalar.task_name(d, F.concat("p_brand", F.lit("  "), "p_type")).alias("task_name"))


@query("SELECT c_custkey, lower(replace(c_mktsegment, '_', ' ')) || ' ' || lower(regexp_replace(c_name, '#', ' ')) AS event_name, round_even(c_acctbal, 0) AS half_even FROM customer")
def scalar_library(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return c.select("c_custkey", scalar.event_name(scalar.skill_words("c_mktsegment"), F.lower(F.regexp_replace("c_name", "#", " "))).alias("event_name"), scalar.half_even("c_acctbal").alias("half_even"))


BOXES = "b AS (SELECT l_orderkey, l_linenumber, l_partkey % 1100 - 50.0 AS x1, l_suppkey % 900 + 0.5 AS y1, l_partkey % 1100 - 50.0 + l_quantity * 4 AS x2, l_suppkey % 900 + 0.5 + l_quantity AS y2 FROM lineitem)"


@query(f"""WITH {BOXES}, r AS (SELECT l_orderkey, l_linenumber, round_even(x1, 0) AS a, round_even(y1, 0) AS b, round_even(x2, 0) AS c, round_even(y2, 0) AS d FROM b) SELECT l_orderkey, l_linenumber, a >= 0 AND a < c AND c <= 1000 AND b >= 0 AND b < d AND d <= 1000 AS valid,
CASE WHEN a >= 0 AND a < c AND c <= 1000 AND b >= 0 AND b < d AND d <= 1000 THEN concat_ws(',', CAST(round_even((a + c) / 2, 0) AS BIGINT), CAST(round_even((b + d) / 2, 0) AS BIGINT)) END AS center FROM r""")
def boxes(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    x, y = F.col("l_partkey") % 1100 - F.lit(50.0), F.col("l_suppkey") % 900 + F.lit(0.5)
    box = F.array(x, y, x + F.col("l_quantity") * 4, y + F.col("l_quantity"))
    rows = l.select("l_orderkey", "l_linenumber", scalar.rounded_box(box).alias("box"))
    return rows.select("l_orderkey", "l_linenumber", F.col("box").isNotNull().alias("valid"), F.when(F.col("box").isNotNull(), F.array_join(scalar.box_center("box"), ",")).alias("center"))


# Frames and points


@query("""WITH e AS (SELECT o_orderkey AS uid, o_totalprice / 5000 AS duration, 10 + o_orderkey % 25 AS fps FROM orders), s AS (SELECT *, CAST(floor(duration * fps) AS BIGINT) + 1 AS n, CAST(greatest(1, floor(duration * 0.5 + 0.5)) * 4 AS BIGINT) AS k FROM e), x AS (SELECT *, unnest(range(0, k, 4)) AS f FROM s)
SELECT uid, f AS sampled_frame, least(n - 1, CAST(round_even(f / 2 * fps, 0) AS BIGINT)) AS source_frame, CAST(round_even(f / 2 * 0.5, 0) AS BIGINT) AS teacher_frame FROM x""")
def sampled_frames(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("uid"), (F.col("o_totalprice") / 5000).alias("duration"), (10 + F.col("o_orderkey") % 25).cast("double").alias("source_fps"))
    o = o.withColumn("source_frames", (F.floor(F.col("duration") * F.col("source_fps")) + 1).cast("int"))
    return grids.sampled_frames(o).select("uid", *[F.col(c).cast("bigint").alias(c) for c in ("sampled_frame", "source_frame", "teacher_frame")])


@query(f"""WITH {USER_EVENTS}, w AS (SELECT uid, event_id, list(event_id) OVER (PARTITION BY uid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 11 FOLLOWING) AS l FROM ue) SELECT event_id, 12 - len(l) AS padding, array_to_string(l, ',') AS window_ids FROM w""")
def first_frames_window(spark, sf_dir):
    e = user_events(spark, sf_dir)
    return grids.following(e, key="uid", order=["pos"], value="event_id").select("event_id", F.col("padding").cast("bigint").alias("padding"), F.array_join("window", ",").alias("window_ids"))


@query("""WITH q AS (SELECT o_orderkey, o_orderkey % 400 AS q, 5 + (o_orderkey % 250) / 10 AS fps FROM orders), n AS (SELECT *, CAST(floor(q * 5 / fps) AS BIGINT) AS n FROM q) SELECT o_orderkey, array_to_string([CAST(q - round_even((n - k) * fps / 5, 0) AS BIGINT) FOR k IN range(0, n + 1)], ',') AS frames FROM n""")
def history_lattice(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 400).cast("int").alias("q"), (5 + (F.col("o_orderkey") % 250) / 10).alias("fps"))
    return o.select("o_orderkey", F.array_join(grids.history_lattice(F.lit(0), F.col("q"), F.col("fps")), ",").alias("frames"))


@query()
def bounded_frames(spark, sf_dir):
    """numpy's even spacing with Python's rounding; held against a plain loop in the tests."""
    o = table(spark, sf_dir, "orders")
    events_ = o.select("o_orderkey", (F.col("o_totalprice") / 1000).alias("t"), F.lit(30.0).alias("fps"), F.lit(20000).alias("frame_count"), F.array(F.col("o_totalprice") / 1000 - 0.3, F.col("o_totalprice") / 1000 + 0.2).alias("boundaries"))
    return grids.contact_candidates(events_).select("o_orderkey", F.array_join("candidates", ",").alias("candidates"))


def _point_pairs(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    grid = lambda c, k: (F.col(c) * k % 1001).cast("double")
    return l.select(F.col("l_orderkey").alias("uid"), F.col("l_suppkey").cast("string").alias("event_id"), F.col("l_linenumber").alias("pair_index"), F.when(F.col("l_partkey") % 11 > 0, F.array(grid("l_partkey", 7), grid("l_partkey", 3))).alias("h_xy"), F.array(grid("l_suppkey", 13), grid("l_partkey", 5)).alias("o_xy"))


PAIRS = "pp AS (SELECT l_orderkey AS uid, CAST(l_suppkey AS VARCHAR) AS event_id, l_linenumber AS pair_index, CASE WHEN l_partkey % 11 > 0 THEN [l_partkey * 7 % 1001, l_partkey * 3 % 1001] END AS h, [l_suppkey * 13 % 1001, l_partkey * 5 % 1001] AS o FROM lineitem)"


@query(f"""WITH {PAIRS}, r AS (SELECT uid, event_id, 'H' || pair_index AS point_id, 'contact_agent' AS role, h AS xy FROM pp WHERE h IS NOT NULL UNION ALL SELECT uid, event_id, 'O' || pair_index, 'contacted_object', o FROM pp), n AS (SELECT uid, event_id, point_id, count(*) AS n FROM r GROUP BY ALL)
SELECT r.uid, r.event_id, r.point_id, role, CAST(xy[1] AS BIGINT) AS x, CAST(xy[2] AS BIGINT) AS y, CASE WHEN n > 1 THEN 'duplicate_point' END AS error FROM r JOIN n USING (uid, event_id, point_id)""")
def unpivot_points(spark, sf_dir):
    rows = points.point_rows(_point_pairs(spark, sf_dir))
    return rows.select("uid", "event_id", "point_id", "role", F.get("xy", F.lit(0)).cast("bigint").alias("x"), F.get("xy", F.lit(1)).cast("bigint").alias("y"), "error")


@query(f"""WITH {PAIRS} SELECT uid, event_id, pair_index, max(CASE WHEN h IS NOT NULL THEN lpad(CAST(h[1] AS VARCHAR), 4, '0') || ',' || lpad(CAST(h[2] AS VARCHAR), 4, '0') END) AS h, max(lpad(CAST(o[1] AS VARCHAR), 4, '0') || ',' || lpad(CAST(o[2] AS VARCHAR), 4, '0')) AS o FROM pp GROUP BY ALL""")
def pivot_points(spark, sf_dir):
    back = points.pair_rows(points.point_rows(_point_pairs(spark, sf_dir)))
    text = lambda c: F.when(F.col(c).isNotNull(), F.array_join(F.transform(c, lambda v: F.lpad(v.cast("bigint").cast("string"), 4, "0")), ","))
    return back.select("uid", "event_id", "pair_index", text("h_xy").alias("h"), text("o_xy").alias("o"))


@query(f"""WITH {PAIRS}, d AS (SELECT DISTINCT uid, event_id, pair_index FROM pp) SELECT uid, event_id, pair_index, concat_ws(',', CASE WHEN h IS NULL THEN 'H_missing_or_rejected_at_contact' END, CASE WHEN uid % 5 = 0 THEN 'H_contact_review_failed' END, CASE WHEN uid % 9 = 0 THEN 'O_contact_review_failed' END) AS reasons FROM pp""")
def pair_gate(spark, sf_dir):
    pairs = _point_pairs(spark, sf_dir)
    one = pairs.select("uid", "event_id", "pair_index").distinct()
    say = lambda p, ok: one.select("uid", "event_id", F.concat(F.lit(p), "pair_index").alias("point_id"), ok.alias("accepted"))
    decisions = say("H", F.col("uid") % 5 != 0).unionByName(say("O", F.col("uid") % 9 != 0))
    return points.contact_gate(pairs, decisions).select("uid", "event_id", "pair_index", F.array_join("reasons", ",").alias("reasons"))


@query("WITH o AS (SELECT DISTINCT l_suppkey, l_orderkey % 4 AS pos FROM lineitem) SELECT x.l_suppkey, x.pos AS a, y.pos AS b FROM o x JOIN o y ON x.l_suppkey = y.l_suppkey AND x.pos < y.pos")
def all_pairs(spark, sf_dir):
    o = table(spark, sf_dir, "lineitem").select("l_suppkey", (F.col("l_orderkey") % 4).alias("pos")).distinct()
    return inventory.all_pairs(o, keys=("l_suppkey",))


@query("""WITH o AS (SELECT p_brand, p_type, p_partkey % 40 AS frame, p_partkey, p_name, p_size FROM part), k AS (SELECT *, row_number() OVER (PARTITION BY p_brand, frame ORDER BY p_partkey) AS pos, count(*) OVER (PARTITION BY p_brand, frame) AS n FROM o)
SELECT p_partkey, CASE WHEN n > 4 THEN 'error' WHEN p_size % 3 = 0 THEN 'filtered' WHEN regexp_matches(lower(p_name), '(^|[^a-z0-9])(arm|arms|background|counter|counters|desk|desks|floor|floors|gripper|grippers|hand|hands|human|humans|people|person|table|tables|wall|walls)([^a-z0-9]|$)') THEN 'filtered' ELSE 'kept' END AS status FROM k""")
def inventory_objects(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    o = p.select(F.col("p_brand").alias("uid"), (F.col("p_partkey") % 40).alias("frame"), F.col("p_partkey").alias("pos"), F.col("p_name").alias("name"), F.lit(None).cast("string").alias("alternate_name"), F.col("p_type").alias("color"), F.array(size, size, size + 10, size + 11).alias("bbox"), (F.col("p_size") % 3 != 0).alias("clearly_visible"))
    return inventory.validated(o).select(F.col("pos").alias("p_partkey"), "status")


# Records and scans


@query("SELECT conv_id, string_agg(role || ':' || length(text), ';' ORDER BY turn) AS turns, count(*) AS n FROM conversations GROUP BY conv_id")
def conversation_records(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.length("text").alias("chars"))
    out = records.renested(c, key="conv_id", order="turn", fields=["role", "chars"], into="turns")
    return out.select("conv_id", F.array_join(F.transform("turns", lambda t: F.concat_ws(":", t["role"], t["chars"])), ";").alias("turns"), "n")


@query("""WITH c AS (SELECT conv_id, string_agg(role || ': ' || text, chr(10) ORDER BY turn) AS t FROM conversations GROUP BY conv_id) SELECT conv_id, sha256(CASE WHEN length(t) > 12000 THEN right(t, 12000) ELSE t END) AS text_sha256 FROM c""")
def task_text(spark, sf_dir):
    none = F.lit(None).cast("string")
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))
    out = records.renested(c, key="conv_id", order="turn", fields=["role", "content"], into="turns")
    return out.select("conv_id", F.sha2(records.task_text(none, none, F.col("turns")), 256).alias("text_sha256"))


# Compositions


@query(f"""WITH {USER_EVENTS}, s AS (SELECT uid, pos, t AS a, lead(t) OVER (PARTITION BY uid ORDER BY pos) AS b FROM ue), v AS (SELECT uid, pos, CASE WHEN pos = 1 THEN 0 ELSE a END AS a, b + CASE WHEN uid % 3 = 0 THEN 0.5 ELSE 0 END AS b FROM s WHERE b IS NOT NULL),
c AS (SELECT *, lag(b) OVER (PARTITION BY uid ORDER BY pos) AS p, max(b) OVER (PARTITION BY uid) AS d, row_number() OVER (PARTITION BY uid ORDER BY pos DESC) AS z FROM v)
SELECT uid, concat_ws(',', CASE WHEN max(CASE WHEN a < 0 OR b <= a THEN 1 ELSE 0 END) = 1 THEN 'subtask_invalid_bounds' END, CASE WHEN max(CASE WHEN abs(a - p) > 1e-4 THEN 1 ELSE 0 END) = 1 THEN 'subtask_noncontiguous' END, CASE WHEN max(CASE WHEN z = 1 AND abs(b - (d + uid % 2)) > 0.5 THEN 1 ELSE 0 END) = 1 THEN 'subtask_final_end_mismatch' END) AS errors FROM c GROUP BY uid""")
def step_validation(spark, sf_dir):
    by, whole = W.partitionBy("uid").orderBy("pos"), W.partitionBy("uid")
    e = user_events(spark, sf_dir).withColumn("end_s", F.lead("t").over(by)).where("end_s IS NOT NULL")
    steps = e.select("uid", "pos", F.col("event_type").alias("subtask"), F.when(F.col("pos") == 1, 0.0).otherwise(F.col("t")).alias("start_s"), (F.col("end_s") + F.when(F.col("uid") % 3 == 0, 0.5).otherwise(0.0)).alias("end_s"), F.lit(True).alias("has_video"), F.lit(0).alias("media_count"), F.lit(None).cast("int").alias("start_i"), F.lit(None).cast("int").alias("end_i"))
    steps = steps.withColumn("duration", F.max("end_s").over(whole) + F.col("uid") % 2)
    return timeline.validate(steps).select("uid", F.array_join("errors", ",").alias("errors"))


@query("""WITH s AS (SELECT l_orderkey AS uid, l_linenumber AS pos, l_quantity, CAST(l_quantity AS BIGINT) % 7 AS a, CAST(l_partkey % 9 AS BIGINT) AS w FROM lineitem), g AS (SELECT uid, pos, w, a, least(12, 14 - x) AS n, x AS anchor_media FROM (SELECT *, unnest(range(a, least(a + w + 1, 14))) AS x FROM s))
SELECT uid, pos, anchor_media, anchor_media + n - 1 AS future_end, 12 - n AS padding, count(*) AS copies FROM g GROUP BY ALL""")
def image_anchors(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    a = l["l_quantity"].cast("int") % 7
    steps = l.select(F.col("l_orderkey").alias("uid"), F.col("l_linenumber").alias("pos"), a.alias("start_i"), (a + F.col("l_partkey") % 9).cast("int").alias("end_i"), F.lit(14).alias("media_count"))
    big = lambda c: F.col(c).cast("bigint").alias(c)
    return grids.image_anchors(steps).groupBy("uid", "pos", big("anchor_media"), big("future_end"), big("padding")).agg(F.count("*").alias("copies"))


@query("""WITH r AS (SELECT conv_id, turn, role, length(text) % 4 AS k, count(*) OVER (PARTITION BY conv_id % 40) AS n, row_number() OVER (PARTITION BY conv_id % 40 ORDER BY conv_id, turn) AS i FROM conversations),
f AS (SELECT unnest([x FOR x IN [CASE WHEN k = 1 THEN 'wrong_model' END, CASE WHEN k = 2 THEN 'wrong_contract' END, CASE WHEN k = 3 THEN 'adjacent_identical_subtask' END, CASE WHEN i > 1 THEN 'duplicate_input_uid' END] IF x IS NOT NULL]) AS key FROM r)
SELECT 'records' AS figure, '' AS key, count(*) AS n FROM r UNION ALL SELECT 'unique_uids', '', count(DISTINCT conv_id % 40) FROM r UNION ALL SELECT 'source', role, count(*) FROM r GROUP BY role UNION ALL SELECT 'failure', key, count(*) FROM f GROUP BY key
UNION ALL SELECT 'failure', 'unexpected_unique_uid_count', 1 WHERE (SELECT count(DISTINCT conv_id % 40) FROM r) <> (SELECT count(*) FROM r)""")
def record_audit(spark, sf_dir):
    """JSON records made of the turns, parsed and audited as a stage: one uid for each fortieth conversation."""
    c = table(spark, sf_dir, "conversations")
    k = F.length("text") % 4
    step = lambda name: F.struct(name.alias("subtask"))
    steps = F.array(step(F.lit("open")), step(F.when(k == 3, " Open ").otherwise("close")))
    extension = F.struct(F.lit("subtask").alias("annotation_task"), F.lit("p").alias("provider"), F.when(k == 1, "old").otherwise("m").alias("model"), F.struct(steps.alias("subtasks")).alias("result"), F.array().cast("array<string>").alias("requests"))
    annotation = F.struct(F.when(k == 2, "other").otherwise(contracts.CONTRACT_IDS["subtask"][0]).alias("contract_id"))
    record = F.struct(F.lit(records.RECORD_SCHEMA).alias("schema_version"), F.col("role").alias("source_key"), F.struct(extension.alias("robot_extension")).alias("annotations"), F.struct((F.col("conv_id") % 40).cast("string").alias("input_record_uid"), annotation.alias("annotation")).alias("provenance"))
    lines = c.select(F.col("conv_id").alias("file"), F.col("turn").alias("line"), F.to_json(record).alias("value"))
    audited = records.audit(lines, task="subtask", provider="p", model="m", contract_id=contracts.CONTRACT_IDS["subtask"][0])
    return records.audit_summary(audited, expected=c.count())


@query("""WITH m AS (SELECT CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 4 = 0 THEN ':view=left' ELSE '' END AS uid, c_custkey AS k FROM customer), a AS (SELECT c_custkey AS k FROM customer WHERE c_nationkey < 15), d AS (SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uid FROM orders WHERE o_orderstatus = 'P'),
e AS (SELECT uid, k FROM m WHERE k IN (SELECT k FROM a) AND uid NOT IN (SELECT uid FROM d)), h AS (SELECT *, CAST(CAST('0x' || substr(sha256(uid), 1, 16) AS UBIGINT) % 8 AS INTEGER) AS slot FROM e), s AS (SELECT *, row_number() OVER (PARTITION BY slot ORDER BY k) AS n FROM h)
SELECT 'master' AS figure, count(*) AS n FROM m UNION ALL SELECT 'available', count(*) FROM a UNION ALL SELECT 'completed', count(*) FROM d UNION ALL SELECT 'excluded', 0 UNION ALL SELECT 'eligible', count(*) FROM e UNION ALL SELECT 'scheduled', count(*) FROM s WHERE n <= 20""")
def generation(spark, sf_dir):
    """One scheduling round: master list, availability by primary view, ledgers, stable slots and their cap."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    text = F.col("c_custkey").cast("string")
    master = c.select(F.when(F.col("c_custkey") % 4 == 0, F.concat(text, F.lit(":view=left"))).otherwise(text).alias("uid"), F.col("c_custkey").alias("pos"))
    available, completed = c.where("c_nationkey < 15").select(text.alias("uid")), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").cast("string").alias("uid")).distinct()
    excluded = completed.where("false")
    chosen = sets.eligible(master, available, completed, excluded)
    return reuse.generation_manifest(master, available, completed, excluded, chosen, sets.slotted(chosen, 8, cap=20))


@query("""WITH s AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 0 THEN ':view=x' ELSE '' END AS uid FROM customer), r AS (SELECT CAST(o_custkey AS VARCHAR) AS k, CASE WHEN o_orderpriority < '3' THEN 'exact' ELSE 'pack' END AS place, CAST(o_orderkey AS VARCHAR) AS record, o_orderstatus <> 'P' AS ok FROM orders),
j AS (SELECT s.uid, record, place, CASE WHEN record IS NULL THEN 'not_found' WHEN NOT ok THEN 'contract_invalid' END AS error FROM s LEFT JOIN r ON r.k = split_part(s.uid, ':view=', 1)),
o AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY error IS NOT NULL, CASE WHEN place = 'exact' THEN 1 WHEN place = 'pack' THEN 4 ELSE 99 END, sha256(coalesce(record, ''))) AS n FROM j)
SELECT uid, CASE WHEN error IS NULL THEN record END AS record, place, error, NOT contains(uid, ':view=') AS primary_view FROM o WHERE n = 1""")
def located_records(spark, sf_dir):
    text = F.col("c_custkey").cast("string")
    sources = table(spark, sf_dir, "customer").select(F.when(F.col("c_custkey") % 2 == 0, F.concat(text, F.lit(":view=x"))).otherwise(text).alias("uid"), F.lit("h").alias("subtask_sha"))
    o = table(spark, sf_dir, "orders")
    stored = o.select(F.col("o_custkey").cast("string").alias("uid"), F.when(F.col("o_orderpriority") < "3", "exact").otherwise("pack").alias("place"), F.col("o_orderkey").cast("string").alias("record"), (F.col("o_orderstatus") != "P").alias("contract_ok"), F.lit("cpa_final").alias("authority"), F.lit("h").alias("subtask_sha"))
    return reuse.located(sources, stored)


@query(f"""WITH {PAIRS}, o AS (SELECT uid, event_id, pair_index, [((x + 5) // 10) / 100 FOR x IN o] AS xy FROM pp) SELECT uid, event_id, CAST(count(*) AS INTEGER) AS object_points, '{{"object": [' || string_agg(printf('[%.2f, %.2f]', xy[1], xy[2]), ', ' ORDER BY 'O' || pair_index, xy[1], xy[2]) || ']}}' AS answer_text FROM o GROUP BY uid, event_id""")
def coordinate_questions(spark, sf_dir):
    """Answers in two decimals; a coordinate halfway between two of them goes up."""
    rows = points.point_rows(_point_pairs(spark, sf_dir)).where("role = 'contacted_object'")
    rows = rows.withColumn("raw_xy", F.col("xy")).withColumn("xy", F.transform("xy", lambda v: v / 1000)).withColumn("role", F.lit("object")).withColumn("query_frame", F.lit(1)).withColumn("contact_frame", F.lit(2))
    return points.questions(rows).select("uid", "event_id", "object_points", "answer_text")


@query("WITH r AS (SELECT event_id, user_id % 50 AS p, event_type AS t FROM events), c AS (SELECT DISTINCT p, t FROM r WHERE p % 3 = 0) SELECT event_id, CASE WHEN c.p IS NOT NULL THEN t || '/' || r.p END AS raw, CASE WHEN c.p IS NULL THEN 'not_recorded' END AS error FROM r LEFT JOIN c USING (p, t)")
def replayed_answers(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    p = (F.col("user_id") % 50).cast("string")
    asked = e.select("event_id", "event_type", p.alias("p"), provider.request_hash(F.col("event_type"), p).alias("request_hash"))
    recorded = asked.where("CAST(p AS INT) % 3 = 0").select("request_hash", F.concat_ws("/", "event_type", "p").alias("raw"))
    return provider.replayed(asked, recorded).select("event_id", "raw", "error")


TOKENS = "regexp_extract_all({}, '[a-z0-9]+')"
SAID = "CASE frame % 5 WHEN 0 THEN ' ' || upper(name) WHEN 1 THEN split_part(name, ' ', 2) WHEN 2 THEN 'the ' || name || ' here' WHEN 3 THEN 'zzz qqq' ELSE ' None' END"


@query(f"""WITH o AS (SELECT p_brand AS uid, p_partkey % 200 AS frame, p_name AS name, lower(p_type) AS color FROM part), r AS (SELECT uid, frame, {SAID} AS reported FROM (SELECT uid, frame, min(name) AS name FROM o GROUP BY ALL)), s AS (SELECT *, lower(trim(reported)) AS said, {TOKENS.format("lower(trim(reported))")} AS t FROM r),
l AS (SELECT s.uid, s.frame, said, t, name, unnest([name, color || ' ' || name]) AS label FROM s JOIN o USING (uid, frame)), k AS (SELECT *, {TOKENS.format("lower(label)")} AS lt FROM l),
c AS (SELECT uid, frame, name, lower(trim(name)) = said AS same, CASE WHEN contains(array_to_string(t, ' '), array_to_string(lt, ' ')) OR contains(array_to_string(lt, ' '), array_to_string(t, ' ')) THEN len(list_intersect(lt, t)) * 1000 + len(lt) END AS score FROM k),
b AS (SELECT uid, frame, count(DISTINCT name) FILTER (same) AS sames, min(name) FILTER (same) AS one, max(score) AS top FROM c GROUP BY ALL), n AS (SELECT c.uid, c.frame, count(DISTINCT name) AS loose, min(name) AS name FROM c JOIN b ON b.uid = c.uid AND b.frame = c.frame AND c.score = b.top GROUP BY ALL)
SELECT s.uid, s.frame, CASE WHEN said = 'none' THEN NULL WHEN sames = 1 THEN one WHEN sames = 0 AND loose = 1 THEN n.name END AS chosen, CASE WHEN said <> 'none' AND NOT coalesce(sames = 1 OR (sames = 0 AND loose = 1), false) THEN 'not_in_inventory' END AS error FROM s JOIN b USING (uid, frame) LEFT JOIN n USING (uid, frame)""")
def first_object(spark, sf_dir):
    """Frames of several objects: an equal name, a part of a name that one or several share, a name inside a phrase, a foreign one, none."""
    p = table(spark, sf_dir, "part").select(F.col("p_brand").alias("uid"), (F.col("p_partkey") % 200).alias("frame"), F.col("p_name").alias("name"), F.col("p_name").alias("alternate_name"), F.lower("p_type").alias("color"))
    said = p.groupBy("uid", "frame").agg(F.min("name").alias("name")).select("uid", "frame", F.expr(SAID).alias("reported"))
    return inventory.first_object(said, p).select("uid", "frame", "chosen", "error")
