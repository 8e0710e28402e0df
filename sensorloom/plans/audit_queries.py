"""Queries that audit runs and datasets, and look up or merge metadata."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import stamps
from sensorloom.operators import audit
from sensorloom.operators.ordered import dense_index, index_rows
from sensorloom.operators.skew import join_hot, join_skewed
from sensorloom.plans.registry import HOUR, LOG, query
from sensorloom.sources import readers, writers


@query(
    """SELECT l_suppkey, count(DISTINCT l_linenumber - 1) AS n_idx, min(l_linenumber) - 1 AS first, max(l_linenumber) - 1 AS final,
min(l_linenumber) = 1 AND max(l_linenumber) = count(DISTINCT l_linenumber) AS complete FROM lineitem GROUP BY l_suppkey"""
)
def completeness(t):
    """Whether the frame indices of every series run from 0 without a gap."""
    rows = t.lineitem.select("l_suppkey", (F.col("l_linenumber") - 1).alias("idx"))
    return audit.completeness(rows, ["l_suppkey"], "idx")


@query("SELECT event_type AS topic, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_pop(value), 6) AS std FROM events GROUP BY event_type")
def metric_stats(t):
    """Mean and population standard deviation per topic."""
    out = audit.mean_std(t.log(), ["topic"], "value")
    return out.select("topic", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    """SELECT source, count(*) AS n_frames, round(sum(n_chars) / 1e9::DOUBLE, 12) AS gb, round(sum(n_chars) / 1e6::DOUBLE / count(*), 9) AS mb_per_frame
FROM documents GROUP BY source"""
)
def storage_stats(t):
    """Storage per modality and per frame."""
    out = audit.storage(t.documents, "source", F.col("n_chars"))
    return out.select("source", "n_frames", F.round("gb", 12).alias("gb"), F.round("mb_per_frame", 9).alias("mb_per_frame"))


@query(
    f"""WITH {LOG}, r AS (SELECT run, CASE WHEN bool_or(topic = 'error' AND value > 20) THEN 'failed' ELSE 'ok' END AS status FROM log GROUP BY run),
n AS (SELECT status, count(*) AS n_runs FROM r GROUP BY status)
SELECT status, n_runs, run FROM r JOIN n USING (status)"""
)
def run_status(t):
    """Runs by outcome, with the number of runs per outcome."""
    failed = F.bool_or((F.col("topic") == "error") & (F.col("value") > 20))
    runs = t.log().groupBy("run").agg(F.when(failed, "failed").otherwise("ok").alias("status"))
    counts = runs.groupBy("status").agg(F.count(F.lit(1)).alias("n_runs"))
    return join_hot(runs, counts, ["status"], ["run"], "inner").select("status", "n_runs", "run")


@query("SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY p_name, p_brand HAVING count(*) > 1")
def dup_names(t):
    """Names that occur more than once in a catalogue."""
    return audit.duplicates(t.part, ["p_name", "p_brand"])


@query("SELECT conv_id, role, count(DISTINCT turn) AS n_frames FROM conversations GROUP BY conv_id, role")
def frames_per_run(t):
    """Frames per run and modality."""
    return t.conversations.groupBy("conv_id", "role").agg(F.count_distinct("turn").alias("n_frames"))


@query(
    r"""WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents)
SELECT doc_id, CAST(regexp_extract(line, '\d+\.\d+') AS DOUBLE) AS metric FROM l WHERE contains(line, ' ') AND regexp_extract(line, '\d+\.\d+') <> ''"""
)
def log_metrics(t):
    """First decimal number of every line with the keyword, over whole texts."""
    return audit.metric_lines(t.documents.select("doc_id", "text"), "text", " ").select("doc_id", "metric")


@query(
    r"""WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
m AS (SELECT source, CAST(regexp_extract(line, '\d+\.\d+') AS DOUBLE) AS metric FROM l WHERE contains(line, ' ') AND regexp_extract(line, '\d+\.\d+') <> '')
SELECT source, count(*) AS n, round(avg(metric), 6) AS mean, round(stddev_pop(metric), 6) AS std FROM m GROUP BY source"""
)
def log_metric_stats(t):
    """Mean and spread of the numbers found in log texts."""
    found = audit.metric_lines(t.documents.select("source", "text"), "text", " ")
    out = audit.mean_std(found, ["source"], "metric")
    return out.select("source", "n", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


@query(
    """SELECT coalesce(c.c_custkey, s.s_suppkey) AS key, coalesce(c.c_nationkey, s.s_nationkey) AS value,
coalesce(c.c_nationkey <> s.s_nationkey, false) AS conflict FROM supplier s FULL JOIN customer c ON c.c_custkey = s.s_suppkey"""
)
def upsert_conflict(t):
    """New metadata wins; changed keys are flagged."""
    old = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("value"))
    new = t.customer.select(F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("value"))
    return audit.upsert_with_conflict(old, new, "key", "value")


@query("SELECT doc_id AS key, n_chars, coalesce(CAST(quality AS VARCHAR), 'NULL') AS value FROM documents LEFT JOIN labels USING (doc_id)")
def info_lookup(t):
    """Metadata value of a key, ``NULL`` text when absent."""
    info = t.labels.select(F.col("doc_id").alias("key"), F.col("quality").cast("string").alias("value"))
    asked = t.documents.select(F.col("doc_id").alias("key"), "n_chars")
    return audit.lookup(asked, info, "key", "value", "NULL", ["n_chars"]).select("key", "n_chars", "value")


SHIPPED = "s AS (SELECT l_orderkey, CAST(min(epoch_us(l_shipdate)) AS DOUBLE) / 1e6 AS t FROM lineitem GROUP BY l_orderkey)"


def _shipped(t):
    """First stamp per index; some indices have none."""
    first = t.lineitem.groupBy(F.col("l_orderkey").alias("idx")).agg(F.min(stamps.micros("l_shipdate")).alias("t"))
    return first.select("idx", (F.col("t").cast("double") / 1e6).alias("stamp"))


@query(f"WITH {SHIPPED} SELECT o_orderkey AS idx, o_totalprice, coalesce(s.t, -1.0) AS stamp FROM orders LEFT JOIN s ON l_orderkey = o_orderkey")
def stamp_lookup(t):
    """Stamp of a frame index, -1 when absent."""
    asked = t.orders.select(F.col("o_orderkey").alias("idx"), "o_totalprice")
    found = join_skewed(asked, _shipped(t), ["idx"], ["o_totalprice"])
    return found.select("idx", "o_totalprice", F.coalesce("stamp", F.lit(-1.0)).alias("stamp"))


@query(
    f"""WITH {LOG}, c AS (SELECT run, t // {24 * HOUR} AS day, topic, seq, value, CASE topic WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 2 END AS p FROM log),
r AS (SELECT *, row_number() OVER (PARTITION BY run, day ORDER BY p, seq) AS k FROM c)
SELECT run, CAST(day AS BIGINT) AS day, topic, seq, value FROM r WHERE k = 1"""
)
def prefer_source(t):
    """One record per run and day from the preferred container that has it."""
    rows = t.log().withColumn("day", F.floor(F.col("t") / (24 * HOUR)))
    priority = F.when(F.col("topic") == "view", 0).when(F.col("topic") == "click", 1).otherwise(2)
    return audit.prefer(rows, ["run", "day"], priority, ["topic", "seq", "value"], "seq")


@query(
    """SELECT o_orderkey, o_totalprice, CASE WHEN o_orderstatus = 'O' THEN -1 ELSE o_custkey END AS first_update FROM orders"""
)
def backfill_columns(t):
    """Old layout without a column and new layout together; the column is filled with -1."""
    old = t.orders.filter(F.col("o_orderstatus") == "O").select("o_orderkey", "o_totalprice")
    new = t.orders.filter(F.col("o_orderstatus") != "O").select("o_orderkey", "o_totalprice", F.col("o_custkey").alias("first_update"))
    return readers.with_missing_columns(old, new, {"first_update": -1})


@query("SELECT s_nationkey AS nation FROM supplier INTERSECT SELECT c_nationkey FROM customer")
def modalities_present(t):
    """Configured modalities that exist."""
    wanted = t.customer.select(F.col("c_nationkey").alias("nation"))
    return wanted.intersect(t.supplier.select(F.col("s_nationkey").alias("nation")))


@query(
    f"""WITH {LOG}, b AS (SELECT min(t) AS s FROM log),
w AS (SELECT run, CAST((t - s) // {24 * HOUR} AS BIGINT) AS idx, arg_max(value, seq) AS value FROM log, b GROUP BY run, idx),
d AS (SELECT run, unnest(range(0, max(idx) + 1)) AS idx FROM w GROUP BY run)
SELECT run, idx, coalesce(value, -1.0) AS value FROM d LEFT JOIN w USING (run, idx)"""
)
def dense_fill(t):
    """Last written value for every index, gaps filled with -1."""
    log = t.log()
    start = log.agg(F.min("t")).scalar()
    rows = log.withColumn("idx", F.floor((F.col("t") - start) / (24 * HOUR)))
    return audit.last_write_dense(rows, ["run"], "idx", "value", "seq", -1.0)


@query(
    f"""WITH {SHIPPED}, d AS (SELECT unnest(range(0, max(l_orderkey) + 1)) AS idx FROM lineitem)
SELECT idx, CASE WHEN s.t IS NULL THEN 'nan' ELSE printf('%.9f', s.t) END AS stamp_text, isnan(coalesce(s.t, 'nan'::DOUBLE)) AS lost FROM d LEFT JOIN s ON idx = l_orderkey"""
)
def pose_export(t):
    """Stamps with nine decimals and poses for every index; missing ones are nan."""
    known = _shipped(t).withColumn("x", F.col("stamp"))
    top = t.lineitem.agg(F.max("l_orderkey").alias("_hi")).withColumn("_lo", F.lit(0))
    dense = dense_index(top, [], "_lo", "_hi").select("idx")
    lines = writers.pose_lines(dense.join(known, "idx", "left"), "stamp", ["x"])
    return lines.select("idx", "stamp_text", F.isnan("x").alias("lost"))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def resume_anti(t):
    """Frames still to be written."""
    done = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.not_yet_written(t.orders.select("o_orderkey", "o_totalprice"), done, ["o_orderkey"])


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50)")
def read_multi_idx(t):
    """Records of a list of indices."""
    idxs = t.lineitem.filter(F.col("l_quantity") == 50).select(F.col("l_orderkey").alias("o_orderkey"))
    return audit.read_indices(t.orders.select("o_orderkey", "o_totalprice"), idxs, ["o_orderkey"])


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, epoch_us(l_shipdate) AS stamp, round(l_extendedprice * (1 - l_discount), 6) AS value FROM lineitem"
)
def derive_keep_stamp(t):
    """Derived records with the stamps of their source."""
    value = F.round(F.col("l_extendedprice") * (1 - F.col("l_discount")), 6)
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", stamps.micros("l_shipdate").alias("stamp"), value.alias("value"))


@query(
    """SELECT format('{:08d}', c_custkey) AS stem, c_mktsegment || '/' || c_name AS full_name, replace(c_mktsegment || '/' || c_name, '/', '-') AS folder FROM customer"""
)
def name_format(t):
    """File stems, qualified names and folder names."""
    full = stamps.qualified_name(F.col("c_mktsegment"), F.col("c_name"))
    return t.customer.select(
        stamps.frame_name(F.col("c_custkey")).alias("stem"), full.alias("full_name"), F.replace(full, F.lit("/"), F.lit("-")).alias("folder")
    )


@query(
    """SELECT page_id, page_id || '-' || lpad(CAST(length(html) AS VARCHAR), 9, '0') || '.html' AS name,
CAST(page_id || '.' || lpad(CAST(length(html) AS VARCHAR), 9, '0') AS DOUBLE) AS stamp FROM pages"""
)
def stamp_from_name(t):
    """Seconds coded in file names."""
    name = F.concat(F.col("page_id").cast("string"), F.lit("-"), F.lpad(F.length("html").cast("string"), 9, "0"), F.lit(".html"))
    return t.pages.select("page_id", name.alias("name"), stamps.stamp_from_name(name).alias("stamp"))


@query("SELECT event_id, CAST(ns // 1000000000 AS BIGINT) AS sec, CAST(ns % 1000000000 AS BIGINT) AS nanosec, ns AS back, CAST(ns AS DOUBLE) / 1e9 AS seconds FROM (SELECT event_id, epoch_us(ts) * 1000 + 7 AS ns FROM events)")
def stamp_convert(t):
    """Nanoseconds to seconds and remainder, and back."""
    rows = t.log().select(F.col("seq").alias("event_id"), (F.col("t") * 1000 + 7).alias("ns"))
    sec, nanosec = stamps.split_nanos(F.col("ns"))
    return rows.select("event_id", sec.alias("sec"), nanosec.alias("nanosec"), "ns").select(
        "event_id", "sec", "nanosec", stamps.nanos(F.col("sec"), F.col("nanosec")).alias("back"), stamps.seconds(F.col("ns")).alias("seconds")
    )


@query(
    """SELECT 'nation' AS grp, n_name AS name, 'nation/' || n_name AS full_name FROM nation UNION ALL SELECT '', r_name, '/' || r_name FROM region"""
)
def catalog_concat(t):
    """Included topic lists as one catalogue; the group defaults to empty."""
    nations = t.nation.select(F.lit("nation").alias("grp"), F.col("n_name").alias("name"))
    both = nations.unionByName(t.region.select(F.col("r_name").alias("name")), allowMissingColumns=True)
    both = both.withColumn("grp", F.coalesce("grp", F.lit("")))
    return both.select("grp", "name", stamps.qualified_name(F.col("grp"), F.col("name")).alias("full_name"))


@query(
    """WITH k AS (SELECT event_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)
SELECT event_id, k AS fx, k + 1 AS fy, k + 2 AS cx, k + 3 AS cy FROM k"""
)
def calib_coalesce(t):
    """Camera parameters out of three calibration layouts."""
    k = F.get_json_object("props", "$.k").cast("int")
    a, b, c, d = k, k + 1, k + 2, k + 3
    text = (
        F.when(F.col("event_type") == "click", F.format_string('{"cam0":{"intrinsics":[%d,%d,%d,%d]}}', a, b, c, d))
        .when(F.col("event_type") == "view", F.format_string('{"K":[%d,0,%d,0,%d,%d,0,0,1]}', a, c, b, d))
        .otherwise(F.format_string('{"intrinsics":{"K":[%d,0,%d,0,%d,%d,0,0,1]}}', a, c, b, d))
    )
    found = t.events.select("event_id", readers.calibration(text).alias("p"))
    return found.select("event_id", *[F.get("p", F.lit(i)).alias(n) for i, n in enumerate(("fx", "fy", "cx", "cy"))])


@query(
    """SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) - 1 AS idx, o_orderkey FROM orders"""
)
def frame_numbers(t):
    """Frames numbered per run in stamp order."""
    rows = t.orders.select("o_custkey", stamps.micros("o_orderdate").alias("t"), "o_orderkey")
    return index_rows(rows, ["o_custkey"], ["t", "o_orderkey"]).select("o_custkey", "idx", "o_orderkey")
