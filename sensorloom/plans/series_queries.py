"""Queries on ordered series: thinning, running measures, run lengths, sampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import keys
from sensorloom.functions.stamps import micros
from sensorloom.operators import series
from sensorloom.operators.ordered import index_rows, split_points
from sensorloom.plans.registry import HOUR, LOG, query

ROW_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
ROW_ORDER_SQL = ", ".join(ROW_ORDER)


@query(
    f"""WITH RECURSIVE {LOG},
nxt AS (SELECT topic, t, min(t) OVER (PARTITION BY topic ORDER BY t RANGE BETWEEN {HOUR} FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM log),
kept AS (SELECT topic, min(t) AS t FROM log GROUP BY topic
         UNION ALL SELECT kept.topic, nxt.nt FROM kept JOIN nxt USING (topic, t) WHERE nxt.nt IS NOT NULL)
SELECT topic, seq, t FROM kept JOIN log USING (topic, t)"""
)
def thin_min_gap(t):
    """Messages at least an hour after the last kept one of their topic."""
    return series.thin(t.log().select("topic", "seq", "t"), ["topic"], HOUR)


@query(
    f"""WITH s AS (SELECT *, epoch_us(l_shipdate) AS t FROM lineitem),
w AS (SELECT *, max(t) OVER (PARTITION BY l_suppkey ORDER BY {ROW_ORDER_SQL} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM s)
SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, t FROM w WHERE top IS NULL OR t > top"""
)
def monotone_filter(t):
    """Rows whose stamp exceeds every earlier one of their series."""
    rows = t.lineitem.select("l_suppkey", *ROW_ORDER, micros("l_shipdate").alias("t"))
    kept = series.strictly_increasing(rows, ["l_suppkey"], seq=tuple(ROW_ORDER))
    return kept.select("l_suppkey", "l_orderkey", "l_linenumber", "l_partkey", "t")


@query(
    f"""WITH s AS (SELECT *, first_value(l_suppkey) OVER w AS fp, first_value(l_returnflag = 'A') OVER w AS fs FROM lineitem
  WINDOW w AS (PARTITION BY l_partkey ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice))
SELECT l_partkey AS child, l_suppkey AS parent, l_orderkey, l_linenumber, fs AS is_static FROM s WHERE l_suppkey = fp"""
)
def first_parent(t):
    """Edges that agree with the first parent logged for their child."""
    edges = t.lineitem.select(
        F.col("l_partkey").alias("child"), F.col("l_suppkey").alias("parent"), "l_orderkey", "l_linenumber", "l_suppkey",
        "l_extendedprice", (F.col("l_returnflag") == "A").alias("is_static"),
    )
    kept = series.first_parent(edges, seq=("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"))
    return kept.select("child", "parent", "l_orderkey", "l_linenumber", "is_static")


@query(
    """WITH p AS (SELECT label, vec_id, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z FROM embeddings),
d AS (SELECT label, sqrt((x - lag(x) OVER w) ** 2 + (y - lag(y) OVER w) ** 2 + (z - lag(z) OVER w) ** 2) AS step
      FROM p WINDOW w AS (PARTITION BY label ORDER BY vec_id))
SELECT label, round(coalesce(sum(step), 0), 6) AS length FROM d GROUP BY label"""
)
def path_length(t):
    """Distance travelled per track."""
    points = t.vectors(3)
    out = series.path_length(points, ["label"], ["vec_id"], ["e0", "e1", "e2"])
    return out.select("label", F.round("length", 6).alias("length"))


@query(
    f"""WITH {LOG},
c AS (SELECT run, seq, topic, CASE WHEN lag(topic) OVER (PARTITION BY run ORDER BY seq) IS NOT DISTINCT FROM topic THEN 0 ELSE 1 END AS ch FROM log),
i AS (SELECT run, topic, sum(ch) OVER (PARTITION BY run ORDER BY seq) AS island FROM c)
SELECT run, CAST(island AS BIGINT) AS island, topic AS prefix, 'log' AS meta, count(*) AS n FROM i GROUP BY run, island, topic"""
)
def rle_keys(t):
    """Runs of labels with one prefix, per sensor, in log order."""
    rows = t.log().select("run", F.col("seq"), F.concat_ws("_", "topic", "seq").alias("label"))
    rows = rows.withColumnRenamed("run", "sensor")
    out = series.condense_runs(rows, ["sensor"], ["seq"], keys.prefix(F.col("label")), F.lit("log"))
    return out.select(F.col("sensor").alias("run"), F.col("run").alias("island"), "prefix", "meta", "n")


@query(
    """WITH f AS (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS k, quality, toxic FROM labels),
m AS (SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS has FROM documents),
r AS (SELECT doc_id, has, CASE WHEN has THEN sum(CAST(has AS INT)) OVER (ORDER BY doc_id) - 1 END AS k FROM m)
SELECT doc_id, CAST(r.k AS BIGINT) AS slot, quality, toxic FROM r LEFT JOIN f ON r.k = f.k"""
)
def masked_scatter(t):
    """The k-th masked document gets the k-th feature row."""
    marked = t.documents.select("doc_id").join(t.labels.select("doc_id", F.lit(True).alias("_m")), "doc_id", "left")
    points = marked.select("doc_id", F.coalesce("_m", F.lit(False)).alias("has"))
    features = index_rows(t.labels, [], ["doc_id"], "slot").select("slot", "quality", "toxic")
    splits = split_points(t.documents.select("doc_id"), ["doc_id"])
    out = series.scatter_by_mask(points, features, [], "has", "doc_id", "slot", splits)
    return out.select("doc_id", "slot", "quality", "toxic")


CAP = 30_000


@query(
    f"""WITH n AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
c AS (SELECT l_orderkey, n, sum(n) OVER (ORDER BY l_orderkey) - n AS before FROM n)
SELECT l_orderkey, n FROM c WHERE before < {CAP}"""
)
def cloud_cap(t):
    """Whole clouds in order until the total reaches the cap."""
    clouds = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    splits = split_points(t.lineitem.select("l_orderkey"), ["l_orderkey"])
    return series.until_total(clouds, [], ["l_orderkey"], "n", CAP, splits)


@query(
    f"""WITH {LOG} SELECT run, seq, count(*) OVER (PARTITION BY run ORDER BY seq) AS n_seen,
round(sqrt(value * value + k * k), 6) AS speed FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM log)"""
)
def running_history(t):
    """Records so far and speed, per record."""
    rows = t.log().select("run", "seq", "value", F.get_json_object("props", "$.k").cast("double").alias("k"))
    out = series.history(rows, ["run"], ["seq"], ["value", "k"])
    return out.select("run", "seq", "n_seen", F.round("speed", 6).alias("speed"))


@query(
    f"""WITH {LOG},
w AS (SELECT *, max(t) OVER (PARTITION BY topic ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM log)
SELECT topic, row_number() OVER (PARTITION BY topic ORDER BY t) - 1 AS idx, t, value FROM w WHERE top IS NULL OR t > top"""
)
def interp_series(t):
    """Raw increasing series per topic, kept whole for later interpolation."""
    log = t.log().select("topic", "seq", "t", "value")
    kept = series.strictly_increasing(log, ["topic"])
    splits = split_points(log.select("t"), ["t"])
    return index_rows(kept, ["topic"], ["t"], splits=splits).select("topic", "idx", "t", "value")


@query(
    """WITH l AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS idx FROM customer),
r AS (SELECT s_name, s_acctbal, row_number() OVER (ORDER BY s_name) - 1 AS idx FROM supplier)
SELECT idx, c_name, s_name, s_acctbal FROM l JOIN r USING (idx)"""
)
def positional_join(t):
    """Sorted file names aligned with pose rows by position."""
    left = index_rows(t.customer.select("c_name"), [], ["c_name"])
    right = index_rows(t.supplier.select("s_name", "s_acctbal"), [], ["s_name"])
    return left.join(right, "idx").select("idx", "c_name", "s_name", "s_acctbal")


@query("SELECT o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx FROM orders) WHERE idx < 100")
def first_n(t):
    """The first hundred frames by index."""
    return t.orders.select("o_orderkey", "o_totalprice").orderBy("o_orderkey").limit(100)


@query(
    """WITH i AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, count(*) OVER () AS n FROM orders)
SELECT idx, o_orderkey FROM i WHERE idx % greatest(1, n // 10) = 0"""
)
def stride_sample(t):
    """Every n-div-tenth frame."""
    ranked = index_rows(t.orders.select("o_orderkey"), [], ["o_orderkey"])
    return series.every_nth(ranked, "idx").select("idx", "o_orderkey")
