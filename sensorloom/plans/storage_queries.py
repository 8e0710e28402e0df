"""Queries that write derived tables and files to the shared folder and read them back."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import stamps
from sensorloom.operators import audit
from sensorloom.operators.skew import join_hot
from sensorloom.plans.export import export
from sensorloom.plans.registry import HOUR, LOG, query
from sensorloom.plans.sync_queries import BACK, backward
from sensorloom.session import new_path, salts
from sensorloom.sources import readers, writers
from sensorloom.sources.frames import FrameStore


def _records(t):
    return t.log().select(
        F.lit("log").alias("run"), F.lit("sensors").alias("group"), F.col("topic").alias("name"), F.col("seq").alias("idx"), "t", "value"
    )


def _written(t) -> str:
    path = new_path(t.spark, "dataset")
    writers.write_dataset(_records(t), path)
    return path


@query(f"""WITH {LOG} SELECT 'log' AS run, 'sensors' AS "group", topic AS name, seq AS idx, t, value FROM log""")
def dataset_roundtrip(t):
    """Frame dataset written by run, group and name, and read back."""
    return readers.messages(t.spark, _written(t)).select("run", "group", "name", "idx", "t", "value")


@query("SELECT event_type AS run, 'site/run=' || event_type AS output, true AS found FROM events GROUP BY event_type")
def discover_runs(t):
    """Runs found below a root folder, with the relative path of their output."""
    path = new_path(t.spark, "runs")
    t.log().select(F.col("topic").alias("run"), "seq", "value").write.partitionBy("run").parquet(f"{path}/site")
    return readers.runs(t.spark, path).select("run", "output", (F.col("bytes") > 0).alias("found"))


READ_FRAME = 100


@query(
    f"""SELECT l_returnflag AS run, 'lines' AS "group", l_linestatus AS name, l_orderkey AS idx, l_linenumber, l_extendedprice
FROM lineitem WHERE l_orderkey = {READ_FRAME}"""
)
def read_frame(t):
    """One frame of a written dataset; the index reaches the file scan."""
    path = new_path(t.spark, "dataset")
    records = t.lineitem.select(
        F.col("l_returnflag").alias("run"), F.lit("lines").alias("group"), F.col("l_linestatus").alias("name"),
        F.col("l_orderkey").alias("idx"), "l_linenumber", "l_extendedprice",
    )
    writers.write_dataset(records, path)
    return readers.read_dataset(t.spark, path, READ_FRAME).select("run", "group", "name", "idx", "l_linenumber", "l_extendedprice")


@query(f"WITH {LOG} SELECT topic AS child, 'map' AS parent, seq, t, value AS x FROM log")
def tree_roundtrip(t):
    """Frame tree and its stamped poses, written by edge and read back."""
    path = new_path(t.spark, "tree")
    log = t.log()
    edges = log.select(F.col("topic").alias("child"), F.lit("map").alias("parent")).distinct()
    writers.write_tree(edges, log.select(F.col("topic").alias("child"), "seq", "t", F.col("value").alias("x")), path)
    edges, samples = readers.read_tree(t.spark, path)
    return join_hot(samples, edges, ["child"], ["seq"], "inner").select("child", "parent", "seq", "t", "x")


EXPORT_TOL = 12 * HOUR
# The catalogue of the export: two types, and one topic that feeds two outputs.
EXPORTED = [
    {"group": "state", "name": "speed", "topic": "click", "type": "Float32"},
    {"group": "state", "name": "speed_copy", "topic": "click", "type": "Float32"},
    {"group": "control", "name": "drive", "topic": "purchase", "type": "Command"},
]


@query(
    f"""WITH {BACK},
k AS (SELECT idx, target FROM m WHERE topic IN ('click', 'purchase') GROUP BY idx, target HAVING bool_and(coalesce(err < {EXPORT_TOL}, false))),
f AS (SELECT idx, row_number() OVER (ORDER BY target) - 1 AS frame FROM k),
w AS (SELECT topic, t AS match, arg_max(value, seq) AS value, arg_max(CAST(json_extract_string(props, '$.k') AS DOUBLE), seq) AS wz FROM log GROUP BY topic, t),
c AS (SELECT * FROM (VALUES ('state', 'speed', 'click'), ('state', 'speed_copy', 'click'), ('control', 'drive', 'purchase')) c("group", name, topic))
SELECT "group", name, frame AS idx, match AS t, CASE WHEN topic = 'click' THEN value END AS data,
  CASE WHEN topic = 'purchase' THEN value END AS vx, CASE WHEN topic = 'purchase' THEN wz END AS wz
FROM m JOIN f USING (idx) JOIN w USING (topic, match) JOIN c USING (topic)"""
)
def export_dataset(t):
    """Log exported by catalogue: synchronised, decoded by type, written and read back."""
    path, log = new_path(t.spark, "export"), t.log()
    k = F.get_json_object("props", "$.k").cast("double")
    zero = F.lit(0.0)

    def xyz(x, z):
        return F.struct(x.alias("x"), zero.alias("y"), z.alias("z"))

    payloads = {
        "Float32": ("click", F.struct(F.col("value").alias("data"))),
        "Command": ("purchase", F.struct(xyz(F.col("value"), zero).alias("linear"), xyz(zero, k).alias("angular"))),
    }
    messages = {
        name: log.filter(F.col("topic") == topic).select("topic", "seq", "t", payload.alias("payload"))
        for name, (topic, payload) in payloads.items()
    }
    export(messages, EXPORTED, HOUR, EXPORT_TOL, path, whole_log=log)
    speed, drive = [readers.read_dataset(t.spark, f"{path}/{name}") for name in payloads]
    both = speed.unionByName(drive, allowMissingColumns=True)
    return both.select("group", "name", "idx", "t", "data", "vx", "wz")


@query(
    f"""WITH {BACK}
SELECT topic, idx, coalesce(match / 1e6, -1) AS stamp, coalesce(err / 1e6, CAST('inf' AS DOUBLE)) AS err FROM m"""
)
def stamp_files(t):
    """Matched stamps and errors per topic, written as text and read back by line number."""
    path = new_path(t.spark, "stamps")
    writers.write_stamps(backward(t).withColumnRenamed("idx", "frame"), path)
    lines = readers.matrix(t.spark, path, 2, keys=("topic",))
    return lines.select("topic", "idx", F.get("values", F.lit(0)).alias("stamp"), F.get("values", F.lit(1)).alias("err"))


@query("SELECT CAST(s_nationkey AS BIGINT) AS idx, count(*) AS n_lines FROM supplier GROUP BY s_nationkey")
def scan_frames(t):
    """Frame files read by the index in their path."""
    path = new_path(t.spark, "frames")
    lines = t.supplier.select(
        stamps.frame_name(F.col("s_nationkey")).alias("frame"), F.concat_ws(" ", "s_suppkey", "s_acctbal").alias("value")
    )
    part = F.pmod(F.xxhash64("value"), F.lit(salts(t.spark)))
    lines.repartition("frame", part).write.partitionBy("frame").option("maxRecordsPerFile", 100_000).text(path)
    files = readers.frame_files(t.spark, path, "*.txt")
    n = F.size(F.filter(F.split(F.col("content").cast("string"), "\n"), lambda l: l != ""))
    return files.select("idx", n.alias("n")).groupBy("idx").agg(F.sum("n").alias("n_lines"))


@query("SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS idx, o_totalprice AS a, CAST(o_custkey AS DOUBLE) AS b FROM orders")
def scan_matrix(t):
    """Text matrix whose line number is the frame index."""
    path = new_path(t.spark, "matrix")
    writers.write_matrix(t.orders, path, "o_orderkey", ["o_totalprice", "o_custkey"])
    rows = readers.matrix(t.spark, path, 2)
    return rows.select("idx", F.get("values", F.lit(0)).alias("a"), F.get("values", F.lit(1)).alias("b"))


@query(
    "WITH p AS (SELECT vec_id, embedding AS e, unnest(range(0, 16)) AS pt FROM embeddings) "
    "SELECT vec_id, CAST(pt AS INTEGER) AS pt, e[4 * pt + 1] AS x, e[4 * pt + 2] AS y, e[4 * pt + 3] AS z FROM p"
)
def scan_points(t):
    """Points decoded from float32 bytes in rows of four."""
    files = t.embeddings.select("vec_id", writers.float32_bytes(F.col("embedding")).alias("content"))
    return readers.decode_points(files, "vec_id", "content", 4)


@query("SELECT CAST(o_orderkey AS DOUBLE) / 4 AS timestamp, o_totalprice AS x, 0.0::DOUBLE AS y, 1.0::DOUBLE AS qw FROM orders")
def scan_poses(t):
    """Space-delimited pose table."""
    path = new_path(t.spark, "poses")
    zero = F.lit(0.0)
    poses = t.orders.select(
        (F.col("o_orderkey").cast("double") / 4).alias("timestamp"), F.col("o_totalprice").alias("x"), zero.alias("y"), zero.alias("z"),
        zero.alias("qx"), zero.alias("qy"), zero.alias("qz"), F.lit(1.0).alias("qw"),
    )
    writers.write_poses(poses, path)
    return readers.poses(t.spark, path).select("timestamp", "x", "y", "qw")


@query("SELECT 0::BIGINT AS only_first, 0::BIGINT AS only_second, count(*) AS n_distinct FROM (SELECT DISTINCT o_orderkey, o_custkey, o_totalprice FROM orders)")
def reencode_verify(t):
    """Dataset written in another encoding and compared with its source, both ways."""
    path = new_path(t.spark, "reencoded")
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    rows.write.option("compression", "zstd").parquet(path)
    return audit.difference(rows, t.spark.read.parquet(path))


@query("SELECT o_custkey % 3 AS run, o_orderkey AS idx, o_totalprice FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity = 50 AND l_orderkey % 7 = 0)")
def read_pruned(t):
    """Asked frames of a dataset, from the files that hold them."""
    store = FrameStore(t.spark, new_path(t.spark, "frames"), ["run"], block=64)
    store.upsert(t.orders.select((F.col("o_custkey") % 3).alias("run"), F.col("o_orderkey").alias("idx"), "o_totalprice"))
    asked = t.lineitem.filter((F.col("l_quantity") == 50) & (F.col("l_orderkey") % 7 == 0)).select(F.col("l_orderkey").alias("idx"))
    return store.read_frames(asked)


@query(
    f"""WITH {LOG}
SELECT topic, seq AS idx, t, CASE WHEN seq % 1000 < 100 THEN -value ELSE value END AS value FROM log WHERE seq % 3 > 0 OR seq % 1000 < 100"""
)
def dataset_upsert(t):
    """Frames written into an existing dataset, replacing and adding; a write that dies before its commit leaves no trace."""
    store = FrameStore(t.spark, new_path(t.spark, "frames"), ["topic"], block=256)
    rows = t.log().select("topic", F.col("seq").alias("idx"), "t", "value")
    store.upsert(rows.filter("idx % 3 > 0"))
    # What a killed writer leaves: files of data that no commit names.
    lost = store._blocked(rows.withColumn("value", F.lit(0.0)))
    lost.write.parquet(f"{store.path}/data/killed")
    store.upsert(rows.filter("idx % 1000 < 100").withColumn("value", -F.col("value")))
    return store.read().select("topic", "idx", "t", "value")


@query(f"WITH {LOG} SELECT topic, seq AS idx, CASE WHEN seq % 2 = 0 THEN 1 ELSE 2 END AS attempt FROM log")
def resume_commit(t):
    """An interrupted run resumed: frames of the first attempt stay, the others come from the second."""
    store = FrameStore(t.spark, new_path(t.spark, "frames"), ["topic"])
    rows = t.log().select("topic", F.col("seq").alias("idx"))
    store.upsert(rows.filter("idx % 2 = 0").withColumn("attempt", F.lit(1)))
    store.resume(rows.withColumn("attempt", F.lit(2)))
    return store.read()
