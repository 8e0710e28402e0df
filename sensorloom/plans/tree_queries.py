"""Queries on frame trees: paths, intervals, upserts and transforms."""

from __future__ import annotations

import operator

from pyspark.sql import functions as F

from sensorloom.functions.geometry import euler_quaternion, matrix_position, matrix_quaternion, pose_matrix
from sensorloom.operators import asof, lifting, sync, tree
from sensorloom.operators.ordered import Scan, running
from sensorloom.plans.export import synchronise
from sensorloom.plans.registry import EDGES, HOUR, LOG, SECOND, TOPIC_ROWS, TOPICS, query
from sensorloom.session import cut_lineage

HALF_SECOND = SECOND // 2

PATHS = f"""{EDGES},
paths AS (SELECT c_name AS node, [r_name, n_name, c_name] AS path FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT n_name, [r_name, n_name] FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT r_name, [r_name] FROM region)"""


def _next_customers(t):
    """Pairs of each customer with the one of the next key."""
    a = t.customer.select("c_custkey", F.col("c_name").alias("f1"))
    b = t.customer.select((F.col("c_custkey") - 1).alias("c_custkey"), F.col("c_name").alias("f2"))
    return a.join(b, "c_custkey").select("f1", "f2")


NEXT = "pairs AS (SELECT a.c_name AS f1, b.c_name AS f2 FROM customer a JOIN customer b ON b.c_custkey = a.c_custkey + 1)"


@query(f"WITH {PATHS} SELECT node, 'map' AS root, CAST(len(path) - 1 AS INTEGER) AS depth FROM paths")
def tree_depth(t):
    """Depth of every frame below its root."""
    return lifting.depths(lifting.ancestors(t.edges()))


@query(
    f"""WITH {PATHS}, {NEXT},
j AS (SELECT f1, f2, a.path AS p1, b.path AS p2, CASE WHEN a.path[2] = b.path[2] THEN 2 WHEN a.path[1] = b.path[1] THEN 1 ELSE 0 END AS d
  FROM pairs JOIN paths a ON a.node = f1 JOIN paths b ON b.node = f2)
SELECT f1, f2, CAST(d AS INTEGER) AS lca_depth, CASE WHEN d = 0 THEN 'map' ELSE p1[d] END AS lca,
  array_to_string(p1[d + 1:], '>') AS up, array_to_string(p2[d + 1:], '>') AS down FROM j"""
)
def tree_lca(t):
    """Paths below the lowest common ancestor of neighbouring customers."""
    branches = tree.branch_paths(_next_customers(t), tree.root_paths(t.edges()))
    return branches.select(
        "f1", "f2", "lca_depth", "lca", F.array_join("up", ">").alias("up"), F.array_join("down", ">").alias("down")
    )


@query(
    f"""WITH {PATHS}
SELECT array_to_string(list_concat(['map'], path), chr(1)) AS sort_key, repeat('- ', len(path)) || node AS line FROM paths
UNION ALL SELECT 'map', 'map'"""
)
def tree_render(t):
    """Indented listing of the tree with its depth-first sort key."""
    return tree.render(tree.root_paths(t.edges())).select("sort_key", "line")


@query(f"WITH {EDGES} SELECT DISTINCT parent AS frame FROM edges WHERE parent NOT IN (SELECT child FROM edges)")
def tree_roots(t):
    """Frames that top the tree."""
    return tree.roots(t.edges())


@query(
    f"""WITH {EDGES}, q AS (SELECT c_name AS frame FROM customer UNION ALL SELECT s_name FROM supplier UNION ALL SELECT 'map')
SELECT frame, frame IN (SELECT child FROM edges UNION SELECT parent FROM edges) AS known FROM q"""
)
def has_frame(t):
    """Which of the asked frames the tree knows, as child or parent."""
    asked = t.customer.select(F.col("c_name").alias("frame")).union(t.supplier.select("s_name"))
    asked = asked.union(t.region.select(F.lit("map").alias("frame")).distinct())
    return tree.has_frame(asked, t.edges())


@query(f"WITH {EDGES} SELECT child AS frame FROM edges UNION SELECT parent FROM edges")
def frame_set(t):
    """Distinct frame ids over both ends of the edges."""
    return tree.frames(t.edges())


@query(
    """SELECT replace('/' || r_name || '/' || n_name, '/', '-') || '_to_' || replace(n_name || '/base', '/', '-') AS folder
FROM nation JOIN region ON n_regionkey = r_regionkey"""
)
def tf_path_names(t):
    """Folder name per edge, slashes replaced."""
    edges = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.concat(F.lit("/"), "r_name", F.lit("/"), "n_name").alias("parent"), F.concat("n_name", F.lit("/base")).alias("child")
    )
    return edges.select(tree.edge_directory(F.col("parent"), F.col("child")).alias("folder"))


@query(
    """WITH o AS (SELECT s_suppkey AS child, s_nationkey AS parent FROM supplier), n AS (SELECT c_custkey AS child, c_nationkey AS parent FROM customer)
SELECT child, coalesce(n.parent, o.parent) AS parent, coalesce(o.parent <> n.parent, false) AS rewired FROM o FULL JOIN n USING (child)"""
)
def edge_upsert(t):
    """New edges replace old ones; changed parents are flagged."""
    old = t.supplier.select(F.col("s_suppkey").alias("child"), F.col("s_nationkey").alias("parent"))
    new = t.customer.select(F.col("c_custkey").alias("child"), F.col("c_nationkey").alias("parent"))
    return tree.upsert_edges(old, new)


@query(
    """WITH o AS (SELECT s_suppkey AS child, CASE WHEN s_suppkey % 7 = 0 THEN '/ROOT' ELSE 'n' || (s_nationkey % 3) END AS parent, s_acctbal > 4000 AS is_static, s_acctbal AS value FROM supplier),
c AS (SELECT c_custkey AS child, 'n' || (c_nationkey % 3) AS parent, c_acctbal AS value FROM customer),
j AS (SELECT child, o.parent AS op, o.is_static AS os, o.value AS ov, c.parent AS cp, c.value AS cv,
  CASE WHEN c.parent IS NULL THEN 'keep' WHEN o.parent IS NULL THEN 'insert' WHEN NOT o.is_static THEN 'skip_dynamic'
       WHEN o.parent <> c.parent AND o.parent <> '/ROOT' THEN 'skip_parent' ELSE 'update' END AS action FROM o FULL JOIN c USING (child))
SELECT child, CASE WHEN action IN ('insert', 'update') THEN cp ELSE op END AS parent,
  CASE WHEN action IN ('insert', 'update') THEN true ELSE os END AS is_static,
  CASE WHEN action IN ('insert', 'update') THEN cv ELSE ov END AS value, action FROM j"""
)
def calib_upsert(t):
    """Calibrated edges merged under the rules for dynamic and rewired edges."""
    old = t.supplier.select(
        F.col("s_suppkey").alias("child"),
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(tree.UNATTACHED))
        .otherwise(F.concat(F.lit("n"), (F.col("s_nationkey") % 3).cast("string")))
        .alias("parent"),
        (F.col("s_acctbal") > 4000).alias("is_static"),
        F.col("s_acctbal").alias("value"),
    )
    calib = t.customer.select(
        F.col("c_custkey").alias("child"),
        F.concat(F.lit("n"), (F.col("c_nationkey") % 3).cast("string")).alias("parent"),
        F.col("c_acctbal").alias("value"),
    )
    return tree.apply_calibration(old, calib)


@query(
    f"""WITH {LOG}
SELECT run, run % 10 = 0 AS is_static, CASE WHEN run % 10 = 0 THEN CAST('-inf' AS DOUBLE) ELSE CAST(min(t) AS DOUBLE) - {HALF_SECOND} END AS t_min,
  CASE WHEN run % 10 = 0 THEN CAST('inf' AS DOUBLE) ELSE CAST(max(t) AS DOUBLE) + {HALF_SECOND} END AS t_max FROM log GROUP BY run"""
)
def edge_bounds(t):
    """Usable interval per edge; every tenth edge is static."""
    return tree.edge_bounds(t.log(), ["run"], float(HALF_SECOND), F.col("run") % 10 == 0)


def _chains(t):
    """Every message's frame hangs below that of the topic's previous message, the first below map, turned and shifted."""
    log = t.log().select("topic", "seq", "value")
    before = running(log, ["topic"], ["seq"], {"prev": Scan("lag", "seq")})
    yaw, zero = (F.col("seq") % 7 - 3) * 0.01, F.lit(0.0)
    q = euler_quaternion(zero, zero, yaw)
    return before.select(
        "seq", F.col("seq").cast("string").alias("child"), F.coalesce(F.col("prev").cast("string"), F.lit("map")).alias("parent"),
        (F.col("seq") % 5).cast("double").alias("x"), (F.col("seq") % 3 - 1).cast("double").alias("y"), F.lit(0.25).alias("z"),
        *[c.alias(n) for c, n in zip(q, ("qx", "qy", "qz", "qw"))],
    )


CHAINS = f"""{LOG},
c AS (SELECT topic, seq, seq % 5 AS dx, seq % 3 - 1 AS dy, (seq % 7 - 3) * CAST(0.01 AS DOUBLE) AS yaw, row_number() OVER w AS depth,
  coalesce(sum((seq % 7 - 3) * CAST(0.01 AS DOUBLE)) OVER (PARTITION BY topic ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
  FROM log WINDOW w AS (PARTITION BY topic ORDER BY seq))"""


@query(
    f"""WITH {CHAINS}, n AS (SELECT a.seq AS s1, b.seq AS s2, a.topic = b.topic AS same, a.depth AS d1, b.depth AS d2 FROM c a JOIN c b ON b.seq = a.seq + 1)
SELECT CAST(s1 AS VARCHAR) AS f1, CAST(s2 AS VARCHAR) AS f2, CASE WHEN same THEN CAST(s1 AS VARCHAR) ELSE 'map' END AS lca,
  CAST(CASE WHEN same THEN d1 ELSE 0 END AS INTEGER) AS lca_depth, CAST(CASE WHEN same THEN d2 - d1 ELSE d1 + d2 END AS BIGINT) AS hops FROM n"""
)
def chain_ancestor(t):
    """Lowest common ancestor of neighbouring messages in chains as deep as a topic has messages, and the edges between."""
    edges = cut_lineage(_chains(t).select("child", "parent", F.lit(1).cast("bigint").alias("hops"), "seq"))
    seq = t.log().select("seq")
    pairs = seq.join(seq.select((F.col("seq") - 1).alias("seq")), "seq").select(
        F.col("seq").cast("string").alias("f1"), (F.col("seq") + 1).cast("string").alias("f2")
    )
    return lifting.common_ancestor(pairs, lifting.ancestors(edges, {"hops": operator.add}, order=["seq"]))


@query(
    f"""WITH {CHAINS}
SELECT CAST(seq AS VARCHAR) AS node, CAST(depth - 1 AS INTEGER) AS depth,
  round(sum(cos(above) * dx - sin(above) * dy) OVER w, 3) + 0.0 AS x, round(sum(sin(above) * dx + cos(above) * dy) OVER w, 3) + 0.0 AS y,
  round(0.25::DOUBLE * depth, 3) + 0.0 AS z, round(cos(above + yaw), 6) + 0.0 AS m00 FROM c WINDOW w AS (PARTITION BY topic ORDER BY seq)"""
)
def chain_pose(t):
    """Pose of every message's frame in the map, along chains as deep as a topic has messages."""
    pose = [F.col(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]
    edges = _chains(t).select("child", "parent", "seq", pose_matrix(*pose).alias("matrix"))
    table = lifting.ancestors(edges, lifting.PRODUCT, order=["seq"])
    x, y, z = matrix_position(F.col("matrix"))
    cells = {"x": F.round(x, 3), "y": F.round(y, 3), "z": F.round(z, 3), "m00": F.round(F.get("matrix", F.lit(0)), 6)}
    return table.tops.select("node", (F.col("steps") - 1).cast("int").alias("depth"), *[(c + 0.0).alias(n) for n, c in cells.items()])


def _user(run):
    return F.concat(F.lit("u"), run.cast("string"))


def _group(run):
    return F.concat(F.lit("g"), (run % 10).cast("string"))


def _sensor_edges(t):
    """Frames map > g0…g9 (static) > one dynamic frame per run."""
    runs = t.log().select("run").distinct()
    users = runs.select(_user(F.col("run")).alias("child"), _group(F.col("run")).alias("parent"))
    groups = users.select(F.col("parent").alias("child")).distinct().withColumn("parent", F.lit("map"))
    return cut_lineage(users.unionByName(groups))


def _sensor_bounds(t):
    moving = tree.edge_bounds(t.log(), ["run"], float(HALF_SECOND), F.lit(False)).select(
        _user(F.col("run")).alias("frame"), "t_min", "t_max"
    )
    fixed = t.log().select(_group(F.col("run")).alias("frame")).distinct()
    fixed = fixed.select("frame", F.lit(-tree.INF).alias("t_min"), F.lit(tree.INF).alias("t_max"))
    return cut_lineage(moving.unionByName(fixed))


def _sensor_pairs(t):
    runs = t.log().select("run").distinct()
    following = runs.select(_user(F.col("run")).alias("f1"), _user(F.col("run") + 1).alias("f2"))
    itself = runs.select(_user(F.col("run")).alias("f1"), _user(F.col("run")).alias("f2"))
    return following.union(itself)


BOUNDS = f"""{LOG}, bd AS (SELECT run, CAST(min(t) AS DOUBLE) - {HALF_SECOND} AS lo, CAST(max(t) AS DOUBLE) + {HALF_SECOND} AS hi FROM log GROUP BY run)"""


@query(
    f"""WITH {BOUNDS}
SELECT 'u' || a.run AS f1, 'u' || (a.run + 1) AS f2, CASE WHEN b.run IS NULL THEN CAST('inf' AS DOUBLE) ELSE greatest(a.lo, b.lo) END AS t_min,
  CASE WHEN b.run IS NULL THEN CAST('-inf' AS DOUBLE) ELSE least(a.hi, b.hi) END AS t_max FROM bd a LEFT JOIN bd b ON b.run = a.run + 1
UNION ALL SELECT 'u' || run, 'u' || run, CAST('-inf' AS DOUBLE), CAST('inf' AS DOUBLE) FROM bd"""
)
def tf_interval(t):
    """Interval in which neighbouring sensors can be related; unlimited for one frame, empty if unconnected."""
    return tree.path_interval(_sensor_pairs(t), _sensor_edges(t), _sensor_bounds(t))


@query(f"WITH {BOUNDS} SELECT max(lo) AS t_min, min(hi) AS t_max FROM bd")
def tf_interval_list(t):
    """Interval in which all sensors can be related; unknown frames do not count."""
    edges = _sensor_edges(t)
    asked = edges.select(F.col("child").alias("frame")).union(t.region.select("r_name"))
    return tree.frames_interval(asked, edges, _sensor_bounds(t))


@query(
    f"""WITH {BOUNDS}, iv AS (SELECT max(lo) AS t_min, min(hi) AS t_max FROM bd),
b AS (SELECT min(t) AS s, max(t) AS e FROM log),
steps AS (SELECT s, unnest(range(0, CAST((e - s + {HOUR - 1}) // {HOUR} AS BIGINT))) AS idx FROM b),
tg AS (SELECT topic, idx, s + idx * {HOUR} AS target FROM steps CROSS JOIN {TOPIC_ROWS}),
m AS (SELECT tg.topic, idx, target, log.t AS match, target - log.t AS err FROM tg ASOF LEFT JOIN log ON tg.topic = log.topic AND log.t <= tg.target),
k AS (SELECT idx, target FROM m, iv GROUP BY idx, target HAVING bool_and(coalesce(err < {12 * HOUR} AND match > t_min AND match < t_max, false)))
SELECT idx, target, row_number() OVER (ORDER BY target) - 1 AS frame FROM k"""
)
def export_frames(t):
    """Frames of a synchronised export: topics in tolerance while all sensors can be related."""
    edges = _sensor_edges(t)
    interval = tree.frames_interval(edges.select(F.col("child").alias("frame")), edges, _sensor_bounds(t))
    done = synchronise(t.log(), TOPICS, HOUR, 12 * HOUR, interval=interval)
    return done.frames.select("idx", "target", "frame")


@query(
    f"""WITH {BOUNDS}, iv AS (SELECT max(lo) AS t_min, min(hi) AS t_max FROM bd),
b AS (SELECT min(t) AS s, max(t) AS e FROM log),
steps AS (SELECT s, unnest(range(0, CAST((e - s + {HOUR - 1}) // {HOUR} AS BIGINT))) AS idx FROM b)
SELECT min(idx) FILTER (WHERE s + idx * {HOUR} > t_min) AS first_idx, max(idx) FILTER (WHERE s + idx * {HOUR} < t_max) AS last_idx FROM steps, iv"""
)
def interval_marks(t):
    """First and last grid step inside the interval in which all sensors can be related."""
    edges = _sensor_edges(t)
    interval = tree.frames_interval(edges.select(F.col("child").alias("frame")), edges, _sensor_bounds(t))
    grid = asof.time_grid(asof.grid_bounds(t.log(), [], "t", HOUR), [], HOUR)
    return sync.interval_edges(asof.with_single(grid, interval), F.col("t_min"), F.col("t_max"))


@query(
    f"""WITH {BOUNDS}
SELECT seq, coalesce(t BETWEEN lo AND hi, false) AS ok FROM log LEFT JOIN bd ON bd.run = log.run + 1"""
)
def can_transform(t):
    """Whether each message can be related to the next sensor at its stamp."""
    bounds = _sensor_bounds(t)
    asked = t.log().select("seq", "t", _user(F.col("run") + 1).alias("frame"))
    joined = tree.join_hot(asked, bounds, ["frame"], ["seq"])
    ok = tree.can_transform(F.col("t").cast("double"), F.col("t_min"), F.col("t_max"))
    return joined.select("seq", F.coalesce(ok, F.lit(False)).alias("ok"))


def _posed_edges(t):
    """The customer tree with a yaw and an offset per edge."""
    zero = F.lit(0.0)

    def pose(df, child, yaw, x, y, z):
        q = euler_quaternion(zero, zero, yaw)
        return df.select(
            F.col(child).alias("child"), x.alias("x"), y.alias("y"), z.alias("z"),
            *[c.alias(n) for c, n in zip(q, ("qx", "qy", "qz", "qw"))],
        )

    r, n, c = F.col("r_regionkey").cast("double"), F.col("n_nationkey").cast("double"), F.col("c_acctbal")
    return (
        pose(t.region, "r_name", r * 0.1, r, F.lit(1.0), F.lit(0.5))
        .unionByName(pose(t.nation, "n_name", n * 0.01, n, n * 0.5, F.lit(0.25)))
        .unionByName(pose(t.customer, "c_name", c / 10000, c / 100, c / 200, c / 1000))
    )


@query(
    f"""WITH {NEXT},
e AS (SELECT c_name AS node, r_regionkey * 0.1 AS a1, r_regionkey AS x1, n_nationkey * 0.01 AS a2, CAST(n_nationkey AS DOUBLE) AS x2, c_acctbal / 10000 AS a3, c_acctbal AS c
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
w AS (SELECT node, a1 + a2 + a3 AS a,
  x1 + cos(a1) * x2 - sin(a1) * (x2 * 0.5) + cos(a1 + a2) * (c / 100) - sin(a1 + a2) * (c / 200) AS x,
  1 + sin(a1) * x2 + cos(a1) * (x2 * 0.5) + sin(a1 + a2) * (c / 100) + cos(a1 + a2) * (c / 200) AS y, 0.75 + c / 1000 AS z FROM e)
SELECT f1, f2, round(cos(q.a - p.a), 6) + 0.0 AS m00, round(sin(q.a - p.a), 6) + 0.0 AS m10,
  round(cos(p.a) * (q.x - p.x) + sin(p.a) * (q.y - p.y), 6) + 0.0 AS x, round(cos(p.a) * (q.y - p.y) - sin(p.a) * (q.x - p.x), 6) + 0.0 AS y, round(q.z - p.z, 6) + 0.0 AS z
FROM pairs JOIN w p ON p.node = f1 JOIN w q ON q.node = f2"""
)
def compose_path(t):
    """Transform between neighbouring customers along the tree."""
    out = tree.chain_transform(_next_customers(t), t.edges(), tree.static_matrices(_posed_edges(t)))
    cells = {"m00": 0, "m10": 4, "x": 3, "y": 7, "z": 11}
    return out.select("f1", "f2", *[(F.round(F.get("matrix", F.lit(i)), 6) + 0.0).alias(n) for n, i in cells.items()])


@query(
    f"""WITH {EDGES},
p AS (SELECT r_name AS child, CAST(r_regionkey AS DOUBLE) * 0.1 AS a, CAST(r_regionkey AS DOUBLE) AS x, 1.0::DOUBLE AS y, 0.5::DOUBLE AS z FROM region
  UNION ALL SELECT n_name, CAST(n_nationkey AS DOUBLE) * 0.01, CAST(n_nationkey AS DOUBLE), CAST(n_nationkey AS DOUBLE) * 0.5, 0.25::DOUBLE FROM nation
  UNION ALL SELECT c_name, c_acctbal / 10000, c_acctbal / 100, c_acctbal / 200, c_acctbal / 1000 FROM customer),
e AS (SELECT child, parent, x, y, z, 0.0::DOUBLE AS qx, 0.0::DOUBLE AS qy, sin(a / 2) AS qz, cos(a / 2) AS qw FROM edges JOIN p USING (child)
  UNION ALL SELECT 'map_ned', 'map', 0, 0, 0, -0.5, -0.5, -0.5, 0.5)
SELECT child, parent, true AS is_static, {", ".join(f"round({c}, 9) + 0.0 AS {c}" for c in ("x", "y", "z", "qx", "qy", "qz", "qw"))} FROM e"""
)
def camera_ned(t):
    """The tree with a frame in north-east-down axes added to its root."""
    posed = t.edges().withColumn("is_static", F.lit(True)).join(_posed_edges(t), "child")
    out = tree.camera_ned_edge(posed, "map")
    return out.select(
        "child", "parent", "is_static", *[(F.round(c, 9) + 0.0).alias(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]
    )


def _sensor_transforms(t):
    """Transform of every sensor to the next one at each of its stamps."""
    log = t.log()
    k = F.get_json_object("props", "$.k").cast("double")
    zero, one = F.lit(0.0), F.lit(1.0)
    samples = log.select(
        _user(F.col("run")).alias("frame"), "seq", "t", F.col("value").alias("x"), k.alias("y"), zero.alias("z"),
        zero.alias("qx"), zero.alias("qy"), zero.alias("qz"), one.alias("qw"),
    )
    groups = log.select(_group(F.col("run")).alias("child"), (F.col("run") % 10).cast("double").alias("x")).distinct()
    fixed = tree.static_matrices(
        groups.select("child", "x", zero.alias("y"), one.alias("z"), zero.alias("qx"), zero.alias("qy"), zero.alias("qz"), one.alias("qw"))
    )
    asked = log.select(_user(F.col("run")).alias("f1"), _user(F.col("run") + 1).alias("f2"), "t", "seq", "value")
    paths = tree.root_paths(_sensor_edges(t))
    return tree.transform_at(asked, paths, samples, fixed, HALF_SECOND)


SENSOR = f"""{LOG}, s AS (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, run + 1 AS nrun FROM log),
known AS (SELECT DISTINCT run FROM log),
p AS (SELECT s.*, b.t AS pt, b.value AS pv, b.k AS pk FROM s ASOF LEFT JOIN s b ON s.nrun = b.run AND b.t <= s.t),
n AS (SELECT p.*, b.t AS nt, b.value AS nv, b.k AS nk FROM p ASOF LEFT JOIN s b ON p.nrun = b.run AND b.t >= p.t),
i AS (SELECT seq, run, nrun, t, value, k,
  CASE WHEN pt IS NULL THEN CASE WHEN nt - t <= {HALF_SECOND} THEN nv END WHEN nt IS NULL THEN CASE WHEN t - pt <= {HALF_SECOND} THEN pv END
       WHEN pt = nt THEN pv ELSE pv + (nv - pv) * (CAST(t - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END AS x2,
  CASE WHEN pt IS NULL THEN CASE WHEN nt - t <= {HALF_SECOND} THEN nk END WHEN nt IS NULL THEN CASE WHEN t - pt <= {HALF_SECOND} THEN pk END
       WHEN pt = nt THEN pk ELSE pk + (nk - pk) * (CAST(t - pt AS DOUBLE) / CAST(nt - pt AS DOUBLE)) END AS y2 FROM n)"""


@query(
    f"""WITH {SENSOR}
SELECT seq, round((nrun % 10 + x2) - (run % 10 + value), 6) + 0.0 AS x, round(y2 - k, 6) + 0.0 AS y FROM i WHERE x2 IS NOT NULL"""
)
def transform_at(t):
    """Offset to the next sensor at each message, where it can be interpolated."""
    out = _sensor_transforms(t).filter("known")
    x, y, _ = matrix_position(F.col("matrix"))
    return out.select("seq", (F.round(x, 6) + 0.0).alias("x"), (F.round(y, 6) + 0.0).alias("y"))


@query(
    f"""WITH {SENSOR}
SELECT seq, value AS odom_x, round((nrun % 10 + x2) - (run % 10 + value), 6) + 0.0 AS cam_x, CASE WHEN x2 IS NOT NULL THEN 1.0::DOUBLE END AS cam_qw FROM i"""
)
def pose_lookup(t):
    """Odometry of each message with the camera pose at its stamp, null if unknown."""
    out = _sensor_transforms(t)
    x = matrix_position(F.col("matrix"))[0]
    return out.select(
        "seq", F.col("value").alias("odom_x"), (F.round(x, 6) + 0.0).alias("cam_x"), F.round(matrix_quaternion(F.col("matrix"))[3], 6).alias("cam_qw")
    )
