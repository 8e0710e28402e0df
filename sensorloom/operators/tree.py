"""Trees of coordinate frames: edges ``(child, parent)``, root paths and transforms along them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sensorloom.functions.geometry import CAMERA_TO_NED, pose_matrix
from sensorloom.operators.asof import with_single
from sensorloom.operators.legs import around, compose, hot_frames, pair_legs
from sensorloom.operators.lifting import BOUNDS, PRODUCT, ancestors, common_ancestor, relate
from sensorloom.operators.skew import join_hot
from sensorloom.session import cut_lineage

INF = float("inf")
# Parts of a sort key are joined by a character below all others, so that a frame comes right before its children.
BELOW_ALL = "\x01"


def roots(edges: DataFrame) -> DataFrame:
    """Parents that are no child themselves."""
    parents = edges.select(F.col("parent").alias("frame")).distinct()
    return parents.join(edges.select(F.col("child").alias("frame")), "frame", "left_anti")


def frames(edges: DataFrame) -> DataFrame:
    """Every frame that is a child or a parent."""
    return edges.select(F.col("child").alias("frame")).union(edges.select("parent")).distinct()


def has_frame(queried: DataFrame, edges: DataFrame) -> DataFrame:
    """Queried frames with a flag telling whether the tree knows them."""
    known = frames(edges).withColumn("known", F.lit(True))
    return queried.join(known, "frame", "left").withColumn("known", F.coalesce("known", F.lit(False)))


def root_paths(edges: DataFrame) -> DataFrame:
    """``node, root, path, cyclic`` with ``path`` from below the root down to the node.

    Paths are doubled per round, so the number of joins is the logarithm of the depth, which
    has no limit.  A frame that is its own parent ends its branch.  Depths have no gaps, so a
    round that settles no frame leaves only those on or below a longer cycle; they have
    ``cyclic`` set, and null root and path.
    """
    inner = edges.select("parent").distinct().join(
        edges.select(F.col("child").alias("parent")), "parent", "left_semi"
    )
    paths = (
        join_hot(edges.select("child", "parent"), inner.withColumn("_inner", F.lit(True)), ["parent"], ["child"])
        .select(
            F.col("child").alias("node"),
            F.col("parent").alias("top"),
            F.array("child").alias("path"),
            (F.col("_inner").isNull() | (F.col("child") == F.col("parent"))).alias("done"),
        )
    )
    paths, n_open = _settle(paths)
    before = None
    while n_open and n_open != before:
        pending = paths.filter(~F.col("done"))
        upper = paths.select(
            F.col("node").alias("top"),
            F.col("top").alias("_top"),
            F.col("path").alias("_path"),
            F.col("done").alias("_done"),
        ).join(pending.select("top").distinct(), "top", "left_semi")
        pending = join_hot(pending, upper, ["top"], ["node"], "inner").select(
            "node",
            F.col("_top").alias("top"),
            F.concat("_path", "path").alias("path"),
            F.col("_done").alias("done"),
        )
        before = n_open
        paths, n_open = _settle(paths.filter("done").unionByName(pending))
    return paths.select(
        "node",
        F.when(F.col("done"), F.col("top")).alias("root"),
        F.when(F.col("done"), F.col("path")).alias("path"),
        (~F.col("done")).alias("cyclic"),
    )


def _settle(paths: DataFrame) -> tuple[DataFrame, int]:
    """Store the paths and count the unfinished ones in the same job."""
    seen = Observation()
    stored = cut_lineage(paths.observe(seen, F.count_if(~F.col("done")).alias("n_open")))
    return stored, seen.get["n_open"]


def branch_paths(pairs: DataFrame, paths: DataFrame) -> DataFrame:
    """For pairs ``(f1, f2)`` the nodes below their lowest common ancestor on either side.

    A frame without own path is taken as a root.  Pairs under different roots have null sides.
    """
    side = paths.select("node", "root", "path")

    def attach(df, f, n):
        p = side.select(F.col("node").alias(f), F.col("root").alias(f"_r{n}"), F.col("path").alias(f"_p{n}"))
        return join_hot(df, p, [f], ["f1", "f2"])

    both = attach(attach(pairs, "f1", 1), "f2", 2)
    empty = F.expr("cast(array() as array<string>)")
    r1, r2 = F.coalesce("_r1", "f1"), F.coalesce("_r2", "f2")
    p1, p2 = F.coalesce("_p1", empty), F.coalesce("_p2", empty)
    same = r1 == r2
    shared = F.size(F.array_intersect(p1, p2))
    return both.select(
        *pairs.columns,
        F.when(same, shared).alias("lca_depth"),
        F.when(same, F.when(shared == 0, r1).otherwise(F.get(p1, shared - 1))).alias("lca"),
        F.when(same, F.filter(p1, lambda x, i: i >= shared)).alias("up"),
        F.when(same, F.filter(p2, lambda x, i: i >= shared)).alias("down"),
    )


def edge_bounds(samples: DataFrame, keys: list[str], tol: float, is_static: Column) -> DataFrame:
    """Usable time interval per edge; unlimited for static ones."""
    return (
        samples.groupBy(*keys)
        .agg(F.min("t").alias("_lo"), F.max("t").alias("_hi"), F.bool_or(is_static).alias("is_static"))
        .select(
            *keys,
            "is_static",
            F.when(F.col("is_static"), F.lit(-INF)).otherwise(F.col("_lo").cast("double") - tol).alias("t_min"),
            F.when(F.col("is_static"), F.lit(INF)).otherwise(F.col("_hi").cast("double") + tol).alias("t_max"),
        )
    )


def path_interval(pairs: DataFrame, edges: DataFrame, bounds: DataFrame) -> DataFrame:
    """Interval in which all edges between two frames exist, per distinct pair ``f1, f2``.

    Unlimited for one and the same frame, empty (inf, -inf) when the frames are unconnected.
    ``bounds`` is keyed by the child frame in column ``frame``; an edge without is unlimited.
    """
    limits = bounds.select(F.col("frame").alias("child"), "t_min", "t_max")
    table = ancestors(edges.select("child", "parent").join(limits, "child", "left"), BOUNDS)
    cut = common_ancestor(pairs, table)
    met = F.col("lca").isNotNull()
    return cut.select(
        "f1",
        "f2",
        F.when(met, F.coalesce("t_min", F.lit(-INF))).otherwise(F.lit(INF)).alias("t_min"),
        F.when(met, F.coalesce("t_max", F.lit(INF))).otherwise(F.lit(-INF)).alias("t_max"),
    )


def frames_interval(asked: DataFrame, edges: DataFrame, bounds: DataFrame) -> DataFrame:
    """Interval in which all asked frames can be related, as one row; unknown frames are ignored."""
    known = asked.select("frame").distinct().join(frames(edges), "frame", "left_semi")
    pairs = with_single(known, known.agg(F.min("frame").alias("f2"))).withColumnRenamed("frame", "f1")
    cut = path_interval(pairs, edges, bounds)
    return cut.agg(
        F.coalesce(F.max("t_min"), F.lit(-INF)).alias("t_min"), F.coalesce(F.min("t_max"), F.lit(INF)).alias("t_max")
    )


def can_transform(t: Column, t_min: Column, t_max: Column) -> Column:
    """Inclusive bounds."""
    return t.between(t_min, t_max)


def path_steps(branches: DataFrame, key: list[str]) -> DataFrame:
    """The edges between two frames in order, as ``key, pos, frame, up``.

    ``pos`` is null for a pair without edges, that is for one and the same frame.
    """
    hops = F.concat(
        F.transform(F.reverse("up"), lambda f: F.struct(f.alias("frame"), F.lit(True).alias("up"))),
        F.transform("down", lambda f: F.struct(f.alias("frame"), F.lit(False).alias("up"))),
    )
    return branches.select(*key, F.posexplode_outer(hops).alias("pos", "hop")).select(*key, "pos", "hop.frame", "hop.up")


def chain_transform(pairs: DataFrame, edges: DataFrame, statics: DataFrame) -> DataFrame:
    """Pairs with the matrix from ``f1`` to ``f2`` over static edges, null where there is no such path."""
    return relate(pairs, ancestors(static_edges(edges, statics), PRODUCT))


def static_edges(edges: DataFrame, statics: DataFrame) -> DataFrame:
    """Edges whose ``frame`` has a matrix, with it."""
    return edges.select("child", "parent").join(statics.select(F.col("frame").alias("child"), "matrix"), "child")


def static_matrices(edges: DataFrame, frame: str = "child") -> DataFrame:
    """Matrix per edge of a table with pose columns."""
    pose = [F.col(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")]
    return edges.select(F.col(frame).alias("frame"), pose_matrix(*pose).alias("matrix"))


def render(paths: DataFrame) -> DataFrame:
    """One line per frame, indented by depth, with a sort key for depth-first order."""
    top = paths.select("root").distinct().select(
        F.col("root").alias("node"), F.col("root").alias("sort_key"), F.lit(0).alias("level")
    )
    rest = paths.select(
        "node", F.concat_ws(BELOW_ALL, "root", "path").alias("sort_key"), F.size("path").alias("level")
    )
    return top.unionByName(rest).withColumn(
        "line", F.concat(F.expr("repeat('- ', level)"), F.col("node"))
    )


def edge_directory(parent: Column, child: Column) -> Column:
    """Folder name of an edge."""
    return F.concat_ws("_to_", F.replace(parent, F.lit("/"), F.lit("-")), F.replace(child, F.lit("/"), F.lit("-")))


def upsert_edges(old: DataFrame, new: DataFrame) -> DataFrame:
    """Replace or add edges by child; ``rewired`` marks a changed parent."""
    o = old.select("child", F.col("parent").alias("_old"), F.lit(True).alias("_in_old"))
    n = new.select("child", F.col("parent").alias("_new"), F.lit(True).alias("_in_new"))
    return o.join(n, "child", "full_outer").select(
        "child",
        F.when(F.col("_in_new"), F.col("_new")).otherwise(F.col("_old")).alias("parent"),
        F.coalesce(F.col("_in_old") & F.col("_in_new") & ~F.col("_old").eqNullSafe(F.col("_new")), F.lit(False)).alias(
            "rewired"
        ),
    )


def camera_ned_edge(edges: DataFrame, camera: str) -> DataFrame:
    """Edges with a static ``<camera>_ned`` frame, the camera turned to north-east-down axes."""
    pose = dict(zip(("x", "y", "z", "qx", "qy", "qz", "qw"), (0.0, 0.0, 0.0, *CAMERA_TO_NED)))
    row = [(f"{camera}_ned", camera, True, *pose.values())]
    schema = "child string, parent string, is_static boolean, " + ", ".join(f"{c} double" for c in pose)
    return edges.unionByName(edges.sparkSession.createDataFrame(row, schema), allowMissingColumns=True)


# Fixed value: the parent name that marks an unattached frame.
UNATTACHED = "/ROOT"


def apply_calibration(old: DataFrame, calib: DataFrame) -> DataFrame:
    """Merge calibrated static edges and name what happened to each.

    Dynamic edges and edges under another parent stay; equal edges are updated; unknown
    children are added.
    """
    o = old.select("child", F.col("parent").alias("_op"), F.col("is_static").alias("_os"), F.col("value").alias("_ov"))
    c = calib.select("child", F.col("parent").alias("_cp"), F.col("value").alias("_cv"))
    action = (
        F.when(F.col("_cp").isNull(), "keep")
        .when(F.col("_op").isNull(), "insert")
        .when(~F.col("_os"), "skip_dynamic")
        .when((F.col("_op") != F.col("_cp")) & (F.col("_op") != UNATTACHED), "skip_parent")
        .otherwise("update")
    )
    take = F.col("action").isin("insert", "update")
    return (
        o.join(c, "child", "full_outer")
        .withColumn("action", action)
        .select(
            "child",
            F.when(take, F.col("_cp")).otherwise(F.col("_op")).alias("parent"),
            F.when(take, F.lit(True)).otherwise(F.col("_os")).alias("is_static"),
            F.when(take, F.col("_cv")).otherwise(F.col("_ov")).alias("value"),
            "action",
        )
    )


def transform_at(queries: DataFrame, paths: DataFrame, samples: DataFrame, statics: DataFrame, tol: int) -> DataFrame:
    """Matrix from ``f1`` to ``f2`` at stamp ``t`` for every query row.

    ``samples`` holds stamped poses per dynamic ``frame``, ``statics`` a matrix per static
    one.  Paths are resolved and their static edges multiplied once per pair of frames; all stamps are interpolated in bulk.
    Null where a frame is unconnected or has no pose within ``tol``; filter such rows by ``known``, which costs no product.
    """
    asked = queries.select("f1", "f2", "t").filter(F.col("t").isNotNull())
    branches = branch_paths(asked.groupBy("f1", "f2").agg(F.count(F.lit(1)).alias("_n")), paths)
    steps = path_steps(branches.filter(F.col("up").isNotNull()), ["f1", "f2", "_n"])
    legs = cut_lineage(pair_legs(steps, statics))
    hot = hot_frames(legs, samples)
    wanted = join_hot(asked.distinct(), legs.drop("_n"), ["f1", "f2"], ["t"], "inner")
    placed, still = around(wanted.filter(F.col("frame").isNotNull()), samples, hot, asked.select("t")), F.col("frame").isNull()
    if not legs.filter(still).isEmpty():
        placed = placed.unionByName(wanted.filter(still), allowMissingColumns=True)
    product = compose(placed, tol)
    return queries.join(product, ["f1", "f2", "t"], "left")
