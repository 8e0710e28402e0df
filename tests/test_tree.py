import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.functions import geometry as g
from sensorloom.operators import lifting, tree

# Two roots; c is deep, s is static among dynamic frames.
EDGES = [("a", "map"), ("b", "a"), ("c", "b"), ("d", "a"), ("s", "c"), ("x", "odom"), ("y", "x")]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "child string, parent string")


@pytest.fixture(scope="module")
def paths(edges):
    return tree.root_paths(edges)


def test_root_paths(edges, paths):
    got = {r.node: (r.root, r.path, r.cyclic) for r in paths.collect()}
    assert got["s"] == ("map", ["a", "b", "c", "s"], False)
    assert got["y"] == ("odom", ["x", "y"], False) and got["a"] == ("map", ["a"], False)
    assert {r.node: r.depth for r in lifting.depths(lifting.ancestors(edges)).collect()} == {"a": 0, "b": 1, "c": 2, "d": 1, "s": 3, "x": 0, "y": 1}


def test_long_chain(spark):
    e = spark.createDataFrame([(f"n{i}", f"n{i - 1}" if i else "root") for i in range(70)], "child string, parent string")
    got = {r.node: (r.root, len(r.path)) for r in tree.root_paths(e).collect()}
    assert got["n69"] == ("root", 70) and got["n0"] == ("root", 1)


def test_cycles_and_self_loops(spark):
    e = spark.createDataFrame([("p", "q"), ("q", "r"), ("r", "p"), ("t", "p"), ("z", "z"), ("w", "z")], "child string, parent string")
    got = {r.node: (r.root, r.path, r.cyclic) for r in tree.root_paths(e).collect()}
    assert all(got[n] == (None, None, True) for n in "pqrt")
    assert got["z"] == ("z", ["z"], False) and got["w"] == ("z", ["z", "w"], False)


def test_branches(spark, paths):
    pairs = spark.createDataFrame([("s", "d"), ("b", "b"), ("map", "c"), ("y", "c"), ("d", "map"), ("nowhere", "a")], "f1 string, f2 string")
    got = {(r.f1, r.f2): (r.lca, r.up, r.down) for r in tree.branch_paths(pairs, paths).collect()}
    assert got[("s", "d")] == ("a", ["b", "c", "s"], ["d"])
    assert got[("b", "b")] == ("b", [], [])
    assert got[("map", "c")] == ("map", [], ["a", "b", "c"])
    assert got[("d", "map")] == ("map", ["a", "d"], [])
    assert got[("y", "c")] == (None, None, None) == got[("nowhere", "a")]


def test_intervals(spark, edges):
    rows = [("a", 0.0, 100.0), ("b", 10.0, 90.0), ("c", 5.0, 80.0), ("d", 20.0, 95.0), ("s", -tree.INF, tree.INF), ("x", 0.0, 1.0), ("y", 0.0, 1.0)]
    bounds = spark.createDataFrame(rows, "frame string, t_min double, t_max double")
    pairs = spark.createDataFrame([("s", "d"), ("b", "b"), ("y", "c")], "f1 string, f2 string")
    got = {(r.f1, r.f2): (r.t_min, r.t_max) for r in tree.path_interval(pairs, edges, bounds).collect()}
    assert got == {("s", "d"): (20.0, 80.0), ("b", "b"): (-tree.INF, tree.INF), ("y", "c"): (tree.INF, -tree.INF)}
    ask = lambda *f: tuple(tree.frames_interval(spark.createDataFrame([(x,) for x in f], "frame string"), edges, bounds).first())
    assert ask("s", "b", "unknown") == (5.0, 80.0)
    assert ask("s", "y") == (tree.INF, -tree.INF)
    assert ask("d", "d") == (-tree.INF, tree.INF)


def test_has_frame_and_roots(spark, edges):
    asked = spark.createDataFrame([("map",), ("s",), ("nope",)], "frame string")
    assert {r.frame: r.known for r in tree.has_frame(asked, edges).collect()} == {"map": True, "s": True, "nope": False}
    assert {r.frame for r in tree.roots(edges).collect()} == {"map", "odom"}


def test_render(paths):
    lines = [r.line for r in tree.render(paths).orderBy("sort_key").collect()]
    assert lines == ["map", "- a", "- - b", "- - - c", "- - - - s", "- - d", "odom", "- x", "- - y"]


def test_calibration_rules(spark):
    old = spark.createDataFrame(
        [("dyn", "p", False, 1.0), ("other", "q", True, 1.0), ("free", tree.UNATTACHED, True, 1.0), ("same", "p", True, 1.0), ("untouched", "p", True, 1.0)],
        "child string, parent string, is_static boolean, value double",
    )
    calib = spark.createDataFrame([(c, "p", 2.0) for c in ("dyn", "other", "free", "same", "new")], "child string, parent string, value double")
    got = {r.child: (r.parent, r.value, r.action) for r in tree.apply_calibration(old, calib).collect()}
    assert got == {
        "dyn": ("p", 1.0, "skip_dynamic"), "other": ("q", 1.0, "skip_parent"), "free": ("p", 2.0, "update"),
        "same": ("p", 2.0, "update"), "new": ("p", 2.0, "insert"), "untouched": ("p", 1.0, "keep"),
    }


def matrix(x, y, z, qx, qy, qz, qw):
    q = np.array([qx, qy, qz, qw]) / np.linalg.norm([qx, qy, qz, qw])
    a, b, c, d = q
    m = np.eye(4)
    m[:3, :3] = [[1 - 2 * (b * b + c * c), 2 * (a * b - c * d), 2 * (a * c + b * d)], [2 * (a * b + c * d), 1 - 2 * (a * a + c * c), 2 * (b * c - a * d)], [2 * (a * c - b * d), 2 * (b * c + a * d), 1 - 2 * (a * a + b * b)]]
    m[:3, 3] = x, y, z
    return m


def test_transform_at_matches_numpy(spark, paths, small_blocks):
    rng = np.random.default_rng(4)
    poses = {(f, t): [*rng.normal(size=3), *rng.normal(size=4)] for f in "abcd" for t in (0, 100)}
    poses = {k: [*v[:3], *(np.array(v[3:]) / np.linalg.norm(v[3:]))] for k, v in poses.items()}
    rows = [(f, i, t, *map(float, p)) for i, ((f, t), p) in enumerate(poses.items())]
    samples = spark.createDataFrame(rows, "frame string, seq bigint, t bigint, x double, y double, z double, qx double, qy double, qz double, qw double")
    fixed = list(map(float, [1, 2, 3, 0.1, 0.2, 0.3, 0.9]))
    statics = tree.static_matrices(spark.createDataFrame([("s", *fixed)], "child string, x double, y double, z double, qx double, qy double, qz double, qw double"))
    asked = spark.createDataFrame([("s", "d", 0), ("s", "d", 40), ("map", "s", 100), ("b", "b", 40), ("s", "d", 999), ("y", "s", 0)], "f1 string, f2 string, t bigint")
    got = {(r.f1, r.f2, r.t): r.matrix for r in tree.transform_at(asked, paths, samples, statics, 20).collect()}

    def at(f, t):
        if f == "s":
            return matrix(*fixed)
        p, q, w = np.array(poses[(f, 0)]), np.array(poses[(f, 100)]), t / 100
        dot = p[3:] @ q[3:]
        q3 = q[3:] * (1 if dot >= 0 else -1)
        theta = np.arccos(min(1, abs(dot)))
        rot = (np.sin((1 - w) * theta) * p[3:] + np.sin(w * theta) * q3) / np.sin(theta)
        return matrix(*(p[:3] * (1 - w) + q[:3] * w), *rot)

    def chain(up, down, t):
        m = np.eye(4)
        for f in reversed(up):
            m = m @ np.linalg.inv(at(f, t))
        for f in down:
            m = m @ at(f, t)
        return m

    for t in (0, 40):
        assert np.allclose(np.array(got[("s", "d", t)]).reshape(4, 4), chain(["b", "c", "s"], ["d"], t))
    assert np.allclose(np.array(got[("map", "s", 100)]).reshape(4, 4), chain([], ["a", "b", "c", "s"], 100))
    assert np.allclose(np.array(got[("b", "b", 40)]).reshape(4, 4), np.eye(4))
    assert got[("s", "d", 999)] is None and got[("y", "s", 0)] is None


def test_camera_ned_edge(spark, edges):
    full = tree.camera_ned_edge(edges, "c")
    row = full.filter("child = 'c_ned'").first()
    assert (row.parent, row.is_static) == ("c", True)
    m = full.filter("child = 'c_ned'").select(g.pose_matrix(*[F.col(c) for c in ("x", "y", "z", "qx", "qy", "qz", "qw")])).first()[0]
    assert np.allclose(np.array(m).reshape(4, 4), matrix(0, 0, 0, -0.5, -0.5, -0.5, 0.5))


@pytest.mark.parametrize("q", [(1, 0, 0, 0), (0, 1, 0, 0), (0, 0, 1, 0), (0, 0, 0, 1), (0.5, -0.5, 0.5, -0.5), (0.1, 0.7, -0.2, -0.6)])
def test_quaternion_round_trip(spark, q):
    q = np.array(q, float) / np.linalg.norm(q)
    df = spark.range(1).select(g.pose_matrix(*[F.lit(float(v)) for v in (1, 2, 3, *q)]).alias("m"))
    got = np.array(df.select(F.array(*g.matrix_quaternion(F.col("m")))).first()[0])
    assert got[3] >= 0 and (np.allclose(got, q) or np.allclose(got, -q))
    inverse = df.select(g.matmul(F.col("m"), g.rigid_inverse(F.col("m")))).first()[0]
    assert np.allclose(np.array(inverse).reshape(4, 4), np.eye(4))


def test_slerp_of_equal_and_opposite_signs(spark):
    a = [F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)]
    same = spark.range(1).select(F.array(*g.slerp(a, a, F.lit(0.3)))).first()[0]
    flipped = spark.range(1).select(F.array(*g.slerp(a, [-c for c in a], F.lit(0.3)))).first()[0]
    assert np.allclose(same, [0, 0, 0, 1]) and np.allclose(flipped, [0, 0, 0, 1])
