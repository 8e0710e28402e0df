import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.operators import legs, tree
from sensorloom.session import ROWS_PER_BLOCK

POSES = "x double, y double, z double, qx double, qy double, qz double, qw double"
EDGES = [("a", "map"), ("g", "a"), ("h", "g"), ("b", "h"), ("e", "b"), ("k", "map"), ("l", "k")]
UNIT = (0.0, 0.0, 0.0, 1.0)


@pytest.fixture(scope="module")
def paths(spark):
    return tree.root_paths(spark.createDataFrame(EDGES, "child string, parent string"))


@pytest.fixture(scope="module")
def statics(spark):
    """g, h, e and k are static; k has no matrix."""
    rows = [("g", 1.0, 2.0, 3.0, *UNIT), ("h", 0.0, 1.0, 0.0, 0.0, 0.0, 0.6, 0.8), ("e", 5.0, 0.0, 0.0, *UNIT)]
    fixed = tree.static_matrices(spark.createDataFrame(rows, f"child string, {POSES}"))
    return fixed.unionByName(spark.range(1).select(F.lit("k").alias("frame"), F.lit(None).cast("array<double>").alias("matrix")))


def test_static_edges_are_multiplied_once_per_pair(spark, paths, statics):
    pairs = spark.createDataFrame([("map", "e", 9), ("b", "a", 4), ("g", "g", 1), ("map", "l", 2)], "f1 string, f2 string, _n bigint")
    steps = tree.path_steps(tree.branch_paths(pairs, paths), ["f1", "f2", "_n"])
    got = {(r.f1, r.f2, r.leg): r for r in legs.pair_legs(steps, statics).collect()}
    at = {k: (r.frame, r.up, r.lacks, None if r.fixed is None else [round(r.fixed[i], 9) for i in (3, 7, 11)]) for k, r in got.items()}
    # g and h go before b, and e makes a leg of its own: three legs for five edges.
    assert at[("map", "e", 0)] == ("a", False, False, None) and at[("map", "e", 1)] == ("b", False, False, [1.0, 3.0, 3.0])
    assert at[("map", "e", 2)] == (None, False, False, [5.0, 0.0, 0.0])
    assert at[("b", "a", 0)] == ("b", True, False, None) and at[("b", "a", 1)][:3] == (None, False, False)
    assert at[("g", "g", 0)] == (None, False, False, None) and got[("map", "e", 1)]._n == 9
    assert at[("map", "l", 0)] == (None, False, True, None) and len(at) == 8


def _run(spark, paths, statics, samples):
    asked = [("map", "e", t, i) for i, t in enumerate([0, 5, 5, 10, 14, 20, 26])] + [("g", "h", 3, 90), ("g", "g", 3, 91), ("map", "l", 5, 92), ("a", "map", 5, 93), ("a", "nowhere", 5, 94), ("a", "map", None, 95)]
    queries = spark.createDataFrame(asked, "f1 string, f2 string, t bigint, id bigint")
    return {r.id: (r.known, r.matrix) for r in tree.transform_at(queries, paths, samples, statics, 5).collect()}


def test_hot_frames_and_nulls(spark, paths, statics):
    rows = [(f, s, t, float(t), y, 0.0, *UNIT) for s, (f, t, y) in enumerate([("a", 0, 1.0), ("a", 10, None), ("a", 20, 3.0), ("a", 20, 99.0), ("b", 0, 0.0), ("b", 20, 0.0), ("l", 5, 0.0), *[("a", 30 + i, 0.0) for i in range(9)]])]
    samples = spark.createDataFrame(rows, f"frame string, seq bigint, t bigint, {POSES}")
    plain = _run(spark, paths, statics, samples)
    spark.conf.set(ROWS_PER_BLOCK, "7")
    try:
        blocks = _run(spark, paths, statics, samples)
        asked = spark.createDataFrame([("a", "b", 0, "b", 2), ("a", "b", 0, "a", 2)], "f1 string, f2 string, leg int, frame string, _n bigint")
        assert [r.frame for r in legs.hot_frames(asked, samples).collect()] == ["a"]
    finally:
        spark.conf.unset(ROWS_PER_BLOCK)
    assert plain == blocks and len(plain) == 13
    x = {i: (m and [None if m[k] is None else round(m[k], 9) for k in (3, 7)]) for i, (_, m) in plain.items()}
    # An inverse takes all of a translation. From map: a at (t, y), g and h at (1, 3) turned by (0.28, 0.96), then b at (t, 0) and e at (5, 0).
    assert x[0] == [round(1 + 0.28 * 5, 9), round(1 + 3 + 0.96 * 5, 9)]
    assert x[1] == x[2] == [round(5 + 1 + 0.28 * 10, 9), None]
    assert x[5] == [round(20 + 1 + 0.28 * 25, 9), round(3 + 3 + 0.96 * 25, 9)]
    assert plain[6] == (False, None) and plain[92] == (False, None) and plain[94] == (None, None) == plain[95]
    assert np.allclose(plain[91][1], np.eye(4).ravel()) and x[90] == [0.0, 1.0] and x[93] == [None, None]


def test_paths_across_batches(spark):
    pose = "struct<t:bigint,x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>"
    rows = [("r", "f", t, k, False, f"n{k}", False, None, (t, 1.0, float(k), 0.0, *UNIT), None) for t in range(9) for k in range(t + 1)]
    given = spark.createDataFrame(rows, f"f1 string, f2 string, t bigint, leg bigint, lacks boolean, frame string, up boolean, fixed array<double>, prev {pose}, next {pose}")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2")
    try:
        got = {r.t: (r.known, r.matrix[3], r.matrix[7]) for r in legs.compose(given, 5).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {t: (True, t + 1.0, t * (t + 1) / 2) for t in range(9)}
