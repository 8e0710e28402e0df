import random

import pytest
from pyspark.sql import functions as F

from sensorloom.functions import keys as k
from sensorloom.operators import series


def greedy(rows, gap):
    last, kept = {}, set()
    for key, seq, t in sorted(rows, key=lambda r: r[1]):
        if key not in last or t - last[key] >= gap:
            last[key] = t
            kept.add((key, seq, t))
    return kept


@pytest.mark.parametrize("gap,spread,shuffle", [(10, 2000, False), (25, 400, False), (10, 2000, True), (7, 90, True), (1, 50, True)])
def test_thinning_matches_the_sequential_rule(spark, small_blocks, gap, spread, shuffle):
    r = random.Random(gap)
    stamps = [r.randrange(spread) for _ in range(250)]
    if not shuffle:
        stamps.sort()
    rows = [("hot" if r.random() < 0.7 else "cold", i, t) for i, t in enumerate(stamps)]
    df = spark.createDataFrame(rows, "topic string, seq bigint, t bigint")
    got = {tuple(x) for x in series.thin(df, ["topic"], gap).select("topic", "seq", "t").collect()}
    assert got == greedy(rows, gap)


def test_thinning_of_a_regular_dense_series(spark, small_blocks):
    rows = [("a", i, i * 3) for i in range(300)]
    df = spark.createDataFrame(rows, "topic string, seq bigint, t bigint")
    got = {tuple(x) for x in series.thin(df, ["topic"], 10).select("topic", "seq", "t").collect()}
    assert got == greedy(rows, 10)


def test_transitions_merge_equal_outcomes():
    import numpy as np

    t = np.array([0, 1, 2, 20, 21, 40])
    assert series._transitions(t, 10, None) == ([0], [40])
    assert series._transitions(t, 10, -1) == ([20], [40])
    assert series._transitions(np.array([0, 5, 10, 16]), 10, -1) == ([0, 5, 10], [10, 16, 10])
    assert series._transitions(t, 10, 50) == ([], [])


def test_strictly_increasing(spark, small_blocks):
    rows = [("a", i, t) for i, t in enumerate([5, 3, 5, 6, 6, 2, 9, 8, 10, 1, 11])]
    df = spark.createDataFrame(rows, "k string, seq bigint, t bigint")
    assert sorted(r.t for r in series.strictly_increasing(df, ["k"]).collect()) == [5, 6, 9, 10, 11]


@pytest.mark.parametrize("cap,n", [(10, 4), (11, 5), (1, 2), (100, 6)])
def test_cap_keeps_the_crossing_cloud(spark, small_blocks, cap, n):
    sizes = [0, 4, 3, 3, 2, 5]
    df = spark.createDataFrame(list(enumerate(sizes)), "i bigint, n bigint")
    assert series.until_total(df, [], ["i"], "n", cap).count() == n


def test_scatter_with_empty_mask(spark):
    pts = spark.createDataFrame([(i, False) for i in range(5)], "pt bigint, m boolean")
    feats = spark.createDataFrame([], "row bigint, f double")
    assert all(r.row is None and r.f is None for r in series.scatter_by_mask(pts, feats, [], "m", "pt", "row").collect())


def test_first_parent_wins(spark):
    rows = [("c", "p", 2, False), ("c", "q", 3, True), ("c", "p", 4, False), ("d", "q", 1, True)]
    df = spark.createDataFrame(rows, "child string, parent string, seq bigint, is_static boolean")
    got = {(r.child, r.parent, r.seq, r.is_static) for r in series.first_parent(df).collect()}
    assert got == {("c", "p", 2, False), ("c", "p", 4, False), ("d", "q", 1, True)}


def test_key_list_operations(spark):
    df = spark.createDataFrame([(["vis_0", "vis_1", "vis_2", "height", "vis_3"], ["emb", "emb", "raw", "geo", "emb"])], "l array<string>, m array<string>")
    keys = k.key_list(F.col("l"), F.col("m"))
    row = df.select(
        k.condense(keys).alias("text"), k.index(keys, "height").alias("i"), k.index_pair(keys, "vis_2", "raw").alias("p"),
        k.index_metainfo(keys, F.lit("emb")).alias("d"), k.length(k.part(keys, 1, 3)).alias("n"),
        k.condense(k.part(keys, 0, 0)).alias("empty"), k.prefix(F.lit("a_b_12")).alias("pre"), k.prefix(F.lit("ab_x")).alias("raw"),
    ).first()
    assert row.text == "vis (emb) x2, vis (raw) x1, height (geo) x1, vis (emb) x1"
    assert (row.i, row.p, row.d, row.n, row.empty, row.pre, row.raw) == (3, 2, [0, 1, 4], 2, "", "a_b", "ab_x")


def test_missing_key_is_an_error(spark):
    df = spark.createDataFrame([(["a"], ["b"])], "l array<string>, m array<string>")
    with pytest.raises(Exception, match="no label zz"):
        df.select(k.index(k.key_list(F.col("l"), F.col("m")), "zz")).collect()
