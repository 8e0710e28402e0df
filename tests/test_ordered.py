import random

import pytest
from pyspark.sql import functions as F

from sensorloom.operators.ordered import (
    Scan, block_of, dense_index, index_rows, order_statistics, running, split_points,
)
from sensorloom.operators.skew import join_hot, join_skewed


def rows(n=200, seed=1, hot=0.5):
    r = random.Random(seed)
    return [("hot" if r.random() < hot else f"k{r.randrange(5)}", i, r.choice([None, r.randrange(100)])) for i in r.sample(range(1000), n)]


@pytest.fixture(scope="module")
def data(spark):
    return spark.createDataFrame(rows(), "k string, t bigint, v bigint")


def brute(kind, exclusive, reverse):
    out = {}
    by = {}
    for k, t, v in sorted(rows(), key=lambda x: x[1], reverse=reverse):
        seen = by.setdefault(k, [])
        upto = seen if exclusive or kind == "lag" else seen + [v]
        vals = [x for x in upto if x is not None]
        if kind == "count":
            res = len(vals)
        elif kind == "lag":
            res = seen[-1] if seen else None
        elif not vals:
            res = None
        else:
            res = {"sum": sum(vals), "max": max(vals), "min": min(vals), "last": vals[-1]}[kind]
        out[(k, t)] = res
        seen.append(v)
    return out


@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("kind,exclusive", [("sum", False), ("sum", True), ("count", False), ("count", True), ("max", False), ("max", True), ("min", False), ("last", False), ("last", True), ("lag", False)])
def test_running_matches_brute_force(spark, data, small_blocks, kind, exclusive, reverse):
    out = running(data, ["k"], ["t"], {"o": Scan(kind, "v", exclusive, reverse)})
    assert {(r.k, r.t): r.o for r in out.collect()} == brute(kind, exclusive, reverse)


def test_one_block_equals_many(spark, data):
    whole = running(data, ["k"], ["t"], {"o": Scan("sum", "v")})
    assert {(r.k, r.t): r.o for r in whole.collect()} == brute("sum", False, False)


def test_blocks_are_balanced_and_monotone(spark, data, small_blocks):
    splits = split_points(data, ["t"])
    placed = data.withColumn("b", block_of(data, ["t"], splits)).orderBy("t").collect()
    assert [r.b for r in placed] == sorted(r.b for r in placed)
    sizes = {}
    for r in placed:
        sizes[r.b] = sizes.get(r.b, 0) + 1
    assert len(sizes) > 20 and max(sizes.values()) <= 14


def test_composite_and_string_order(spark, small_blocks):
    df = spark.createDataFrame([(f"f{i % 9}", i * 7 % 64) for i in range(64)], "f string, s bigint")
    got = index_rows(df, [], ["f", "s"]).collect()
    want = {p: i for i, p in enumerate(sorted((f"f{i % 9}", i * 7 % 64) for i in range(64)))}
    assert {(r.f, r.s): r.idx for r in got} == want


def test_ties_on_one_stamp_are_split_by_sequence(spark, small_blocks):
    df = spark.range(100).select(F.lit(5).cast("bigint").alias("t"), F.col("id").alias("s"))
    splits = split_points(df, ["t", "s"])
    assert len(splits) > 5
    assert [r.idx for r in index_rows(df, [], ["t", "s"]).orderBy("s").collect()] == list(range(100))


def test_dense_index_crosses_chunks(spark):
    b = spark.createDataFrame([("a", 0, 10_000), ("b", 5, 7), ("c", 3, 2)], "k string, lo bigint, hi bigint")
    got = dense_index(b, ["k"], "lo", "hi").groupBy("k").agg(F.count("*").alias("n"), F.min("idx").alias("a"), F.max("idx").alias("z"))
    assert {(r.k, r.n, r.a, r.z) for r in got.collect()} == {("a", 10_001, 0, 10_000), ("b", 3, 5, 7)}


def test_dense_index_crosses_groups_of_chunks(spark):
    b = spark.createDataFrame([("a", -5, 100), ("b", 17, 17)], "k string, lo bigint, hi bigint")
    got = dense_index(b, ["k"], "lo", "hi", chunk=4).collect()
    assert sorted((r.k, r.idx) for r in got) == [("a", i) for i in range(-5, 101)] + [("b", 17)]


def test_order_statistics(spark, data, small_blocks):
    got = order_statistics(data, ["k"], "v", {"low": lambda n: F.lit(0), "mid": lambda n: F.floor(n / 2)})
    for r in got.collect():
        vals = sorted(v for k, _, v in rows() if k == r.k and v is not None)
        assert (r.n, r.low, r.mid) == (len(vals), vals[0], vals[len(vals) // 2])


@pytest.mark.parametrize("join", [join_hot, lambda *a: join_skewed(*a, hot_rows=20)])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_salted_joins_equal_plain_join(spark, data, join, how):
    per_key = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "k string, w int")
    want = sorted(map(tuple, data.join(per_key, ["k"], how).collect()), key=str)
    assert sorted(map(tuple, join(data, per_key, ["k"], ["t"], how).collect()), key=str) == want
