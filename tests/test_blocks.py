"""The block form of ordered operators against brute force: null keys, and every orderable type."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import series, tree
from sensorloom.operators.ordered import Scan, order_statistics, running
from sensorloom.session import ROWS_PER_BLOCK

DAY = dt.datetime(2020, 3, 1, 12, 0, 0, 123457)
ORDERS = {
    "bigint": lambda i: i - 30,
    "double": lambda i: i / 7 - 3,
    "string": lambda i: f"k'{i:03d}\\",
    "date": lambda i: (DAY + dt.timedelta(days=i)).date(),
    "timestamp": lambda i: DAY + dt.timedelta(microseconds=i * 1_000_003),
    "decimal(12,3)": lambda i: Decimal(i * 1001 - 20000) / 1000,
}


@pytest.fixture(params=["7", None])
def blocks(spark, request):
    if request.param:
        spark.conf.set(ROWS_PER_BLOCK, request.param)
    yield
    spark.conf.unset(ROWS_PER_BLOCK)


def key_of(i):
    return [None, "a", "b"][i * 7 % 3]


@pytest.mark.parametrize("kind", ORDERS)
def test_running(spark, blocks, kind):
    make = ORDERS[kind]
    values = [None if i % 5 == 0 else (i * 37) % 23 for i in range(60)]
    df = spark.createDataFrame([(key_of(i), make(i), i, values[i]) for i in range(60)], f"k string, o {kind}, i int, v long").repartition(4)
    scans = {"s": Scan("sum", "v"), "c": Scan("count", F.lit(1)), "m": Scan("max", "v"), "n": Scan("min", "v", exclusive=True), "l": Scan("last", "v"), "p": Scan("lag", "v"), "r": Scan("last", "v", exclusive=True, reverse=True)}
    got = {r.i: r for r in running(df, ["k"], ["o"], scans).collect()}
    assert len(got) == 60
    for i in range(60):
        before = [j for j in range(i) if key_of(j) == key_of(i)]
        upto = [values[j] for j in [*before, i] if values[j] is not None]
        past = [values[j] for j in before if values[j] is not None]
        later = [values[j] for j in range(i + 1, 60) if key_of(j) == key_of(i) and values[j] is not None]
        r = got[i]
        assert (r.s, r.c, r.m, r.l) == (sum(upto) if upto else None, len(before) + 1, max(upto, default=None), upto[-1] if upto else None)
        assert (r.n, r.p, r.r) == (min(past, default=None), values[before[-1]] if before else None, later[0] if later else None)


def test_thin_and_increasing(spark, blocks):
    t = [(i * 29) % 50 + i for i in range(80)]
    df = spark.createDataFrame([(key_of(i), i, t[i]) for i in range(80)], "k string, seq long, t long").repartition(4)
    for got, gap in ((series.thin(df, ["k"], 9), 9), (series.strictly_increasing(df, ["k"]), 1)):
        want, last = [], {}
        for i in range(80):
            if key_of(i) not in last or t[i] >= last[key_of(i)] + gap:
                want.append(i)
                last[key_of(i)] = t[i]
        assert sorted(r.seq for r in got.collect()) == want


def test_order_statistics(spark, blocks):
    df = spark.createDataFrame([(key_of(i), (i * 31) % 40) for i in range(90)], "k string, v long")
    got = {r.k: (r.n, r.mid) for r in order_statistics(df, ["k"], "v", {"mid": lambda n: F.floor(n / 2)}).collect()}
    for k in (None, "a", "b"):
        mine = sorted((i * 31) % 40 for i in range(90) if key_of(i) == k)
        assert got[k] == (len(mine), mine[len(mine) // 2])


@pytest.mark.parametrize("depth", [129, 200, 1000])
def test_deep_chains_are_no_cycles(spark, depth):
    edges = [(f"n{i + 1}", f"n{i}") for i in range(depth)] + [("x", "y"), ("y", "z"), ("z", "x"), ("w", "x")]
    got = {r.node: r for r in tree.root_paths(spark.createDataFrame(edges, "child string, parent string")).collect()}
    assert all(not got[f"n{i}"].cyclic and len(got[f"n{i}"].path) == i and got[f"n{i}"].root == "n0" for i in range(1, depth + 1))
    assert all(got[n].cyclic and got[n].root is None for n in "xyzw")


def test_render_is_depth_first(spark):
    edges = [("a", "map"), ("a b", "map"), ("x", "a"), ("a-c", "map")]
    rows = tree.render(tree.root_paths(spark.createDataFrame(edges, "child string, parent string"))).orderBy("sort_key").collect()
    assert [r.line for r in rows] == ["map", "- a", "- - x", "- a b", "- a-c"]
