"""Ranks by histograms of bits against sorting."""

import datetime as dt
import math
import random
import struct
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.operators.ordered import order_statistics
from sensorloom.operators.ranks import by_refinement, order_bits

EDGES = [
    0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, sys.float_info.max, -sys.float_info.max, math.inf, -math.inf, 1.0,
    *[s * 2.0**e * (1 + d * sys.float_info.epsilon) for e in (-1000, -3, 0, 1, 29, 52, 1000, 1023) for d in (-0.5, 0, 1) for s in (1, -1)],
]


def true_bits(x):
    size = struct.unpack("<q", struct.pack("<d", abs(x)))[0]
    return -size if x < 0 else size


def test_bits_of_doubles(spark):
    r = random.Random(3)
    values = EDGES + [struct.unpack("<d", r.randbytes(8))[0] for _ in range(3000)]
    values = [v for v in values if not math.isnan(v)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for row in df.select("v", order_bits(F.col("v"), T.DoubleType()).alias("b")).collect():
        assert row.b == true_bits(row.v)
    nan = spark.createDataFrame([(math.nan,)], "v double").select(order_bits(F.col("v"), T.DoubleType())).first()[0]
    assert nan > true_bits(math.inf)


MAKE = {
    "double": lambda r: r.choice([r.gauss(0, 1), r.random() * 1e-300, r.gauss(0, 1e200), 0.0, -0.0, 7.0]),
    "float": lambda r: r.choice([0.5, 0.25, -8.0, float(r.randrange(100))]),
    "bigint": lambda r: r.choice([r.randrange(-(2**62), 2**62), r.randrange(10)]),
    "smallint": lambda r: r.randrange(-300, 300),
    "date": lambda r: dt.date(1960, 1, 1) + dt.timedelta(days=r.randrange(30_000)),
    "timestamp": lambda r: dt.datetime(2020, 1, 1) + dt.timedelta(microseconds=r.randrange(10**13)),
    "string": lambda r: str(r.randrange(500)),
}
PICKS = {"low": lambda n: F.lit(0), "mid": lambda n: F.floor(n / 2), "high": lambda n: n - 1, "same": lambda n: F.floor(n / 2), "none": lambda n: n}


@pytest.mark.parametrize("kind", MAKE)
@pytest.mark.parametrize("keys", [["k", "j"], []])
def test_ranks_equal_sorting(spark, small_blocks, kind, keys):
    r = random.Random(kind)
    # A third of all rows has one key; a key may be null.
    rows = [(r.choice(["hot", "hot", None, "a", "b", "c"]), r.choice([1, None]), r.choice([None, *[MAKE[kind](r) for _ in range(9)]])) for _ in range(900)]
    df = spark.createDataFrame(rows, f"k string, j int, v {kind}").repartition(5)
    want = {}
    for k, j, v in rows:
        if v is not None:
            want.setdefault((k, j) if keys else (), []).append(v)
    got = {tuple(row[k] for k in keys): row for row in order_statistics(df, keys, "v", PICKS).collect()}
    assert got.keys() == want.keys()
    for key, row in got.items():
        v = sorted(want[key])
        assert (row.n, row.low, row.mid, row.high, row.same, row.none) == (len(v), v[0], v[len(v) // 2], v[-1], v[len(v) // 2], None)


def test_far_values_and_empty_input(spark):
    values = [1.0 + i * 2.0**-50 for i in range(500)] + [1e300, -1e300, math.nan]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    bits = order_bits(F.col("v"), T.DoubleType())
    got = by_refinement(df, [], "v", bits, {"a": lambda n: F.lit(250), "z": lambda n: n - 2, "nan": lambda n: n - 1}).first()
    assert (got.n, got.a, got.z) == (503, sorted(values[:-1])[250], 1e300) and math.isnan(got.nan)
    assert by_refinement(df.filter("v > 2e300").filter("not isnan(v)").withColumn("k", F.lit(1)), ["k"], "v", bits, PICKS).isEmpty()
