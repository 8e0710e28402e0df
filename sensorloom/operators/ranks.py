"""Exact values at given ranks by refining histograms of their bits: nothing is sorted.

The first histogram covers the range of all values in at most ``2^FIRST_BITS`` buckets per key and
is counted where the rows are, so a shuffle moves counts.  Only rows in a bucket that holds a
wanted rank are kept, and their next ``BITS`` bits are counted, until buckets are single values.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.operators.skew import join_null_safe
from sensorloom.session import cut_lineage

FIRST_BITS = 11
BITS = 16
BROADCAST_ROWS = 200_000

# Fixed values of 64-bit floating-point numbers.
ONE = 1 << 52
BIAS = 1023
LARGEST = sys.float_info.max


def _double_bits(x: Column) -> Column:
    """Bits of the size of a number, negated for negative ones, by column arithmetic without branches.

    Read with another exponent than its own, a number gives larger bits: the smallest reading next
    to a rounded logarithm is right, and zero and denormal numbers are read with the least exponent.
    """
    size = F.least(F.abs(x), F.lit(LARGEST))
    near = F.least(F.greatest(F.floor(F.log2(size)), F.lit(2 - BIAS)), F.lit(BIAS))
    ratio = size / F.pow(F.lit(2.0), near.cast("double"))
    readings = [
        (near + (step + BIAS)) * F.lit(ONE) + ((ratio * 2.0**-step - 1.0) * float(ONE)).cast("bigint") for step in (-1, 0, 1)
    ]
    beyond = (F.abs(x) > LARGEST).cast("bigint") + F.isnan(x).cast("bigint")
    return (F.least(*readings) + beyond) * F.when(x < 0, F.lit(-1)).otherwise(F.lit(1))


def order_bits(value: Column, kind: T.DataType) -> Column | None:
    """A long that orders as ``value`` does, equal for equal values (both zeros; NaN comes last); None if the type has none."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return _double_bits(value.cast("double"))
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("bigint")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    return None


def _holding(counts: DataFrame, by: list[str], ranks: list[str]) -> DataFrame:
    """Buckets that hold a wanted rank, with the rank inside the bucket."""
    before = F.sum("_c").over(Window.partitionBy(*by).orderBy("_b")) - F.col("_c")
    inside = {
        r: F.when((F.col(r) >= F.col("_before")) & (F.col(r) < F.col("_before") + F.col("_c")), F.col(r) - F.col("_before"))
        for r in ranks
    }
    return counts.withColumn("_before", before).withColumns(inside).filter(F.coalesce(*ranks).isNotNull()).drop("_c", "_before")


def by_refinement(df: DataFrame, keys: list[str], value: str, bits: Column, picks: dict) -> DataFrame:
    """Values at 0-based ranks per key, and the count ``n``; ``picks`` maps a name to ``n -> rank``, null where no row has it.

    ``value`` must have no nulls.  The input is read for its range, for the first histogram, and
    for the rows near wanted ranks, which are stored: of continuous values a small part, at
    worst (one far value, all others in one bucket) all of them once.  A window sees the
    buckets of one key (of one bucket, in later rounds): at most ``2^BITS + 1`` rows.  Buckets with
    wanted ranks are counted, and broadcast up to ``BROADCAST_ROWS``; beyond, Catalyst picks the join.
    """
    rows = df.select(*keys, F.col(value).alias("_v"), bits.alias("_bits"))
    low, high = rows.agg(F.min("_bits"), F.max("_bits")).first()
    shift = 0
    while low is not None and (high >> shift) - (low >> shift) >= 1 << FIRST_BITS:
        shift += 1
    ranks = {f"_r{i}": (name, rank) for i, (name, rank) in enumerate(picks.items())}
    counts = cut_lineage(rows.groupBy(*keys, F.shiftright("_bits", shift).alias("_b")).agg(F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_v")))
    sized = counts.withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    wanted = {r: rank(F.col("_n")).cast("bigint") for r, (_, rank) in ranks.items()}
    found = cut_lineage(_holding(sized.withColumns(wanted).drop("_n"), keys, list(ranks)))
    # A bucket may hold several ranks that part in later rounds.
    small = shift > 0 and found.count() * len(picks) <= BROADCAST_ROWS
    stored = False
    while shift > 0:
        finer = max(shift - BITS, 0)
        inside = rows.withColumn("_p", F.shiftright("_bits", shift))
        wanted_in = found.drop("_v").withColumnRenamed("_b", "_p")
        near = join_null_safe(inside, F.broadcast(wanted_in) if small else wanted_in, [*keys, "_p"])
        if not stored:
            near, stored = cut_lineage(near), True
            rows = near.select(*keys, "_v", "_bits")
        finer_counts = near.groupBy(*keys, "_p", F.shiftright("_bits", finer).alias("_b")).agg(
            F.count(F.lit(1)).alias("_c"), F.max("_v").alias("_v"), *[F.max(r).alias(r) for r in ranks]
        )
        found = _holding(finer_counts, [*keys, "_p"], list(ranks)).drop("_p")
        shift = finer
    total = counts.groupBy(*keys).agg(F.sum("_c").alias("n"))
    picked = found.select(*keys, *[F.when(F.col(r).isNotNull(), F.col("_v")).alias(name) for r, (name, _) in ranks.items()])
    return total.unionByName(picked, allowMissingColumns=True).groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(name).alias(name) for name in picks])
