"""Joins that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.session import salts


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join in which null keys match null keys; the columns are those of ``left``, then the others of ``right``."""
    renamed = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return left.join(renamed, same, how).drop(*[f"_on_{c}" for c in on])


def join_hot(big: DataFrame, per_key: DataFrame, on: list[str], spread: list[str], how: str = "left", null_safe: bool = False) -> DataFrame:
    """Join ``big`` with ``per_key`` (few rows per ``on`` value) without one task per hot key.

    Rows of ``big`` are spread over salts by a hash of the ``spread`` columns and ``per_key``
    is replicated once per salt, so a hot key is split evenly.  Small ``per_key`` sides are
    still broadcast by Catalyst under its own size check.
    """
    n = salts(big.sparkSession)
    join = join_null_safe if null_safe else DataFrame.join
    if n <= 1:
        return join(big, per_key, on, how)
    left = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(n)).cast("int"))
    right = per_key.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return join(left, right, [*on, "_salt"], how).drop("_salt")


HOT_ROWS = 10_000_000


def join_skewed(
    big: DataFrame, per_key: DataFrame, on: list[str], spread: list[str], how: str = "left", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Like ``join_hot`` for a ``per_key`` side too large to replicate as a whole.

    Keys with more than ``hot_rows`` rows are counted first, on the key columns alone.  There
    are at most ``rows / hot_rows`` of them, so their list is small enough to broadcast; only
    their rows are salted and replicated.
    """
    n = salts(big.sparkSession)
    hot = (
        big.groupBy(*on)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > hot_rows)
        .select(*on, F.lit(True).alias("_hot"))
    )
    hot = F.broadcast(hot)
    spread_salt = F.pmod(F.xxhash64(*spread), F.lit(n)).cast("int")
    left = big.join(hot, on, "left").withColumn("_salt", F.when(F.col("_hot"), spread_salt).otherwise(F.lit(0)))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n - 1))).otherwise(F.array(F.lit(0)))
    right = per_key.join(hot, on, "left").withColumn("_salt", F.explode(copies))
    return left.drop("_hot").join(right.drop("_hot"), [*on, "_salt"], how).drop("_salt")
