"""Interpolation of series at given stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.geometry import canonical, slerp_weights
from sensorloom.operators.asof import match_series


def fraction(time: Column, t0: Column, t1: Column) -> Column:
    """Position of ``time`` between two stamps; 0 where they coincide."""
    return F.when(t1 == t0, F.lit(0.0)).otherwise((time - t0).cast("double") / (t1 - t0).cast("double"))


MATCH_TARGET, MATCH_TOPIC, UNCHANGED = "MATCH_TARGET", "MATCH_TOPIC", "UNCHANGED"


def target_stamps(mode: str, series: DataFrame, grid: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Stamps to interpolate at: the grid's, another topic's, or the series' own."""
    source = {MATCH_TARGET: grid, MATCH_TOPIC: other, UNCHANGED: series}[mode]
    return source.select(*keys, "t").distinct()


def interpolate(
    targets: DataFrame,
    series: DataFrame,
    keys: list[str],
    vectors: list[str],
    tol: int,
    quaternion: list[str] = (),
    time: str = "t",
    seq: str = "seq",
    splits: list | None = None,
) -> DataFrame:
    """Linear values (and slerped quaternion) of ``series`` at every distinct target stamp.

    Outside the series the end value holds for ``tol``, then the result is null.
    """
    cols = [*vectors, *quaternion]
    bracket = match_series(targets, series, keys, time, seq, cols, splits)
    clamp = [
        F.when(F.col("prev").isNull() & (F.col("next.t") - F.col(time) <= tol), F.col("next")).otherwise(F.col("prev")),
        F.when(F.col("next").isNull() & (F.col(time) - F.col("prev.t") <= tol), F.col("prev")).otherwise(F.col("next")),
    ]
    b = bracket.select(*keys, time, clamp[0].alias("a"), clamp[1].alias("b"))
    w = F.when(
        F.col("a").isNotNull() & F.col("b").isNotNull(),
        F.least(F.lit(1.0), F.greatest(F.lit(0.0), fraction(F.col(time), F.col("a.t"), F.col("b.t")))),
    )
    b = b.withColumn("w", w)
    out = {c: F.col(f"a.{c}") + (F.col(f"b.{c}") - F.col(f"a.{c}")) * F.col("w") for c in vectors}
    if quaternion:
        qa, qb = [F.col(f"a.{c}") for c in quaternion], [F.col(f"b.{c}") for c in quaternion]
        wa, wb = slerp_weights(qa, qb, F.col("w"))
        b = b.withColumns({"_wa": wa, "_wb": wb})
        b = b.withColumns({f"_{c}": F.col("_wa") * p + F.col("_wb") * q for c, p, q in zip(quaternion, qa, qb)})
        out.update(zip(quaternion, canonical(*[F.col(f"_{c}") for c in quaternion])))
    return b.select(*keys, time, *[v.alias(c) for c, v in out.items()])
