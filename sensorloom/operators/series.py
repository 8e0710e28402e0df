"""Filters and running measures over stamped series."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.geometry import norm
from sensorloom.operators.ordered import Scan, block_of, running, split_points
from sensorloom.operators.skew import join_null_safe, join_skewed
from sensorloom.session import cut_lineage


def strictly_increasing(df: DataFrame, keys: list[str], time: str = "t", seq: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Keep rows whose stamp exceeds every earlier one in log order."""
    seen = running(df, keys, list(seq), {"_top": Scan("max", time, exclusive=True)})
    return seen.filter(F.col("_top").isNull() | (F.col(time) > F.col("_top"))).drop("_top")


def thin(df: DataFrame, keys: list[str], gap: int, time: str = "t", seq: tuple[str, ...] = ("seq",)) -> DataFrame:
    """Keep a row when it is at least ``gap`` after the last kept row of its key, in log order.

    Only new maxima can be kept, and the last kept stamp is always within ``gap`` of the
    maximum so far.  So what a block of the log does depends on few possible starting rows:
    new maxima up to the first one ``gap`` above the maximum before the block.  Each block
    lists its final kept stamp per starting row, with equal ones merged; one pass over these
    lists gives the entry stamp of every block, and the blocks are then filtered independently.
    """
    if gap <= 0:
        return strictly_increasing(df, keys, time, seq)
    order = list(seq)
    splits = split_points(df, order)
    if not splits:
        def whole(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order)
            return pdf.iloc[_kept(pdf[time].to_numpy(), gap, None)]

        return df.groupBy(*keys).applyInPandas(whole, df.schema)

    by, columns = [*keys, "_blk"], df.columns
    blocks = df.withColumn("_blk", block_of(df, order, splits))
    earlier = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    before = blocks.groupBy(*by).agg(F.max(time).alias("_max")).select(*by, F.max("_max").over(earlier).alias("_before"))
    before = cut_lineage(before)

    key_fields = [df.schema[k] for k in keys] + [T.StructField("_blk", T.IntegerType())]
    stamps = T.ArrayType(T.LongType())

    def outcomes(pdf: pd.DataFrame) -> pd.DataFrame:
        t = pdf.sort_values(order)[time].to_numpy()
        top = pdf["_before"].iloc[0]
        start, final = _transitions(t[_maxima(t)], gap, None if pd.isna(top) else int(top))
        return pd.DataFrame({**{c: [pdf[c].iloc[0]] for c in by}, "start": [start], "final": [final]})

    def entries(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_blk")
        last, seen = None, []
        for start, final in zip(pdf["start"], pdf["final"]):
            seen.append(last)
            at = 0 if last is None else int(np.searchsorted(start, last + gap))
            if at < len(final):
                last = int(final[at])
        return pdf[by].assign(_entry=pd.array(seen, dtype="Int64"))

    steps = join_null_safe(blocks.select(*by, *order, time), before, by).groupBy(*by).applyInPandas(
        outcomes, T.StructType([*key_fields, T.StructField("start", stamps), T.StructField("final", stamps)])
    )
    entry = steps.groupBy(*keys).applyInPandas(
        entries, T.StructType([*key_fields, T.StructField("_entry", T.LongType())])
    )

    def select(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        last = pdf["_entry"].iloc[0]
        keep = _kept(pdf[time].to_numpy(), gap, None if pd.isna(last) else int(last))
        return pdf.iloc[keep][columns]

    return join_null_safe(blocks, entry, by).groupBy(*by).applyInPandas(select, df.schema)


def _maxima(t: np.ndarray) -> np.ndarray:
    """Positions of values above all earlier ones."""
    top = np.maximum.accumulate(t)
    return np.flatnonzero(np.append(True, top[1:] > top[:-1]))


def _kept(t: np.ndarray, gap: int, last: int | None) -> np.ndarray:
    """Positions of kept rows of a series in log order."""
    rows = _maxima(t)
    r = t[rows]
    following = np.searchsorted(r, r + gap).tolist()
    at = 0 if last is None else int(np.searchsorted(r, last + gap))
    kept = []
    while at < len(r):
        kept.append(at)
        at = following[at]
    return rows[kept]


def _transitions(t: np.ndarray, gap: int, before: int | None) -> tuple[list[int], list[int]]:
    """Last stamp kept per possible starting stamp of an increasing series.

    Starts are the stamps above ``before`` up to the first one ``gap`` above it; without
    ``before`` only the first stamp is one.  Neighbouring starts with one outcome are merged
    into the largest of them.
    """
    n = len(t)
    following = np.searchsorted(t, t + gap)
    final = np.where(following < n, following, np.arange(n))
    # Follow all chains at once, doubling the stride until every row points at its last kept one.
    while not np.array_equal(further := final[final], final):
        final = further
    first = 0 if before is None else int(np.searchsorted(t, before, side="right"))
    stop = 1 if before is None else min(n, int(np.searchsorted(t, before + gap)) + 1)
    start, end = t[first:stop], t[final[first:stop]]
    ends = np.append(end[1:] != end[:-1], True)[: len(end)]
    return start[ends].tolist(), end[ends].tolist()


def path_length(df: DataFrame, keys: list[str], order: list[str], position: list[str], name: str = "length") -> DataFrame:
    """Sum of distances between successive positions per key."""
    stepped = running(df, keys, order, {f"_p_{c}": Scan("lag", c) for c in position})
    step = norm(*[F.col(c) - F.col(f"_p_{c}") for c in position])
    return stepped.groupBy(*keys).agg(F.coalesce(F.sum(step), F.lit(0.0)).alias(name))


def until_total(
    df: DataFrame, keys: list[str], order: list[str], size: str, cap: int, splits: list | None = None
) -> DataFrame:
    """Rows in order until their sizes reach ``cap``; the row that reaches it is kept."""
    summed = running(df, keys, order, {"_before": Scan("sum", size, exclusive=True)}, splits=splits)
    return summed.filter(F.coalesce(F.col("_before"), F.lit(0)) < cap).drop("_before")


def history(df: DataFrame, keys: list[str], order: list[str], velocity: list[str]) -> DataFrame:
    """Speed and number of records so far, one row per record."""
    counted = running(df, keys, order, {"n_seen": Scan("count", F.lit(1))})
    return counted.withColumn("speed", norm(*[F.col(c) for c in velocity]))


def scatter_by_mask(
    points: DataFrame, features: DataFrame, keys: list[str], mask: str, pt: str, row: str, splits: list | None = None
) -> DataFrame:
    """Give the k-th masked point the k-th feature row."""
    ranked = running(points, keys, [pt], {"_k": Scan("sum", F.col(mask).cast("bigint"))}, splits=splits)
    slot = F.when(F.col(mask), F.col("_k") - 1)
    return ranked.withColumn(row, slot).drop("_k").join(features, [*keys, row], "left")


def every_nth(df: DataFrame, idx: str, parts: int = 10) -> DataFrame:
    """Every ``max(1, n div parts)``-th row of a 0-based index."""
    total = df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.greatest(F.lit(1), F.floor(F.col("_n") / parts)).alias("_stride")
    )
    return df.filter(F.col(idx) % total.scalar() == 0)


def first_parent(
    edges: DataFrame, child: str = "child", parent: str = "parent", seq: tuple[str, ...] = ("seq",)
) -> DataFrame:
    """Drop edges whose parent differs from the first one logged for the child."""
    first = edges.groupBy(child).agg(F.min_by(F.struct(parent, "is_static"), F.struct(*seq)).alias("_f"))
    kept = join_skewed(edges.drop("is_static"), first, [child], list(seq), "inner")
    return (
        kept.filter(F.col(parent) == F.col(f"_f.{parent}"))
        .withColumn("is_static", F.col("_f.is_static"))
        .drop("_f")
    )


def condense_runs(df: DataFrame, keys: list[str], order: list[str], prefix: Column, meta: Column) -> DataFrame:
    """Runs of equal ``(prefix, meta)`` neighbours as ``run, prefix, meta, n``."""
    marked = df.withColumn("_prefix", prefix).withColumn("_meta", meta)
    splits = split_points(df, order)
    lagged = running(marked, keys, order, {"_lag": Scan("lag", F.struct("_prefix", "_meta"))}, splits=splits)
    change = F.when(F.col("_lag").eqNullSafe(F.struct("_prefix", "_meta")), 0).otherwise(1).cast("bigint")
    runs = running(lagged.withColumn("_change", change), keys, order, {"run": Scan("sum", "_change")}, splits=splits)
    return runs.groupBy(*keys, "run", F.col("_prefix").alias("prefix"), F.col("_meta").alias("meta")).agg(
        F.count(F.lit(1)).alias("n")
    )
