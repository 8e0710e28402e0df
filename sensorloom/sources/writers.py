"""Writers: partitioned frame datasets, series, text exports and depth images."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from sensorloom.functions.stamps import seconds_text
from sensorloom.operators.skew import join_hot
from sensorloom.operators.tree import edge_directory


def write_dataset(records: DataFrame, path: str, partitions=("run", "group", "name"), mode: str = "errorifexists") -> None:
    """Frame dataset: one folder per run, group and name, sorted by frame for pruning.

    Rows are spread over a hash of key and frame block, so a run or topic that holds most
    rows is written by many tasks.
    """
    block = F.floor(F.col("idx") / 4096)
    (
        records.repartition(*partitions, block)
        .sortWithinPartitions(*partitions, "idx")
        .write.partitionBy(*partitions)
        .mode(mode)
        .parquet(path)
    )


def write_matrix(rows: DataFrame, path: str, order: str, values: list[str], parts: int | None = None) -> None:
    """Text matrix in index order: ordered files of ordered lines."""
    line = F.concat_ws(" ", *[F.col(c).cast("string") for c in values])
    ranged = rows.repartitionByRange(order) if parts is None else rows.repartitionByRange(parts, order)
    ranged.sortWithinPartitions(order).select(line.alias("value")).write.text(path)


def write_stamps(frame_matches: DataFrame, path: str) -> None:
    """Matched stamps and errors per topic as text in frame order; unmatched are -1 and inf."""
    line = F.concat_ws(
        " ",
        F.when(F.col("match").isNull(), "-1").otherwise(F.format_string("%.6f", F.col("match") / 1e6)),
        F.when(F.col("err").isNull(), "inf").otherwise(F.format_string("%.6f", F.col("err") / 1e6)),
    )
    (
        frame_matches.select("topic", "frame", line.alias("value"))
        .repartitionByRange("topic", "frame")
        .sortWithinPartitions("topic", "frame")
        .select("topic", "value")
        .write.partitionBy("topic")
        .text(path)
    )


def write_tree(edges: DataFrame, samples: DataFrame, path: str) -> None:
    """Frame tree as an edge table and the stamped poses, one folder per edge."""
    folder = edge_directory(F.col("parent"), F.col("child"))
    edges.write.parquet(f"{path}/edges")
    parents = edges.select("child", "parent")
    placed = join_hot(samples, parents, ["child"], ["t"], "inner").withColumn("edge", folder)
    placed.repartition("edge", F.floor(F.col("t") / 3_600_000_000)).sortWithinPartitions("edge", "t").write.partitionBy(
        "edge"
    ).parquet(f"{path}/samples")


def write_poses(rows: DataFrame, path: str) -> None:
    """Space-delimited pose table with header."""
    rows.write.csv(path, sep=" ", header=True)


def float16_bits(depth: Column) -> Column:
    """Bits of the nearest half-precision float, ties to even; infinite beyond its range.

    Negative zero counts as zero; null stays null.
    """
    size = F.abs(depth.cast("double"))
    finite = F.when(size < 65520, size).otherwise(F.when(size.isNotNull(), 1.0))
    # The exponent of normal numbers; smaller ones share that of the smallest.
    exponent = F.greatest(F.lit(-14), F.coalesce(F.floor(F.log2(finite)), F.lit(-14)))
    steps = F.rint(finite / F.pow(F.lit(2.0), exponent - 10))
    bits = F.when(F.isnan(size), 32256).when(size >= 65520, 31744).otherwise((exponent + 14) * 1024 + steps)
    return (bits + F.when(depth < 0, 32768).otherwise(0)).cast("int")


@pandas_udf(T.BinaryType())
def float32_bytes(values: pd.Series) -> pd.Series:
    """Little-endian float32 bytes of a number array."""
    return values.map(lambda v: np.asarray(v, dtype="<f4").tobytes())


def pose_lines(dense: DataFrame, stamp: str, pose: list[str]) -> DataFrame:
    """Text export per index: missing stamps and poses become ``nan``."""
    nan = F.lit(float("nan"))
    return dense.withColumns(
        {"stamp_text": seconds_text(F.col(stamp)), **{c: F.coalesce(F.col(c), nan) for c in pose}}
    )
