"""Checks and reports over runs, catalogues and datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import dense_index
from sensorloom.operators.skew import join_skewed


def absent(wanted: DataFrame, present: DataFrame, on: str) -> DataFrame:
    """Distinct wanted keys that do not occur."""
    return wanted.select(on).distinct().join(present.select(on).distinct(), on, "left_anti")


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def completeness(df: DataFrame, keys: list[str], idx: str) -> DataFrame:
    """Whether the distinct indices per key are exactly 0 … max."""
    return df.groupBy(*keys).agg(
        F.count_distinct(idx).alias("n_idx"), F.min(idx).alias("first"), F.max(idx).alias("final")
    ).withColumn("complete", (F.col("first") == 0) & (F.col("final") == F.col("n_idx") - 1))


def zip_streams(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Full-outer pairing of two streams with a flag for missing partners."""
    l = left.withColumn("_l", F.lit(True))
    r = right.withColumn("_r", F.lit(True))
    return (
        l.join(r, on, "full_outer")
        .withColumn(
            "status",
            F.when(F.col("_l").isNull(), "right_only").when(F.col("_r").isNull(), "left_only").otherwise("paired"),
        )
        .drop("_l", "_r")
    )


def mean_std(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean and population standard deviation."""
    return df.groupBy(*keys).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )


def storage(df: DataFrame, modality: str, size: Column) -> DataFrame:
    """Total gigabytes and megabytes per frame by modality."""
    return df.groupBy(modality).agg(F.count(F.lit(1)).alias("n_frames"), F.sum(size).alias("bytes")).select(
        modality,
        "n_frames",
        (F.col("bytes") / 1e9).alias("gb"),
        (F.col("bytes") / 1e6 / F.col("n_frames")).alias("mb_per_frame"),
    )


def upsert_with_conflict(old: DataFrame, new: DataFrame, key: str, value: str) -> DataFrame:
    """New values win; ``conflict`` marks keys whose old value differed."""
    o = old.select(key, F.col(value).alias("_o"), F.lit(True).alias("_ho"))
    n = new.select(key, F.col(value).alias("_n"), F.lit(True).alias("_hn"))
    return o.join(n, key, "full_outer").select(
        key,
        F.coalesce("_n", "_o").alias(value),
        F.coalesce(F.col("_ho") & F.col("_hn") & ~F.col("_o").eqNullSafe(F.col("_n")), F.lit(False)).alias("conflict"),
    )


def read_indices(df: DataFrame, indices: DataFrame, on: list[str]) -> DataFrame:
    """Records of the listed indices, however often they are listed."""
    return df.join(indices.select(*on).distinct(), on, "left_semi")


def lookup(
    df: DataFrame, info: DataFrame, key: str, value: str, default, spread: list[str], strict: bool = False
) -> DataFrame:
    """Value of ``key`` or the default; ``strict`` fails on a missing key instead."""
    found = join_skewed(df, info.select(key, value), [key], spread)
    if strict:
        message = F.concat(F.lit("missing key "), F.col(key).cast("string"))
        return found.withColumn(value, F.coalesce(F.col(value), F.raise_error(message)))
    return found.withColumn(value, F.coalesce(F.col(value), F.lit(default)))


def last_write_dense(df: DataFrame, keys: list[str], idx: str, value: str, seq: str, fill) -> DataFrame:
    """Last written value for every index 0 … max of a key; unwritten ones get ``fill``."""
    written = df.groupBy(*keys, idx).agg(F.max_by(value, seq).alias(value))
    top = written.groupBy(*keys).agg(F.max(idx).alias("_hi")).withColumn("_lo", F.lit(0))
    full = dense_index(top, keys, "_lo", "_hi", idx).select(*keys, idx)
    return full.join(written, [*keys, idx], "left").withColumn(value, F.coalesce(F.col(value), F.lit(fill)))


def not_yet_written(df: DataFrame, written: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose index has no output yet."""
    return df.join(written.select(*on).distinct(), on, "left_anti")


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of either side that the other lacks, counting multiplicity, as one row of counts."""
    def rows(df, side):
        return df.select(F.lit(side).alias("side"), F.struct(*a.columns).alias("row"))

    both = rows(a, 1).union(rows(b, -1)).groupBy("row").agg(F.sum("side").alias("surplus"))
    return both.agg(
        F.coalesce(F.sum(F.greatest("surplus", F.lit(0))), F.lit(0)).alias("only_first"),
        F.coalesce(F.sum(F.greatest(-F.col("surplus"), F.lit(0))), F.lit(0)).alias("only_second"),
        F.count(F.lit(1)).alias("n_distinct"),
    )


def prefer(df: DataFrame, keys: list[str], priority: Column, columns: list[str], seq: str) -> DataFrame:
    """One row per key, from the container with the lowest priority number."""
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*columns), F.struct(priority, F.col(seq))).alias("_p"))
    return picked.select(*keys, "_p.*")


def metric_lines(df: DataFrame, text: str, keyword: str) -> DataFrame:
    """First decimal number of every line that contains the keyword."""
    line = df.withColumn("line", F.explode(F.split(F.col(text), "\n"))).filter(F.contains(F.col("line"), F.lit(keyword)))
    number = F.regexp_extract("line", r"\d+\.\d+", 0)
    return line.withColumn("_n", number).filter(F.col("_n") != "").withColumn("metric", F.col("_n").cast("double")).drop("_n", "line")


# Tolerances of approximate equality.
STAMP_TOLERANCE = 1e-8
RELATIVE, ABSOLUTE = 1e-5, 1e-8


def all_close(a: Column, b: Column) -> Column:
    """Arrays of equal length whose elements agree to the tolerances."""
    close = F.zip_with(a, b, lambda x, y: F.abs(x - y) <= F.lit(ABSOLUTE) + F.lit(RELATIVE) * F.abs(y))
    return (F.size(a) == F.size(b)) & F.forall(close, lambda c: F.coalesce(c, F.lit(False)))


def same_stamp(a: Column, b: Column) -> Column:
    return F.abs(a - b) < STAMP_TOLERANCE
