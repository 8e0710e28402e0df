"""Readers: message logs, frame files, text matrices, binary points and pose tables."""

from __future__ import annotations

import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorloom.functions.geometry import camera_matrix, camera_parameters
from sensorloom.operators.ordered import Scan, running


def messages(spark: SparkSession, path: str, topics: list[str] | None = None) -> DataFrame:
    """Message log in Parquet; the topic filter reaches the file scan."""
    log = spark.read.parquet(path)
    return log if topics is None else log.filter(F.col("topic").isin(list(topics)))


def runs(spark: SparkSession, root: str, glob: str = "*.parquet") -> DataFrame:
    """Runs at any depth below a root, in the order of their relative output path.

    A run is a folder with matching files; its name is that of the folder, without ``run=``.
    """
    base = re.sub(r"^\w+:(//[^/]*(?=/))?", "", root).rstrip("/")
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(root)
        .select("path", "length")
    )
    folder = F.regexp_extract("path", rf"\Q{base}\E/+(.+)/[^/]+$", 1)
    return (
        files.select(folder.alias("output"), "length")
        .filter(F.col("output") != "")
        .groupBy(F.regexp_extract("output", r"(?:run=)?([^/]+)$", 1).alias("run"), "output")
        .agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("bytes"))
        .orderBy("output")
    )


def frame_files(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Frame files as ``idx, content``; the index is the zero-padded number in the path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root)
    # The last path part that is a number as a whole; run folders may hold digits, too.
    digits = F.regexp_extract("path", r"^.*[/=](\d{8,})[/.]", 1)
    return files.select("path", digits.alias("_d"), "content").filter(F.col("_d") != "").select(
        "path", F.col("_d").cast("bigint").alias("idx"), "content"
    )


def read_dataset(spark: SparkSession, path: str, idx: int | None = None) -> DataFrame:
    """Whole dataset or one frame."""
    data = spark.read.parquet(path)
    return data if idx is None else data.filter(F.col("idx") == idx)


def read_tree(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Edges and samples of a written frame tree."""
    return spark.read.parquet(f"{path}/edges"), spark.read.parquet(f"{path}/samples").drop("edge", "parent")


def matrix(spark: SparkSession, path: str, width: int, keys: tuple[str, ...] = ()) -> DataFrame:
    """Whitespace-separated text matrix as ``keys, idx, values``; row *i* of the files is index *i*.

    ``keys`` names folders that hold one matrix each.  Rows are numbered by their place in the
    files, block by block, so a large file is never read as one value.
    """
    keys = list(keys)
    lines = spark.read.text(path).select(
        *keys,
        "value",
        F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    lines = lines.filter(F.trim("value") != "")
    place = [*keys, "_file", "_start"]
    starts = lines.groupBy(*place).agg(F.count(F.lit(1)).alias("_n"))
    before = running(starts, keys, ["_file", "_start"], {"_before": Scan("sum", "_n", exclusive=True)})
    # A file block is bounded by the split size of the scan, so it fits one window.
    inside = lines.withColumn("_k", F.row_number().over(Window.partitionBy(*place).orderBy("_at")))
    numbers = F.transform(F.split(F.trim("value"), r"\s+"), lambda s: s.cast("double"))
    return inside.join(before, place).select(
        *keys,
        (F.coalesce("_before", F.lit(0)) + F.col("_k") - 1).cast("bigint").alias("idx"),
        F.when(F.size(numbers) == width, numbers)
        .otherwise(F.raise_error(F.lit(f"expected {width} numbers per line")).cast("array<double>"))
        .alias("values"),
    )


# Fixed value: first bytes of a numpy array file.
NUMPY_MAGIC = b"\x93NUMPY"


def decode_points(files: DataFrame, key: str, content: str, dim: int = 4) -> DataFrame:
    """Little-endian float32 rows of ``dim`` numbers, or array files, as points ``key, pt, x, y, z``."""
    schema = T.StructType(
        [files.schema[key], T.StructField("pt", T.IntegerType()), *[T.StructField(c, T.FloatType()) for c in "xyz"]]
    )

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for k, raw in zip(batch[key], batch[content]):
                if raw[:6] == NUMPY_MAGIC:
                    pts = np.load(io.BytesIO(raw))
                else:
                    pts = np.frombuffer(raw, dtype="<f4").reshape(-1, dim)
                yield pd.DataFrame({key: k, "pt": np.arange(len(pts), dtype="int32"), **{c: pts[:, i] for i, c in enumerate("xyz")}})

    return files.select(key, content).mapInPandas(decode, schema)


def points(spark: SparkSession, root: str, kind: str = "bin", dim: int = 4) -> DataFrame:
    """Points of binary frame files (``bin`` or ``npy``), one row per point."""
    if kind not in ("bin", "npy"):
        raise ValueError(f"unsupported point format {kind}")
    return decode_points(frame_files(spark, root, f"*.{kind}"), "idx", "content", dim)


POSE_SCHEMA = "timestamp double, x double, y double, z double, qx double, qy double, qz double, qw double"


def poses(spark: SparkSession, path: str) -> DataFrame:
    """Space-delimited pose table with header."""
    return spark.read.csv(path, sep=" ", header=True, schema=POSE_SCHEMA, enforceSchema=False)


def calibration(text: Column, camera: str = "cam0") -> Column:
    """``[fx, fy, cx, cy]`` of a JSON calibration in any of three layouts; else an error."""
    by_camera = F.from_json(F.get_json_object(text, f"$.{camera}.intrinsics"), "array<double>")
    flat = F.from_json(F.get_json_object(text, "$.K"), "array<double>")
    nested = F.from_json(F.get_json_object(text, "$.intrinsics.K"), "array<double>")
    return F.coalesce(
        by_camera,
        F.when(flat.isNotNull(), F.array(*camera_parameters(flat))),
        F.when(nested.isNotNull(), F.array(*camera_parameters(nested))),
        F.raise_error(F.lit("unknown calibration layout")).cast("array<double>"),
    )


def stereo_calibration(text: Column, left: str = "cam0", right: str = "cam1") -> Column:
    """Camera matrices, distortions and right-to-left matrix of a JSON stereo calibration."""
    def numbers(path: str) -> Column:
        return F.from_json(F.get_json_object(text, path), "array<double>")

    def matrix_of(camera: str) -> Column:
        values = numbers(f"$.{camera}.intrinsics")
        return camera_matrix(*[F.get(values, F.lit(i)) for i in range(4)])

    return F.struct(
        matrix_of(left).alias("k_left"),
        numbers(f"$.{left}.distortion_coeffs").alias("d_left"),
        matrix_of(right).alias("k_right"),
        numbers(f"$.{right}.distortion_coeffs").alias("d_right"),
        numbers(f"$.{right}.T_cn_cnm1").alias("right_to_left"),
    )


def catalog(spark: SparkSession, *lists: list[dict]) -> DataFrame:
    """Topic catalogue from one or more included lists; the group defaults to an empty name."""
    rows = [
        (t.get("group", ""), t["name"], t["topic"], t["type"], t.get("max_age"), {k: str(v) for k, v in t.get("args", {}).items()})
        for included in lists
        for t in included
    ]
    names = [f"{g}/{n}" for g, n, *_ in rows]
    if len(set(names)) != len(names):
        raise ValueError("names must be unique in a catalogue")
    return spark.createDataFrame(
        rows, "`group` string, name string, topic string, type string, max_age double, args map<string,string>"
    )


def interpolation_args(args: Column) -> Column:
    """Arguments for the decoder: all but the interpolation setting."""
    return F.map_filter(args, lambda k, v: k != "interpolation")


def with_missing_columns(old: DataFrame, new: DataFrame, fill: dict) -> DataFrame:
    """Old and new layouts together; columns the old one lacks get the fill value."""
    both = old.unionByName(new, allowMissingColumns=True)
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fill.items()})
