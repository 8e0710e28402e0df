"""Point clouds as one row per point: masks, stacking, projection, depth maps and voxels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.geometry import pinhole
from sensorloom.operators.skew import join_hot


def finite(*coords: str) -> Column:
    """No coordinate is NaN."""
    ok = F.lit(True)
    for c in coords:
        ok = ok & ~F.isnan(c)
    return ok


def split_by_features(points: DataFrame, features: str = "features") -> tuple[DataFrame, DataFrame]:
    """Points with and without features."""
    return points.filter(F.col(features).isNotNull()), points.filter(F.col(features).isNull())


def stack_frames(points: DataFrame, frame: str, k: int, existing: DataFrame, spread: list[str]) -> DataFrame:
    """Union of clouds ``frame-k … frame+k`` per existing frame, as column ``stack``.

    ``existing`` has one row per frame; its other columns are attached to the stacked points.
    Each frame first gets the list of at most ``2k+1`` frames that stack it.  Points then meet
    that small table once and are copied where they are, so clouds are never shuffled
    against each other.
    """
    carried = [c for c in existing.columns if c != frame]
    target = F.struct(F.col(frame).alias("stack"), *carried)
    targets = (
        existing.select(target.alias("_t"), F.explode(F.sequence(F.col(frame) - k, F.col(frame) + k)).alias(frame))
        .groupBy(frame)
        .agg(F.collect_list("_t").alias("_ts"))
    )
    joined = join_hot(points, targets, [frame], spread, "inner")
    return joined.withColumn("_t", F.explode("_ts")).select(*points.columns, "_t.*")


def in_view(points: DataFrame, width: int, height: int, fx: float, fy: float, cx: float, cy: float, max_depth: float | None) -> DataFrame:
    """Visible camera points ``x, y, z`` with integer pixels ``u, v`` (rounded half to even).

    Points must be in front of the camera and nearer than ``max_depth``, inside the image before
    rounding and again after it.
    """
    z = F.col("z")
    ahead = (z > 0) if max_depth is None else (z > 0) & (z < max_depth)
    front = points.filter(ahead)
    u, v = pinhole(F.col("x"), F.col("y"), z, fx, fy, cx, cy)
    return (
        front.withColumns({"_u": u, "_v": v})
        .filter((F.col("_u") >= 0) & (F.col("_u") < width) & (F.col("_v") >= 0) & (F.col("_v") < height))
        .withColumns({"u": F.rint("_u").cast("int"), "v": F.rint("_v").cast("int")})
        .filter((F.col("u") < width) & (F.col("v") < height))
        .drop("_u", "_v")
    )


def depth_map(visible: DataFrame, frame: list[str]) -> DataFrame:
    """Nearest depth per frame and pixel; frames without visible points do not appear."""
    return visible.groupBy(*frame, "u", "v").agg(F.min("z").alias("depth"))


def merge_depth(maps: DataFrame, pixel: list[str], depth: str) -> DataFrame:
    """Smallest positive depth over several maps; 0 where all are empty."""
    return maps.groupBy(*pixel).agg(
        F.coalesce(F.min(F.when(F.col(depth) > 0, F.col(depth))), F.lit(0.0)).alias("depth")
    )


def mask_region(pixels: DataFrame, mask: DataFrame, on: list[str], spread: list[str], depth: str = "depth") -> DataFrame:
    """Set depth to 0 where the mask image is 1."""
    marked = join_hot(pixels, mask.select(*on, F.col("mask").alias("_mask")), on, spread)
    return marked.withColumn(depth, F.when(F.col("_mask") == 1, F.lit(0.0)).otherwise(F.col(depth))).drop("_mask")


def voxel_index(coord: Column, origin: float, resolution: float) -> Column:
    return F.floor((coord - F.lit(origin)) / F.lit(resolution)).cast("bigint")


def raster_index(ix: Column, iy: Column, iz: Column, ny: int, nz: int) -> Column:
    """Flat index of a grid cell."""
    return (ix * ny + iy) * nz + iz


def voxels(points: DataFrame, by: list[str], origin: tuple, resolution: float, stamp: str = "t") -> DataFrame:
    """Hits, bounds and update times per voxel of ``x, y, z`` points."""
    cells = points.withColumns(
        {f"i{c}": voxel_index(F.col(c), o, resolution) for c, o in zip("xyz", origin)}
    )
    return cells.groupBy(*by, "ix", "iy", "iz").agg(
        F.count(F.lit(1)).alias("hits"),
        *[F.min(c).alias(f"min_{c}") for c in "xyz"],
        *[F.max(c).alias(f"max_{c}") for c in "xyz"],
        F.min(stamp).alias("first_update"),
        F.max(stamp).alias("last_update"),
    )


def voxel_features(points: DataFrame, by: list[str], origin: tuple, resolution: float, features: str) -> DataFrame:
    """Mean feature value per voxel and channel, in long form."""
    cells = points.withColumns(
        {f"i{c}": voxel_index(F.col(c), o, resolution) for c, o in zip("xyz", origin)}
    )
    long = cells.select(*by, "ix", "iy", "iz", F.posexplode(features).alias("channel", "value"))
    return long.groupBy(*by, "ix", "iy", "iz", "channel").agg(F.avg(F.col("value").cast("double")).alias("value"))


# Fixed value: grey level of voxels without features.
NO_FEATURE_GREY = 0.8


def voxel_colour(channel: Column) -> Column:
    return F.coalesce(channel, F.lit(NO_FEATURE_GREY))
