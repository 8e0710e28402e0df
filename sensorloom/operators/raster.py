"""Images and grids in long form: scaling, clipping, layout and rectification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import order_statistics
from sensorloom.operators.skew import join_hot, join_null_safe


def extrema(pixels: DataFrame, frame: list[str], value: str) -> DataFrame:
    return pixels.groupBy(*frame).agg(F.min(value).alias("lo"), F.max(value).alias("hi"))


def stretch(value: Column, lo: Column, hi: Column) -> Column:
    """Linear stretch to 0…255, truncated; null for a constant image."""
    return F.when(hi > lo, ((value - lo) / (hi - lo) * 255.0).cast("int"))


def rank_bounds(pixels: DataFrame, frame: list[str], value: str) -> DataFrame:
    """Values at the 1 % and 99 % ranks per frame; ranks round half to even.

    The lower rank is the 0-based ``rint(n/100)``, the upper one ``rint(99n/100) - 1``.
    """
    def rank(share):
        return lambda n: F.rint(n.cast("double") * share).cast("bigint")

    return order_statistics(pixels, frame, value, {"lower": rank(0.01), "upper": lambda n: rank(0.99)(n) - 1})


# Normalisation modes; fixed value: the brightness below which the adaptive one stretches whole images.
MINMAX, ADAPTIVE, RANKED, PLAIN = "minmax", "adaptive", "ranked", "plain"
ADAPTIVE_LIMIT = 35000


def normalise(pixels: DataFrame, frame: list[str], value: str, spread: list[str], mode: str) -> DataFrame:
    """8-bit level per pixel in column ``level``; ``plain`` divides by 255, an unknown mode is an error."""
    if mode not in (MINMAX, ADAPTIVE, RANKED, PLAIN):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == PLAIN:
        return pixels.withColumn("level", (F.col(value) / 255).cast("int"))
    limits = extrema(pixels, frame, value)
    if mode != MINMAX:
        limits = join_null_safe(limits, rank_bounds(pixels, frame, value), frame)
    full = join_hot(pixels, limits, frame, spread, "inner", null_safe=True)
    plain = stretch(F.col(value), F.col("lo"), F.col("hi"))
    if mode == MINMAX:
        return full.withColumn("level", plain).drop("lo", "hi")
    clipped = F.least(F.greatest(F.col(value), F.col("lower")), F.col("upper"))
    ranked = stretch(clipped, F.col("lower"), F.col("upper"))
    level = ranked if mode == RANKED else F.when(F.col("hi") < ADAPTIVE_LIMIT, plain).otherwise(ranked)
    return full.withColumn("level", level).drop("lo", "hi", "lower", "upper", "n")


def percentile(pixels: DataFrame, frame: list[str], value: str, p: float, name: str) -> DataFrame:
    """Exact percentile per frame with linear interpolation between ranks."""
    def at(n):
        return (n - 1).cast("double") * F.lit(p)

    picked = order_statistics(
        pixels,
        frame,
        value,
        {"_a": lambda n: F.floor(at(n)), "_b": lambda n: F.ceil(at(n)), "_n": lambda n: F.lit(0)},
    )
    w = at(F.col("n")) - F.floor(at(F.col("n")))
    return picked.select(*frame, (F.col("_a") + (F.col("_b") - F.col("_a")) * w).alias(name))


def inverse_depth(depth: Column) -> Column:
    """``1 / (depth + 1e-6)`` with NaN read as 0."""
    return F.lit(1.0) / (F.nanvl(depth, F.lit(0.0)) + 1e-6)


def pack_rgb(r: Column, g: Column, b: Column) -> Column:
    """24-bit colour of channels in 0…1, each truncated after scaling."""
    r, g, b = [(c * 255).cast("int") for c in (r, g, b)]
    return F.shiftleft(r, 16).bitwiseOR(F.shiftleft(g, 8)).bitwiseOR(b)


def grid_cell(p: Column, nx: int, ny: int) -> tuple[Column, Column]:
    """Cell ``(x, y)`` of flat position ``p`` in a message whose axes both run backwards."""
    return F.lit(nx - 1) - F.floor(p / ny).cast("int"), F.lit(ny - 1) - (p % ny).cast("int")


def grid_position(x: Column, y: Column, nx: int, ny: int) -> Column:
    """Flat message position of cell ``(x, y)``."""
    return (F.lit(nx - 1) - x) * ny + (F.lit(ny - 1) - y)


def grid_origin(centre: Column, length: Column) -> Column:
    return centre - F.lit(0.5) * length


def grid_centre(origin: Column, length: Column) -> Column:
    return origin + F.lit(0.5) * length


# Threshold of the visible mask, its source layer and the derived layer names.
MASK_THRESHOLD = 0.1
MASK_SOURCE = "min_elevation_filtered_inflated_mask"
MASK_LAYER = "viz_mask"
FLAT_LAYER = "elevation"


def derived_layers(cells: DataFrame, layer: str, value: str, source: str = MASK_SOURCE) -> DataFrame:
    """Add the visible-mask layer (low values NaN) and a flat layer to long-form grid cells."""
    low = F.when(F.col(value) < MASK_THRESHOLD, F.lit(float("nan"))).otherwise(F.col(value))
    mask = cells.filter(F.col(layer) == source).withColumns({value: low, layer: F.lit(MASK_LAYER)})
    cell = [c for c in cells.columns if c not in (layer, value)]
    flat = cells.select(*cell).distinct().withColumns({layer: F.lit(FLAT_LAYER), value: F.lit(0.0)})
    return cells.unionByName(mask).unionByName(flat)


def layer_subset(have: Column, wanted: list[str]) -> tuple[Column, Column]:
    """Wanted layers that exist, in the wanted order, and whether any is missing."""
    kept = F.filter(F.lit(wanted), lambda w: F.array_contains(have, w))
    return kept, F.size(kept) < len(wanted)


# Distortion models that use the fisheye formula.
FISHEYE_MODELS = ("equidistant", "fisheye")


def source_pixel(u: Column, v: Column, k, d, p, model: str, r=None) -> tuple[Column, Column]:
    """Where a rectified pixel comes from in the raw image.

    ``k`` and ``p`` are ``fx, fy, cx, cy`` of the raw and of the new camera and ``r`` is the
    row-major rectifying rotation.  ``d`` holds ``k1, k2, p1, p2, k3, k4, k5, k6`` or, for
    fisheye models, ``k1 … k4``; missing ones are 0.
    """
    x, y = (u - p[2]) / p[0], (v - p[3]) / p[1]
    if r is not None:
        ray = [x * r[c] + y * r[3 + c] + F.lit(r[6 + c]) for c in range(3)]
        x, y = ray[0] / ray[2], ray[1] / ray[2]
    d = [*d, *[0.0] * 8]
    r2 = x * x + y * y
    if model in FISHEYE_MODELS:
        distance = F.sqrt(r2)
        theta = F.atan(distance)
        t2 = theta * theta
        bent = theta * (F.lit(1.0) + t2 * (d[0] + t2 * (d[1] + t2 * (d[2] + t2 * d[3]))))
        scale = F.when(distance > 0, bent / distance).otherwise(F.lit(1.0))
        xd, yd = x * scale, y * scale
    else:
        k1, k2, p1, p2, k3, k4, k5, k6 = d[:8]
        radial = (F.lit(1.0) + r2 * (k1 + r2 * (k2 + r2 * k3))) / (F.lit(1.0) + r2 * (k4 + r2 * (k5 + r2 * k6)))
        xd = x * radial + x * y * (2 * p1) + (r2 + x * x * 2) * p2
        yd = y * radial + (r2 + y * y * 2) * p1 + x * y * (2 * p2)
    return xd * k[0] + k[2], yd * k[1] + k[3]


def rectify(pixels: DataFrame, frame: list[str], value: str, k, d, p, model: str, r=None) -> DataFrame:
    """Undistorted images by bilinear sampling; pixels outside the raw image count as 0.

    ``pixels`` has integer ``u, v``.  Without distortion it is returned unchanged.
    """
    if all(abs(c) < 1e-8 for c in d):
        return pixels
    raw = pixels.select(*frame, F.col("u").alias("su"), F.col("v").alias("sv"), F.col(value).cast("double").alias("_value"))
    us, vs = source_pixel(F.col("u"), F.col("v"), k, d, p, model, r)
    grid = pixels.select(*frame, "u", "v").withColumns({"_us": us, "_vs": vs})
    corners = [
        F.struct(
            (F.floor("_us") + du).cast("int").alias("su"),
            (F.floor("_vs") + dv).cast("int").alias("sv"),
            ((F.lit(1.0) - F.abs(F.col("_us") - F.floor("_us") - du)) * (F.lit(1.0) - F.abs(F.col("_vs") - F.floor("_vs") - dv))).alias("w"),
        )
        for du in (0, 1)
        for dv in (0, 1)
    ]
    reads = grid.select(*frame, "u", "v", F.explode(F.array(*corners)).alias("c")).select(*frame, "u", "v", "c.*")
    joined = reads.join(raw, [*frame, "su", "sv"], "left")
    return joined.groupBy(*frame, "u", "v").agg(
        F.sum(F.col("w") * F.coalesce("_value", F.lit(0.0))).alias(value)
    )
