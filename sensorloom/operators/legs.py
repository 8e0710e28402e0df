"""Transforms at stamps by legs: a leg is a moving edge of a path with the product of the static edges before it.

Static edges are multiplied once per pair of frames.  The poses around a stamp are found for moving edges
only, by one scan per frame, and interpolated and multiplied by numpy, a batch of whole paths at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorloom.functions.geometry import IDENTITY, chain, rigid_inverse
from sensorloom.operators.lifting import _numbers, _products
from sensorloom.operators.ordered import Scan, block_of, running, split_points
from sensorloom.operators.skew import join_hot
from sensorloom.session import cut_lineage, rows_per_block

PAIR, POSE = ["f1", "f2"], ["x", "y", "z", "qx", "qy", "qz", "qw"]
SIDES = {"prev": "p", "next": "n"}
COMPOSED = "f1 string, f2 string, t bigint, known boolean, matrix array<double>"


def pair_legs(steps: DataFrame, statics: DataFrame) -> DataFrame:
    """Legs of every pair, numbered from 0: moving ``frame``, ``up``, and the matrix ``fixed`` of static edges before it.

    ``frame`` is null in a last leg of static edges alone, in the only leg of a frame with itself, and where
    ``lacks`` tells that a static edge has no matrix.  ``fixed`` is null without static edges.
    """
    fixed = statics.select("frame", "matrix", F.lit(True).alias("_static"))
    placed = join_hot(steps, fixed, ["frame"], PAIR)
    moving, lacking = F.col("frame").isNotNull() & F.col("_static").isNull(), F.col("_static") & F.col("matrix").isNull()
    before = Window.partitionBy(*PAIR).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    numbered = placed.withColumn("leg", F.count(F.when(moving | lacking, 1)).over(before))
    m = F.when(F.col("up"), rigid_inverse(F.col("matrix"))).otherwise(F.col("matrix"))
    legs = numbered.groupBy(*PAIR, "leg").agg(
        F.max("_n").alias("_n"),
        F.max(F.when(moving, F.col("frame"))).alias("frame"),
        F.bool_or(moving & F.col("up")).alias("up"),
        F.coalesce(F.bool_or(lacking), F.lit(False)).alias("lacks"),
        F.sort_array(F.collect_list(F.when(F.col("matrix").isNotNull(), F.struct("pos", m.alias("m"))))).alias("_m"),
    )
    product = F.when(F.size("_m") > 0, chain(F.transform("_m", lambda s: s.getField("m"))))
    return legs.select(*PAIR, "leg", "_n", "frame", "up", "lacks", product.alias("fixed"))


def hot_frames(legs: DataFrame, samples: DataFrame) -> DataFrame:
    """Frames with more rows, asked or given, than a block; at most rows / block size."""
    given = samples.groupBy("frame").agg(F.count(F.lit(1)).alias("_n"))
    rows = legs.filter(F.col("frame").isNotNull()).select("frame", "_n").unionByName(given)
    counted = rows.groupBy("frame").agg(F.sum("_n").alias("_n"))
    return cut_lineage(counted.filter(F.col("_n") > rows_per_block(legs.sparkSession)).select("frame", F.lit(True).alias("_hot")))


def around(wanted: DataFrame, samples: DataFrame, hot: DataFrame, stamps: DataFrame) -> DataFrame:
    """``wanted`` rows of ``frame, t`` with the poses ``prev`` (at or before) and ``next`` (after) of their frame.

    Of several poses with one stamp the first in log order counts.  Only ``hot`` frames are cut
    into blocks, at boundaries drawn from all asked ``stamps`` and those of the poses.
    """
    first = samples.filter(F.col("seq").isNotNull() & F.col("t").isNotNull()).groupBy("frame", "t").agg(
        *[F.min_by(c, "seq").alias(c) for c in POSE]
    )
    given = first.select("frame", "t", F.lit(False).alias("_ask"), F.struct("t", *POSE).alias("_pose"))
    rows = given.unionByName(wanted.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    splits, block = [], None
    if not hot.isEmpty():
        splits = split_points(samples.select("t").unionAll(stamps), ["t"])
    if splits:
        rows = rows.join(F.broadcast(hot), "frame", "left")
        block = F.when(F.col("_hot"), block_of(rows, ["t"], splits)).otherwise(F.lit(0))
    # A pose comes before the rows that ask for its stamp, so the next one is later.
    scans = {"prev": Scan("last", "_pose"), "next": Scan("last", "_pose", reverse=True)}
    return running(rows, ["frame"], ["t", "_ask"], scans, block, splits).filter("_ask").drop("_ask", "_pose", "_hot")


def compose(legs: DataFrame, tol: int) -> DataFrame:
    """Product of the legs of every ``f1, f2, t``, null unless all poses are ``known``.

    Poses are interpolated as in ``interp.interpolate``; a value that is null makes those cells null that depend on it.
    """
    flat = [F.col(f"{side}.{c}").alias(f"{s}_{c}") for side, s in SIDES.items() for c in ("t", *POSE)]
    rows = legs.select(*PAIR, "t", "leg", "lacks", F.col("frame").isNotNull().alias("moving"), "up", "fixed", *flat)
    dealt = rows.repartition(*PAIR, "t").sortWithinPartitions(*PAIR, "t", "leg")

    def whole_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            starts = np.flatnonzero(batch.column("leg").to_numpy() == 0)
            if len(starts):
                held.append(batch.slice(0, int(starts[-1])))
                yield from _composed(held, tol)
                held = [batch.slice(int(starts[-1]))]
            else:
                held.append(batch)
        yield from _composed(held, tol)

    return dealt.mapInArrow(whole_paths, COMPOSED)


def _composed(batches: list[pa.RecordBatch], tol: int) -> Iterator[pa.RecordBatch]:
    """Products of the paths whose legs lie in the batches, in order."""
    if not (n := sum(len(b) for b in batches)):
        return
    rows = pa.Table.from_batches(batches).combine_chunks()
    moving = rows["moving"].to_numpy()
    cells, null = np.tile(IDENTITY, (n, 1)), np.zeros((n, 16), bool)
    known = ~rows["lacks"].to_numpy()
    at = np.flatnonzero(moving)
    if len(at):
        values, gaps = _poses(rows.take(pa.array(at)), tol)
        known[at] = ~gaps[:, 0]
        cells[at], null[at] = _matrices(values, gaps)
        up = at[rows["up"].to_numpy()[at]]
        cells[up], null[up] = _inverse(cells[up], null[up])
    fixed = rows["fixed"].combine_chunks()
    at = np.flatnonzero(fixed.is_valid().to_numpy(zero_copy_only=False))
    if len(at):
        left, gaps = _cells(fixed.take(pa.array(at)))
        cells[at], null[at] = _times((left, gaps), (cells[at], null[at]))
    starts = np.flatnonzero(rows["leg"].to_numpy() == 0)
    counts = np.diff(np.append(starts, n))
    out, gaps, all_known = cells[starts], null[starts], np.logical_and.reduceat(known, starts)
    for k in range(1, counts.max()):
        more = np.flatnonzero(counts > k)
        out[more], gaps[more] = _times((out[more], gaps[more]), (cells[starts[more] + k], null[starts[more] + k]))
    offsets = np.arange(len(starts) + 1, dtype=np.int32) * 16
    values = pa.array(out.ravel(), mask=gaps.ravel()) if gaps.any() else pa.array(out.ravel())
    matrix = pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~all_known))
    firsts = rows.select([*PAIR, "t"]).take(pa.array(starts)).combine_chunks()
    yield pa.RecordBatch.from_arrays([*[c.combine_chunks() for c in firsts.columns], pa.array(all_known), matrix], [*PAIR, "t", "known", "matrix"])


def _poses(rows: pa.Table, tol: int) -> tuple[np.ndarray, np.ndarray]:
    """Poses at the stamps ``t``, and which of their seven values are null."""
    t = rows["t"].to_numpy()
    there, stamp, pose, gap = {}, {}, {}, {}
    for s in SIDES.values():
        there[s] = rows[f"{s}_t"].is_valid().to_numpy()
        stamp[s] = rows[f"{s}_t"].fill_null(0).to_numpy()
        pose[s] = np.column_stack([rows[f"{s}_{c}"].fill_null(np.nan).to_numpy() for c in POSE])
        gap[s] = np.column_stack([rows[f"{s}_{c}"].is_null().to_numpy() for c in POSE])
    exact = there["p"] & (stamp["p"] == t)
    held = there["p"] & (exact | (~there["n"] & (t - stamp["p"] <= tol)))
    ahead = ~there["p"] & there["n"] & (stamp["n"] - t <= tol)
    found = held | ahead | (there["p"] & there["n"])
    a, b = (held | there["p"])[:, None], held[:, None]
    start, end = np.where(a, pose["p"], pose["n"]), np.where(b, pose["p"], pose["n"])
    gaps = np.where(a, gap["p"], gap["n"]) | np.where(b, gap["p"], gap["n"]) | ~found[:, None]
    between = found & ~held & ~ahead
    w = np.zeros(len(t))
    w[between] = (t - stamp["p"])[between] / (stamp["n"] - stamp["p"])[between]
    w = w[:, None]
    with np.errstate(all="ignore"):
        values = start + (end - start) * w
        qa, qb = start[:, 3:], end[:, 3:]
        dot = (qa * qb).sum(1, keepdims=True)
        d = np.fmin(1.0, np.abs(dot))
        theta, close = np.arccos(d), d > 0.9995
        wa = np.where(close, 1 - w, np.sin((1 - w) * theta) / np.sin(theta))
        wb = np.where(close, w, np.sin(w * theta) / np.sin(theta)) * np.where(dot < 0, -1.0, 1.0)
        q = wa * qa + wb * qb
        length = np.sqrt((q * q).sum(1, keepdims=True))
        values[:, 3:] = q / length
    # No rotation belongs to a quaternion of length 0.
    gaps[:, 3:] = gaps[:, 3:].any(1, keepdims=True) | (length == 0)
    return values, gaps


def _matrices(pose: np.ndarray, gaps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of poses, and which cells are null, as ``geometry.pose_matrix`` has them."""
    x, y, z, w = pose[:, 3:].T
    s = 2.0 / (x * x + y * y + z * z + w * w)
    out, null = np.tile(IDENTITY, (len(pose), 1)).reshape(-1, 4, 4), np.zeros((len(pose), 4, 4), bool)
    out[:, 0, :3] = np.column_stack([1 - s * (y * y + z * z), s * (x * y - z * w), s * (x * z + y * w)])
    out[:, 1, :3] = np.column_stack([s * (x * y + z * w), 1 - s * (x * x + z * z), s * (y * z - x * w)])
    out[:, 2, :3] = np.column_stack([s * (x * z - y * w), s * (y * z + x * w), 1 - s * (x * x + y * y)])
    out[:, :3, 3], null[:, :3, 3] = pose[:, :3], gaps[:, :3]
    null[:, :3, :3] = gaps[:, 3][:, None, None]
    return out.reshape(-1, 16), null.reshape(-1, 16)


def _inverse(cells: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``geometry.rigid_inverse``."""
    m, gap = cells.reshape(-1, 4, 4), null.reshape(-1, 4, 4)
    out, gaps = m.copy(), gap.copy()
    out[:, :3, :3], gaps[:, :3, :3] = m[:, :3, :3].transpose(0, 2, 1), gap[:, :3, :3].transpose(0, 2, 1)
    turned = m[:, :3, :3] * m[:, :3, 3:]
    out[:, :3, 3] = -(turned[:, 0] + turned[:, 1] + turned[:, 2])
    gaps[:, :3, 3] = (gap[:, :3, :3] | gap[:, :3, 3:]).any(1)
    return out.reshape(-1, 16), gaps.reshape(-1, 16)


def _times(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Products, and which cells are null: those with a null in their sum."""
    (a, no_a), (b, no_b) = left, right
    with np.errstate(all="ignore"):
        out = _products(a, b)
    out[:, 12:] = IDENTITY[12:]
    if not (no_a.any() or no_b.any()):
        return out, no_a
    no_a, no_b = no_a.reshape(-1, 4, 4), no_b.reshape(-1, 4, 4)
    gaps = no_a[:, :, :3].any(2)[:, :, None] | no_b[:, :3].any(1)[:, None, :]
    gaps[:, :, 3] |= no_a[:, :, 3]
    gaps[:, 3] = False
    return out, gaps.reshape(-1, 16)


def _cells(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Matrices of a column without null rows, and which cells are null."""
    numbers, odd = _numbers(column)
    null = np.zeros(numbers.shape, bool)
    for i in np.flatnonzero(odd):
        row = column[int(i)].as_py()
        null[i] = [v is None for v in row]
        numbers[i] = [np.nan if v is None else v for v in row]
    return numbers, null
