"""Log to synchronised dataset, and depth maps from stacked clouds, as whole plans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.functions.geometry import transform_point
from sensorloom.model import INTERP, REGISTRY, flatten
from sensorloom.operators import asof, cloud, sync
from sensorloom.operators.interp import interpolate
from sensorloom.operators.skew import join_hot
from sensorloom.session import cut_lineage
from sensorloom.sources import writers


@dataclass(frozen=True)
class Synchronised:
    """Matches of every step and topic, and the kept steps with their frame number."""

    matches: DataFrame
    frames: DataFrame

    def frame_matches(self, keys: list[str] = ()) -> DataFrame:
        """Matches of kept steps, numbered by frame."""
        return self.matches.join(self.frames.select(*keys, "idx", "frame"), [*keys, "idx"])


def synchronise(
    messages: DataFrame,
    topics: list[str],
    dt: int,
    tol: int,
    nearest: bool = False,
    keys: list[str] = (),
    interval: DataFrame | None = None,
    whole_log: DataFrame | None = None,
) -> Synchronised:
    """Put topics on a common grid and keep the steps at which all of them are valid.

    The grid spans the whole log, not only the selected topics.  ``interval`` holds the
    ``t_min`` and ``t_max`` per run (one row without run keys) that matched stamps must lie
    strictly between; all frames of the log can be related there.
    """
    keys = list(keys)
    bounds = asof.grid_bounds(messages if whole_log is None else whole_log, keys, "t", dt)
    matches = asof.match_grid(messages, bounds, topics, dt, keys, nearest=nearest)
    bounded, t_min, t_max = matches, None, None
    if interval is not None:
        t_min, t_max = F.col("t_min"), F.col("t_max")
        bounded = join_hot(matches, interval, keys, ["idx"], "inner") if keys else asof.with_single(matches, interval)
    frames = sync.compact(sync.valid_steps(bounded, tol, keys, t_min, t_max), keys)
    return Synchronised(matches, frames)


def export(
    messages: dict[str, DataFrame], catalog: list[dict], dt: int, tol: int, path: str, whole_log: DataFrame | None = None
) -> None:
    """Write a synchronised dataset: decoded records per type, and stamps and errors per topic.

    ``messages`` has a table ``topic, seq, t, payload`` per type, ``catalog`` the outputs as
    ``group, name, topic, type``.  Records of a type go to the folder of its name, by group and
    output, with the frame as ``idx``; stamps go to ``stamps``.
    """
    unknown = {c["type"] for c in catalog} - set(messages)
    if unknown:
        raise ValueError(f"no messages of types {sorted(unknown)}")
    topics = sorted({c["topic"] for c in catalog})
    log = reduce(DataFrame.unionByName, [m.select("topic", "seq", "t") for m in messages.values()])
    matches = cut_lineage(synchronise(log, topics, dt, tol, whole_log=whole_log).frame_matches())
    writers.write_stamps(matches, f"{path}/stamps")
    for type_name, typed in messages.items():
        outputs = [(c.get("group", ""), c["name"], c["topic"]) for c in catalog if c["type"] == type_name]
        if not outputs:
            continue
        carried = [c for c in ("payload", "child_frame_id") if c in typed.columns]
        found = matches.filter(F.col("topic").isin([topic for *_, topic in outputs]))
        found = sync.attach_payload(found, typed, ["topic"], carried)
        entries = typed.sparkSession.createDataFrame(outputs, "`group` string, name string, topic string")
        named = sync.fan_out(found.select("topic", F.col("frame").alias("idx"), F.col("match").alias("t"), *carried), entries)
        records = flatten(named, type_name, ["group", "name", "idx", "t"])
        writers.write_dataset(records, f"{path}/{type_name}", ("group", "name"))


def interpolate_type(
    targets: DataFrame, records: DataFrame, type_name: str, keys: list[str], tol: int, splits: list | None = None
) -> DataFrame:
    """Flat records of a type at every target stamp: its vectors linearly, its rotation by slerp."""
    spec = REGISTRY[type_name]
    if spec.time_spec != INTERP or not spec.vectors:
        raise ValueError(f"{type_name} can't be interpolated")
    return interpolate(targets, records, keys, list(spec.vectors), tol, list(spec.quaternion), splits=splits)


def depth_frames(
    points: DataFrame,
    frame: str,
    stack: int,
    transforms: DataFrame,
    camera: tuple[float, float, float, float],
    width: int,
    height: int,
    max_depth: float,
    spread: list[str],
    mask: DataFrame | None = None,
) -> DataFrame:
    """Depth maps of stacked clouds seen through a camera.

    ``transforms`` has one ``matrix`` per frame from cloud to camera; frames without one, or
    without a visible point, have no depth map.
    """
    placed = cloud.stack_frames(points, frame, stack, transforms.select(frame, "matrix"), spread)
    x, y, z = transform_point(F.col("matrix"), F.col("x"), F.col("y"), F.col("z"))
    seen = cloud.in_view(
        placed.select("stack", x.alias("x"), y.alias("y"), z.alias("z")), width, height, *camera, max_depth
    )
    depth = cloud.depth_map(seen, ["stack"]).withColumnRenamed("stack", frame)
    return depth if mask is None else cloud.mask_region(depth, mask, ["u", "v"], [frame])
