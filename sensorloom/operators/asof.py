"""As-of matching of message series to a time grid or to another series.

All stamps are integer microseconds.  Both forms reduce the messages to one row per stamp or
grid cell with a map-side aggregate first, then carry the last and next message over the
ordered axis with block scans, so a topic that holds most of the log stays distributed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import Scan, dense_index, running, split_points
from sensorloom.operators.skew import join_hot
from sensorloom.session import cut_lineage

GRID_BLOCK = 16384


def floor_div(a: Column, b: int) -> Column:
    """Exact integer quotient, rounded down also below zero."""
    return F.call_function("div", a - F.pmod(a, F.lit(b)), F.lit(b)).cast("bigint")


def grid_bounds(messages: DataFrame, keys: list[str], time: str, dt: int) -> DataFrame:
    """Start, end and number of grid steps per run; the end itself is excluded.

    The log is read once for it: the one row per run is stored, since grid and messages both
    need it.
    """
    spans = messages.groupBy(*keys).agg(F.min(time).alias("start"), F.max(time).alias("stop"))
    return cut_lineage(spans.withColumn("n_steps", -floor_div(F.col("start") - F.col("stop"), dt)))


def time_grid(bounds: DataFrame, keys: list[str], dt: int) -> DataFrame:
    """``start + idx * dt`` for every step before ``stop``."""
    span = bounds.select(*keys, "start", F.lit(0).alias("_lo"), (F.col("n_steps") - 1).alias("_hi"))
    return dense_index(span, keys, "_lo", "_hi").select(
        *keys, "idx", (F.col("start") + F.col("idx") * dt).alias("target")
    )


def topic_grid(bounds: DataFrame, keys: list[str], topics: list[str], dt: int) -> DataFrame:
    """The time grid once per configured topic, whether the topic occurs or not."""
    return time_grid(bounds, keys, dt).withColumn("topic", F.explode(F.lit(list(topics))))


def match_grid(
    messages: DataFrame,
    bounds: DataFrame,
    topics: list[str],
    dt: int,
    keys: list[str] = (),
    time: str = "t",
    seq: str = "seq",
    nearest: bool = False,
) -> DataFrame:
    """Per grid step and topic the matched stamp and the absolute error.

    Backward matching takes the latest message at or before the target; ``nearest`` also
    looks ahead.  Equal errors go to the message that came first in the log.  Steps without
    a match have nulls.
    """
    keys = list(keys)
    wanted = messages.filter(F.col("topic").isin(list(topics))).select(*keys, "topic", time, seq)
    if keys:
        placed = join_hot(wanted, bounds, keys, [time, seq], "inner")
    else:
        placed = with_single(wanted, bounds)
    offset = F.col(time) - F.col("start")
    by = [*keys, "topic"]
    late = F.struct(F.col(time).alias("t"), (-F.col(seq)).alias("s")) if nearest else F.col(time)
    up = F.greatest(F.lit(0), -floor_div(-offset, dt))
    cells = (
        placed.select(*by, up.alias("idx"), late.alias("late"))
        .groupBy(*by, "idx")
        .agg(F.max("late").alias("late"))
    )
    out = topic_grid(bounds, keys, topics, dt).join(cells, [*by, "idx"], "left")
    scans = {"late": Scan("last" if nearest else "max", "late")}
    if nearest:
        early = F.struct(F.col(time).alias("t"), F.col(seq).alias("s"))
        down = F.least(F.col("n_steps") - 1, floor_div(offset, dt))
        ahead = (
            placed.select(*by, down.alias("idx"), early.alias("early"))
            .groupBy(*by, "idx")
            .agg(F.min("early").alias("early"))
        )
        out = out.join(ahead, [*by, "idx"], "left")
        scans["early"] = Scan("last", "early", reverse=True)
    out = running(out, by, ["idx"], scans, block=F.floor(F.col("idx") / GRID_BLOCK).cast("int"))
    match = F.col("late")
    if nearest:
        match = F.least(
            _candidate(F.col("target"), F.col("late.t"), -F.col("late.s")),
            _candidate(F.col("target"), F.col("early.t"), F.col("early.s")),
        ).getField("t")
    return out.select(*by, "idx", "target", match.alias("match")).withColumn(
        "err", F.abs(F.col("target") - F.col("match"))
    )


def with_single(df: DataFrame, single: DataFrame) -> DataFrame:
    """Attach the one row of a global aggregate to every row, as scalar subqueries."""
    return df.withColumns({c: single.select(c).scalar() for c in single.columns})


def _candidate(target: Column, t: Column, s: Column) -> Column:
    """``least`` skips nulls and orders by error, then log order."""
    return F.when(t.isNotNull(), F.struct(F.abs(target - t).alias("err"), s.alias("s"), t.alias("t")))


def match_series(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    time: str = "t",
    seq: str = "seq",
    payload: list[str] = (),
    splits: list | None = None,
) -> DataFrame:
    """Previous and next ``right`` row (stamp inclusive) for every distinct stamp of ``left``.

    Returns ``keys, time, prev, next``; the latter are structs ``(t, s, payload...)`` or null.  Of
    several messages with one stamp the first in log order counts.  ``splits`` may give block
    boundaries when the inputs are costly to read twice.
    """
    if splits is None:
        splits = split_points(left.select(time).unionAll(right.select(time)), [time])
    carried = {f"_p{i}": c for i, c in enumerate(payload)}
    message = F.struct(F.col("_s").alias("s"), F.col(time).alias("t"), *[F.col(p).alias(c) for p, c in carried.items()])
    stamps = (
        left.select(*keys, time, F.lit(True).alias("_want"))
        .unionByName(
            right.select(*keys, time, F.col(seq).alias("_s"), *[F.col(c).alias(p) for p, c in carried.items()]),
            allowMissingColumns=True,
        )
        .groupBy(*keys, time)
        .agg(F.max("_want").alias("_want"), *[F.min_by(p, "_s").alias(p) for p in carried], F.min("_s").alias("_s"))
        .select(*keys, time, "_want", F.when(F.col("_s").isNotNull(), message).alias("_msg"))
    )
    scanned = running(
        stamps,
        keys,
        [time],
        {"prev": Scan("last", "_msg"), "next": Scan("last", "_msg", reverse=True)},
        splits=splits,
    )
    return scanned.filter("_want").select(*keys, time, "prev", "next")


def match_backward(left, right, keys, time="t", seq="seq", payload=()):
    """Latest right row at or before each left stamp, with its absolute error."""
    m = match_series(left, right, keys, time, seq, payload)
    return m.withColumn("match", F.col("prev")).withColumn("err", F.col(time) - F.col("prev.t")).drop("prev", "next")


def match_nearest(left, right, keys, time="t", seq="seq", payload=(), cutoff: int | None = None, splits=None):
    """Nearest right row on either side; equal errors go to the smaller ``seq``.

    ``cutoff`` is inclusive: a match exactly that far away is kept.
    """
    m = match_series(left, right, keys, time, seq, payload, splits)

    def cand(side: str) -> Column:
        c = F.col(side)
        return F.when(
            c.isNotNull(),
            F.struct(F.abs(F.col(time) - c.getField("t")).alias("err"), c.getField("s").alias("s"), c.alias("m")),
        )

    best = m.withColumn("_b", F.least(cand("prev"), cand("next")))
    out = best.select(*keys, time, F.col("_b.m").alias("match"), F.col("_b.err").alias("err"))
    return out if cutoff is None else out.filter(F.col("err") <= cutoff)
