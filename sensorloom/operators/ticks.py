"""Polling a log at a rate: what every topic shows at every tick, and whether all are fresh."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom.operators.ordered import Scan, dense_index, running
from sensorloom.session import rows_per_block

SEEN = ["seq", "t", "value"]


def newest_per_tick(messages: DataFrame, period: int) -> DataFrame:
    """Last arrived message per topic and ``tick``, the first multiple of ``period`` at or after its stamp."""
    return collapse(messages.withColumn("tick", F.col("t") + F.pmod(-F.col("t"), F.lit(period))))


def collapse(newest: DataFrame) -> DataFrame:
    """Last arrived message per topic and tick."""
    best = newest.groupBy("topic", "tick").agg(F.max(F.struct(*SEEN)).alias("_l"))
    return best.select("topic", "tick", "_l.*")


def tick_table(newest: DataFrame, max_age: dict[str, int], first: int, last: int, period: int) -> DataFrame:
    """One row per tick from ``first`` to ``last``: value and stamp of every topic, and the freshness gate.

    A tick shows, per topic of ``max_age``, the last arrived of the messages whose tick is not
    later, or null.  A topic is fresh up to its age, inclusive.  Messages are reduced to one
    row per tick first; ticks are numbered, so blocks of the scan need no sample.
    """
    spark = newest.sparkSession
    steps = (last - first) // period
    seen = newest.select("topic", F.greatest("tick", F.lit(first)).alias("tick"), F.struct(*SEEN).alias("_l"))
    cells = seen.groupBy("tick").agg(*[F.max(F.when(F.col("topic") == x, F.col("_l"))).alias(f"_c{i}") for i, x in enumerate(max_age)])
    bounds = spark.range(1).select(F.lit(0).cast("bigint").alias("lo"), F.lit(steps).cast("bigint").alias("hi"))
    ticks = dense_index(bounds, [], "lo", "hi").select("idx", (F.col("idx") * period + first).alias("tick"))
    per_block = rows_per_block(spark)
    block = F.floor(F.col("idx") / per_block) if steps >= per_block else None
    scans = {f"_s{i}": Scan("max", f"_c{i}") for i in range(len(max_age))}
    shown = running(ticks.join(cells, "tick", "left"), [], ["tick"], scans, block, [])
    fresh = [F.coalesce(F.col("tick") - F.col(f"_s{i}.t") <= age, F.lit(False)) for i, age in enumerate(max_age.values())]
    count = sum((f.cast("int") for f in fresh), F.lit(0))
    values = [c for i, x in enumerate(max_age) for c in (F.col(f"_s{i}.value").alias(x), F.col(f"_s{i}.t").alias(f"{x}_t"))]
    return shown.select("tick", (count == len(max_age)).alias("ready"), count.alias("n_fresh"), *values)
