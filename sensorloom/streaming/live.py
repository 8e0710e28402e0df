"""Live state on Structured Streaming: latest message per topic, freshness, snapshots, sync."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sensorloom.operators.cloud import voxels
from sensorloom.operators.queued import forget, queue_sync
from sensorloom.operators.series import thin
from sensorloom.operators.skew import join_hot
from sensorloom.operators.ticks import collapse, newest_per_tick, tick_table
from sensorloom.session import names_below, new_path, remove


def read_log(spark: SparkSession, folder: str, file_glob: str, schema, files_per_trigger: int = 64) -> DataFrame:
    """Stream of log files that appear in a folder; the trigger limit bounds a micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", file_glob)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(folder)
    )


def subscribe(stream: DataFrame, topics: list[str]) -> DataFrame:
    """Messages of the configured topics."""
    return stream.filter(F.col("topic").isin(list(topics)))


def latest(stream: DataFrame, keys: list[str], payload: list[str], seq: str = "seq") -> DataFrame:
    """Last arrived payload per key; a later arrival wins even with an older stamp."""
    newest = stream.groupBy(*keys).agg(F.max_by(F.struct(seq, *payload), F.col(seq)).alias("_l"))
    return newest.select(*keys, "_l.*")


@dataclass(frozen=True)
class Place:
    """Where a stream keeps its output, its progress and its state: starting again there goes on where it ended."""

    out: str
    checkpoint: str
    states: str

    @staticmethod
    def new(spark: SparkSession, name: str) -> Place:
        return Place(*[new_path(spark, f"{name}{part}") for part in ("", "-offsets", "-state")])


def replay(log: DataFrame, part: str, folder: str, run: Callable[[], object]) -> None:
    """Append the log to ``folder`` part by part, as it would arrive, and call ``run`` after each."""
    for (number,) in sorted(log.select(part).distinct().collect()):
        log.filter(F.col(part) == number).drop(part).write.mode("append").parquet(folder)
        run()


def start(
    df: DataFrame,
    name: str,
    mode: str,
    write: Callable[[DataFrame, int, str], None] | None = None,
    every: str | None = None,
    place: Place | None = None,
) -> tuple[StreamingQuery, str]:
    """Start a stream that writes one table per micro-batch below the returned folder.

    It polls ``every`` interval, or stops after what is available now.  A batch that is run
    again after a failure overwrites its own folder, so results stay exact.
    """
    place = place or Place.new(df.sparkSession, name)
    out, checkpoint = place.out, place.checkpoint

    def save(batch: DataFrame, batch_id: int) -> None:
        target = f"{out}/batch={batch_id}"
        if write is None:
            batch.write.mode("overwrite").parquet(target)
        else:
            write(batch, batch_id, target)

    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(save)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start(), out


def run_available(
    df: DataFrame, name: str, mode: str, write: Callable[[DataFrame, int, str], None] | None = None, place: Place | None = None
) -> str:
    """Process what is available now and return the output folder."""
    query, out = start(df, name, mode, write, place=place)
    query.awaitTermination()
    return out


def read_updates(spark: SparkSession, path: str, keys: list[str], columns: list[str]) -> DataFrame:
    """Final state of an update-mode output: the newest micro-batch wins per key."""
    rows = spark.read.parquet(path)
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.col("batch")).alias("_l"))
    return newest.select(*keys, "_l.*")


def topic_status(catalog: DataFrame, latest_rows: DataFrame, now: Column | int) -> DataFrame:
    """Per configured topic whether data exists, its age at ``now``, and whether it is fresh (inclusive)."""
    age = (now if isinstance(now, Column) else F.lit(now)) - F.col("t")
    return catalog.join(latest_rows, "topic", "left").select(
        *catalog.columns,
        F.col("t").isNotNull().alias("seen"),
        age.alias("age"),
        F.coalesce((age <= F.col("max_age")) & (F.col("t") >= 0), F.lit(False)).alias("fresh"),
    )


def gate(status: DataFrame) -> DataFrame:
    """One row: all configured topics are fresh."""
    return status.agg(F.bool_and("fresh").alias("ready"), F.count_if("fresh").alias("n_fresh"), F.count(F.lit(1)).alias("n_topics"))


def snapshot(latest_rows: DataFrame, topics: list[str], value: str, times: bool = False) -> DataFrame:
    """All configured topics as one record, null where a topic was not seen."""
    cells = [F.max(F.when(F.col("topic") == t, F.col(value))).alias(t) for t in topics]
    if times:
        cells += [F.max(F.when(F.col("topic") == t, F.col("t"))).alias(f"{t}_t") for t in topics]
    return latest_rows.agg(*cells)


def newest_per_window(stream: DataFrame, time: str, dt: str, delay: str, keys: list[str], payload: list[str], seq: str = "seq") -> DataFrame:
    """Last message per time window; messages later than ``delay`` are ignored."""
    late = stream.withWatermark(time, delay)
    newest = late.groupBy(F.window(time, dt).alias("w"), *keys).agg(
        F.max_by(F.struct(seq, *payload), F.col(seq)).alias("_l")
    )
    return newest.select(F.col("w.start").alias("start"), *keys, "_l.*")


def thin_available(stream: DataFrame, key: str, gap: int, name: str = "thin", place: Place | None = None) -> str:
    """Greedy minimum-gap thinning across micro-batches; returns the folder of kept rows.

    Every micro-batch runs the batch operator on the rows at least ``gap`` after the last kept
    stamp of their key, so a hot key is thinned by many tasks.  The last stamps are stored per
    micro-batch, and a repeated batch starts again from the state before it; older states are removed.
    """
    spark, place = stream.sparkSession, place or Place.new(stream.sparkSession, name)
    states = place.states

    def write(batch: DataFrame, batch_id: int, target: str) -> None:
        rows = batch.select(key, "seq", "t")
        last = None
        if batch_id > 0:
            last = spark.read.parquet(f"{states}/{batch_id - 1}")
            rows = join_hot(rows, last, [key], ["seq"])
            rows = rows.filter(F.col("last").isNull() | (F.col("t") >= F.col("last") + gap)).drop("last")
        thin(rows, [key], gap).write.mode("overwrite").parquet(target)
        kept = spark.read.parquet(target).groupBy(key).agg(F.max("t").alias("last"))
        if last is not None:
            kept = kept.unionByName(last).groupBy(key).agg(F.max("last").alias("last"))
        kept.write.mode("overwrite").parquet(f"{states}/{batch_id}")
        remove(spark, f"{states}/{batch_id - 2}")

    return run_available(stream, name, "append", write, place)


def queue_sync_available(
    stream: DataFrame, keys: list[str], topics: list[str], slop: int, queue_size: int = 5, late: int = 0, name: str = "sets", place: Place | None = None
) -> str:
    """Sets of one message per topic with a spread of at most ``slop``, as messages arrive; returns their folder.

    Every micro-batch runs the batch operator from the queues the last one left, so a run that
    holds most messages is matched by many tasks.  The queues are stored per micro-batch, and a
    repeated batch starts from those before it.  Messages more than ``slop + late`` older than the newest
    one can't be matched by arrivals at most ``late`` behind it; they expire, and with them
    the state of runs that have ended.
    """
    spark, place = stream.sparkSession, place or Place.new(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int, target: str) -> None:
        entry = spark.read.parquet(f"{place.states}/{batch_id - 1}") if batch_id > 0 else None
        sets, state = queue_sync(batch.select(*keys, "topic", "seq", "t"), keys, topics, slop, queue_size, entry)
        sets.write.mode("overwrite").parquet(target)
        newest = batch.agg(F.max("t")).first()[0]
        kept = state if newest is None else forget(state, newest - slop - late)
        kept.write.mode("overwrite").parquet(f"{place.states}/{batch_id}")
        remove(spark, f"{place.states}/{batch_id - 2}")

    return run_available(stream, name, "append", write, place)


def ticks_available(stream: DataFrame, max_age: dict[str, int], period: int, late: int = 0, name: str = "ticks", place: Place | None = None) -> str:
    """Poll the log every ``period`` of its own time: snapshot and freshness gate per tick (``ticks.tick_table``).

    Polling begins at the first message.  A tick is written once a message more than ``late``
    newer than it has arrived; what arrives after that shows from the next tick on.  The
    state is a row per topic, and one per topic and tick that is still open; a repeated
    micro-batch starts from the state before it.
    """
    spark, place = stream.sparkSession, place or Place.new(stream.sparkSession, name)

    def write(batch: DataFrame, batch_id: int, target: str) -> None:
        newest = newest_per_tick(batch.filter(F.col("topic").isin(list(max_age))), period)
        closed = reached = None
        if batch_id > 0:
            state = spark.read.parquet(f"{place.states}/{batch_id - 1}")
            closed, reached = state.agg(F.max("closed"), F.max("reached")).first()
            newest = newest.unionByName(state.drop("closed", "reached"))
        begin = newest.agg(F.min("tick")).first()[0]
        stamps = [x for x in (reached, batch.agg(F.max("t")).first()[0]) if x is not None]
        if begin is None:
            first, last = 0, -period
        else:
            reached = max(stamps)
            first = begin if closed is None else closed + period
            last = max((reached - late - 1) // period * period, first - period)
        tick_table(newest, max_age, first, last, period).write.mode("overwrite").parquet(target)
        closed = last if begin is not None and last >= first else closed
        kept = newest if closed is None else newest.withColumn("tick", F.greatest("tick", F.lit(closed)))
        marks = {"closed": F.lit(closed).cast("bigint"), "reached": F.lit(reached).cast("bigint")}
        collapse(kept).withColumns(marks).write.mode("overwrite").parquet(f"{place.states}/{batch_id}")
        remove(spark, f"{place.states}/{batch_id - 2}")

    return run_available(stream, name, "append", write, place)


# The voxel map is kept on disk.
DISK_STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def voxels_available(
    points: DataFrame, origin: tuple, resolution: float, stamp: str = "t", compact: int = 16, name: str = "voxels", place: Place | None = None
) -> Place:
    """Keep hits, bounds and update times per voxel as points arrive; ``read_voxels`` reads the map.

    The totals are streaming state; a micro-batch writes the voxels that it touched.  After every
    ``compact`` micro-batches the map is written whole as a base, and what lies before the base
    before that is removed, so readers that began earlier keep their files.
    """
    spark, place = points.sparkSession, place or Place.new(points.sparkSession, name)

    def write(batch: DataFrame, batch_id: int, target: str) -> None:
        batch.write.mode("overwrite").parquet(target)
        if (batch_id + 1) % compact == 0:
            _voxel_rows(spark, place, batch_id - 1, batch_id).write.mode("overwrite").parquet(f"{place.states}/{batch_id}")
            before = batch_id - compact
            remove(spark, f"{place.states}/{before - compact}")
            for old in range(max(before - compact + 1, 0), before + 1):
                remove(spark, f"{place.out}/batch={old}")

    former = {k: spark.conf.get(k, None) for k in DISK_STATE}
    try:
        for k, v in DISK_STATE.items():
            spark.conf.set(k, v)
        run_available(voxels(points, [], origin, resolution, stamp), name, "update", write, place)
    finally:
        for k, v in former.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    return place


def _voxel_rows(spark: SparkSession, place: Place, upto_base: int, upto: int) -> DataFrame:
    """Newest row per voxel: of the last whole base up to one batch, and of the batches after it up to another."""
    bases = [int(b) for b in names_below(spark, place.states) if b.isdigit() and int(b) <= upto_base]
    whole = [b for b in bases if "_SUCCESS" in names_below(spark, f"{place.states}/{b}")]
    base = max(whole, default=-1)
    later = [n for n in names_below(spark, place.out) if n.startswith("batch=") and base < int(n[6:]) <= upto]
    parts = [spark.read.parquet(f"{place.out}/{n}").withColumn("_batch", F.lit(int(n[6:]))) for n in later]
    if base >= 0:
        parts.append(spark.read.parquet(f"{place.states}/{base}").withColumn("_batch", F.lit(base)))
    rows = reduce(DataFrame.unionByName, parts)
    cell = ["ix", "iy", "iz"]
    rest = [c for c in rows.columns if c not in (*cell, "_batch")]
    return rows.groupBy(*cell).agg(F.max_by(F.struct(*rest), F.col("_batch")).alias("_l")).select(*cell, "_l.*")


def read_voxels(spark: SparkSession, place: Place) -> DataFrame:
    """The voxel map as of the last finished micro-batch."""
    done = [int(n[6:]) for n in names_below(spark, place.out) if n.startswith("batch=") and "_SUCCESS" in names_below(spark, f"{place.out}/{n}")]
    return _voxel_rows(spark, place, max(done), max(done))
