"""Queries that run the message log as a stream and return the state it reaches."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions.stamps import micros
from sensorloom.plans.cloud_queries import ORIGIN, VOXEL, cloud_points
from sensorloom.plans.registry import HOUR, LOG, TOPIC_ROWS, TOPICS, query
from sensorloom.plans.sync_queries import QUEUE, QUEUE_SYNC, SLOP, SYNCED
from sensorloom.session import new_path
from sensorloom.streaming import live


PARTS = 4


def _stream(t, folder: str | None = None, glob: str = "events.parquet"):
    raw = live.read_log(t.spark, folder or t.folder, glob, t.events.schema)
    return raw.select(
        F.col("event_type").alias("topic"), F.col("user_id").alias("run"), F.col("event_id").alias("seq"), micros("ts").alias("t"),
        F.col("ts").cast("timestamp").alias("ts"), "value",
    )


def _parts(log):
    """Number of the quarter of the log's time a message lies in."""
    first, last = log.select(F.min(micros("ts")), F.max(micros("ts"))).first()
    if first is None:
        return F.lit(0)
    return F.floor((micros("ts") - first) * PARTS / (last - first + 1)).cast("int")


def _feed(t, log, part, run):
    """Place of a stream that is started anew, from its stored state, for each of the parts in which ``log`` arrives."""
    folder, place = new_path(t.spark, "feed"), live.Place.new(t.spark, "live")
    live.replay(log.withColumn("part", part), "part", folder, lambda: run(folder, place))
    return place


def _arrived(t, log, run, part=None):
    """Output of such a stream of messages; by default they arrive in the order of time."""
    place = _feed(t, log, _parts(log) if part is None else part, lambda folder, place: run(_stream(t, folder, "*.parquet"), place))
    return t.spark.read.parquet(place.out)


def _latest(t):
    newest = live.latest(live.subscribe(_stream(t), TOPICS), ["topic"], ["t", "value"])
    out = live.run_available(newest, "latest", "update")
    return live.read_updates(t.spark, out, ["topic"], ["seq", "t", "value"])


LAST = f"{LOG}, l AS (SELECT topic, max(seq) AS seq, arg_max(t, seq) AS t, arg_max(value, seq) AS value FROM log GROUP BY topic)"
AGES = f"{LAST}, now AS (SELECT max(t) AS now FROM log), s AS (SELECT topic, l.t IS NOT NULL AS seen, now - l.t AS age, coalesce(now - l.t <= {HOUR // 2}, false) AS fresh FROM {TOPIC_ROWS} LEFT JOIN l USING (topic), now)"


@query(f"WITH {LAST} SELECT topic, seq, t, value FROM l")
def stream_latest(t):
    """Last arrived message per topic."""
    return _latest(t)


def _status(t):
    """Status of the configured topics at the end of the log; half an hour counts as fresh."""
    catalog = t.spark.createDataFrame([(x, HOUR // 2) for x in TOPICS], "topic string, max_age bigint")
    now = t.log().agg(F.max("t")).scalar()
    return live.topic_status(catalog, _latest(t), now)


@query(f"WITH {AGES} SELECT topic, seen, age, fresh FROM s")
def topic_status(t):
    """Existence and age per configured topic."""
    return _status(t).select("topic", "seen", "age", "fresh")


@query(f"WITH {AGES} SELECT bool_and(fresh) AS ready, count(*) FILTER (WHERE fresh) AS n_fresh, count(*) AS n_topics FROM s")
def freshness_gate(t):
    """Whether all configured topics are fresh."""
    return live.gate(_status(t))


@query(f"WITH {LAST} SELECT " + ", ".join(f"max(CASE WHEN topic = '{x}' THEN value END) AS {x}" for x in TOPICS) + " FROM l")
def stream_snapshot(t):
    """Latest values of all topics as one record."""
    return live.snapshot(_latest(t), TOPICS, "value")


@query(
    f"""WITH {LOG}, b AS (SELECT min(t) AS s, max(t) - min(t) + 1 AS n FROM log)
SELECT (t // {24 * HOUR}) * {24 * HOUR} AS start, topic, max(seq) AS seq, arg_max(value, seq) AS value FROM log, b
WHERE NOT (seq % 10 = 0 AND (t - s) * {PARTS} < n) GROUP BY 1, topic"""
)
def stream_grid(t):
    """Last message per topic and day; a tenth of the first quarter arrives at the end, behind the watermark, and is ignored."""
    part = _parts(t.events)
    late = (F.col("event_id") % 10 == 0) & (part == 0)

    def run(stream, place):
        newest = live.newest_per_window(stream, "ts", "1 day", "1 hour", ["topic"], ["value"])
        return live.run_available(newest.withColumn("start", F.unix_micros("start")), "grid", "update", place=place)

    rows = _arrived(t, t.events, run, F.when(late, PARTS - 1).otherwise(part))
    return rows.groupBy("start", "topic").agg(F.max_by(F.struct("seq", "value"), F.col("batch")).alias("l")).select("start", "topic", "l.*")


@query(
    f"""WITH RECURSIVE {LOG},
nxt AS (SELECT topic, t, min(t) OVER (PARTITION BY topic ORDER BY t RANGE BETWEEN {HOUR} FOLLOWING AND UNBOUNDED FOLLOWING) AS nt FROM log),
kept AS (SELECT topic, min(t) AS t FROM log GROUP BY topic
         UNION ALL SELECT kept.topic, nxt.nt FROM kept JOIN nxt USING (topic, t) WHERE nxt.nt IS NOT NULL)
SELECT topic, seq, t FROM kept JOIN log USING (topic, t)"""
)
def stream_thin(t):
    """Minimum-gap thinning as messages arrive in four files one after another."""
    return _arrived(t, t.events, lambda stream, place: live.thin_available(stream, "topic", HOUR, place=place)).select("topic", "seq", "t")


@query(QUEUE_SYNC)
def stream_approx_sync(t):
    """Sets of click, view and purchase within twelve hours, as messages arrive in four files one after another."""
    return _arrived(
        t, t.events, lambda stream, place: live.queue_sync_available(stream, ["run"], SYNCED, SLOP, QUEUE, name="sets", place=place)
    ).drop("batch")


PERIOD = 6 * HOUR
MAX_AGE = {topic: (i + 1) * HOUR // 2 for i, topic in enumerate(TOPICS)}
AGE_ROWS = "(VALUES " + ", ".join(f"('{topic}', {age})" for topic, age in MAX_AGE.items()) + ") AS ages(topic, age)"


@query(
    f"""WITH {LOG}, m AS (SELECT topic, (t + {PERIOD - 1}) // {PERIOD} * {PERIOD} AS tick, max(seq) AS seq FROM log GROUP BY ALL),
k AS (SELECT unnest(range((SELECT min(tick) FROM m), (SELECT max(t) FROM log), {PERIOD})) AS tick),
g AS (SELECT tick, topic, age, max(m.seq) OVER (PARTITION BY topic ORDER BY tick) AS seq FROM k CROSS JOIN {AGE_ROWS} LEFT JOIN m USING (topic, tick)),
s AS (SELECT tick, g.topic, t, value, coalesce(tick - t <= age, false) AS fresh FROM g LEFT JOIN log USING (seq))
SELECT tick, bool_and(fresh) AS ready, CAST(count(*) FILTER (WHERE fresh) AS INTEGER) AS n_fresh, """
    + ", ".join(f"max(CASE WHEN topic = '{x}' THEN value END) AS {x}, max(CASE WHEN topic = '{x}' THEN t END) AS {x}_t" for x in TOPICS)
    + " FROM s GROUP BY tick"
)
def stream_ticks(t):
    """Snapshot and freshness gate every six hours of the log's time, as messages arrive in four files one after another."""
    return _arrived(t, t.events, lambda stream, place: live.ticks_available(stream, MAX_AGE, PERIOD, place=place)).drop("batch")


@query(
    f"""WITH {VOXEL} SELECT ix, iy, iz, count(*) AS hits, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, min(z) AS min_z, max(z) AS max_z,
min(vec_id) AS first_update, max(vec_id) AS last_update FROM c GROUP BY ix, iy, iz"""
)
def stream_voxels(t):
    """Hits, bounds and update times per voxel as points arrive in four files; the map is compacted after every second one."""

    def run(folder, place):
        vectors = live.read_log(t.spark, folder, "*.parquet", t.embeddings.schema)
        live.voxels_available(cloud_points(vectors), ORIGIN, 0.2, "vec_id", compact=2, place=place)

    place = _feed(t, t.embeddings, F.pmod("vec_id", F.lit(PARTS)), run)
    return live.read_voxels(t.spark, place)
