import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import cloud
from sensorloom.operators.queued import arrive
from sensorloom.operators.ticks import newest_per_tick, tick_table
from sensorloom.streaming import live

SCHEMA = "topic string, seq bigint, t bigint, value double"


def rows(n=150, seed=2):
    r = random.Random(seed)
    t, out = 0, []
    for i in range(n):
        t += r.randrange(0, 6)
        out.append((r.choice(["hot", "hot", "b", "c"]), i, t - r.randrange(0, 4), float(i)))
    return out


@pytest.fixture
def stream(spark, tmp_path):
    folder = str(tmp_path / "log")
    for i in range(3):
        spark.createDataFrame(rows()[50 * i : 50 * (i + 1)], SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    return live.read_log(spark, folder, "*.parquet", spark.read.parquet(folder).schema, files_per_trigger=1)


def test_latest_is_by_arrival(spark, stream):
    out = live.run_available(live.latest(stream, ["topic"], ["t", "value"]), "latest", "update")
    got = {r.topic: (r.seq, r.t) for r in live.read_updates(spark, out, ["topic"], ["seq", "t"]).collect()}
    assert got == {topic: (s, t) for topic, s, t, _ in rows()}
    assert spark.read.parquet(out).select("batch").distinct().count() == 3


def test_periodic_polling(spark, stream):
    query, out = live.start(live.latest(stream, ["topic"], ["t"]), "poll", "update", every="100 milliseconds")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    got = {r.topic: r.seq for r in live.read_updates(spark, out, ["topic"], ["seq", "t"]).collect()}
    assert got == {topic: s for topic, s, _, _ in rows()}


def test_thinning_over_batches_equals_the_sequential_rule(spark, stream, small_blocks):
    got = {tuple(r) for r in spark.read.parquet(live.thin_available(stream, "topic", 10)).select("topic", "seq", "t").collect()}
    last, want = {}, set()
    for topic, s, t, _ in rows():
        if topic not in last or t - last[topic] >= 10:
            last[topic] = t
            want.add((topic, s, t))
    assert got == want


def test_approximate_sync_over_batches(spark, stream):
    topics = ["hot", "b", "c"]
    keyed = stream.withColumn("run", F.lit(1).cast("bigint"))
    out = live.queue_sync_available(keyed, ["run"], topics, 6, queue_size=3, late=3)
    got = {tuple(r) for r in spark.read.parquet(out).select("t_0", "seq_0", "t_1", "seq_1", "t_2", "seq_2").collect()}
    # Lists in order of arrival; sorting by stamp keeps that order among equal stamps.
    waiting, want = {x: [] for x in topics}, set()
    for topic, s, t, _ in rows():
        waiting[topic] = sorted(waiting[topic] + [(t, s)])[-3:]
        if (t, s) in waiting[topic] and all(waiting.values()):
            near = {x: sorted(waiting[x], key=lambda m: (abs(m[0] - t), m[0], m[1]))[0] for x in topics} | {topic: (t, s)}
            stamps = [m[0] for m in near.values()]
            if max(stamps) - min(stamps) <= 6:
                want.add(tuple(v for x in topics for v in near[x]))
                waiting = {x: [m for m in waiting[x] if m != near[x]] for x in topics}
    assert got == want and len(got) > 5
    assert all(max(g[0], g[2], g[4]) - min(g[0], g[2], g[4]) <= 6 for g in got)
    assert len({g[1] for g in got}) == len(got)


def test_queue_keeps_the_newest_stamps():
    queues = [set(), set()]
    for seq, t in enumerate([1, 2, 3, 4]):
        arrive(queues, 0, t, seq, 0, 2)
    assert queues[0] == {(3, 2), (4, 3)}
    assert arrive(queues, 0, 1, 9, 5, 2) is None and (1, 9) not in queues[0]
    assert arrive(queues, 1, 4, 7, 0, 2) == [4, 3, 4, 7]


def test_equal_stamps_of_a_topic_are_kept():
    queues = [set(), set()]
    for seq in (0, 1):
        arrive(queues, 0, 5, seq, 0, 2)
    assert [arrive(queues, 1, 5, seq, 0, 2) for seq in (2, 3)] == [[5, 0, 5, 2], [5, 1, 5, 3]]


def test_status_and_gate(spark):
    catalog = spark.createDataFrame([("a", 10), ("b", 10), ("c", 10)], "topic string, max_age bigint")
    latest = spark.createDataFrame([("a", 90), ("b", 89)], "topic string, t bigint")
    status = live.topic_status(catalog, latest, 100)
    got = {r.topic: (r.seen, r.age, r.fresh) for r in status.collect()}
    assert got == {"a": (True, 10, True), "b": (True, 11, False), "c": (False, None, False)}
    assert tuple(live.gate(status).first()) == (False, 1, 3)
    assert live.gate(status.filter("topic = 'a'")).first().ready
    snap = live.snapshot(latest.withColumn("v", F.col("t") * 2), ["a", "c"], "v", times=True).first()
    assert tuple(snap) == (180, None, 90, None)


def test_windows(spark, tmp_path):
    folder = str(tmp_path / "w")
    df = spark.createDataFrame([("a", 1, 5, 1.0), ("a", 2, 9, 2.0), ("a", 3, 12, 3.0)], SCHEMA)
    df.withColumn("ts", F.timestamp_seconds("t")).write.parquet(folder)
    s = live.read_log(spark, folder, "*.parquet", spark.read.parquet(folder).schema)
    out = live.run_available(live.newest_per_window(s, "ts", "10 seconds", "5 seconds", ["topic"], ["value"]), "w", "update")
    got = {(r.start.second, r.value) for r in live.read_updates(spark, out, ["start", "topic"], ["seq", "value"]).collect()}
    assert got == {(0, 2.0), (10, 3.0)}


AGES = {"hot": 3, "b": 9, "c": 20, "never": 5}


def shown(messages, tick, period):
    """Row of a tick by brute force: value and stamp per topic, and how many are fresh."""
    seen = {topic: (t, v) for topic, _, t, v in sorted(messages, key=lambda m: m[1]) if -(-t // period) * period <= tick}
    fresh = sum(x in seen and tick - seen[x][0] <= age for x, age in AGES.items())
    return (tick, fresh == len(AGES), fresh, *[part for x in AGES for part in (seen.get(x, (None, None))[1], seen.get(x, (None, None))[0])])


@pytest.mark.parametrize("late", [0, 4])
def test_ticks_over_batches(spark, stream, late):
    period, want, first, closed = 7, [], None, None
    for end in (50, 100, 150):
        arrived = rows()[:end]
        if first is None:
            first = min(-(-m[2] // period) * period for m in arrived)
        tick = first if closed is None else closed + period
        while tick < max(m[2] for m in arrived) - late:
            want.append(shown(arrived, tick, period))
            tick, closed = tick + period, tick
    got = spark.read.parquet(live.ticks_available(stream, AGES, period, late)).drop("batch")
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == want and len(want) > 20


def test_ticks_in_small_blocks(spark, small_blocks):
    log = spark.createDataFrame(rows(), SCHEMA)
    got = tick_table(newest_per_tick(log, 3), AGES, 0, 300, 3).orderBy("tick").collect()
    assert [tuple(r) for r in got] == [shown(rows(), tick, 3) for tick in range(0, 301, 3)]
    everywhere = tick_table(newest_per_tick(log.filter("topic = 'c'"), 3), {"c": 1000}, 300, 303, 3).collect()
    assert [r.ready for r in everywhere] == [True, True]


def test_ticks_without_messages_of_the_topics(spark, stream):
    assert spark.read.parquet(live.ticks_available(stream, {"never": 1}, 10)).isEmpty()


def test_voxel_map_over_batches(spark, tmp_path):
    folder, r = str(tmp_path / "points"), random.Random(4)
    points = [(i, r.random() * 3, r.random() * 2, r.random()) for i in range(300)]
    schema, place = "t bigint, x double, y double, z double", live.Place.new(spark, "map")
    for i in range(6):
        part = spark.createDataFrame(points[50 * i : 50 * (i + 1)], schema)
        part.coalesce(1).write.mode("append").parquet(folder)
        # A stream that is started again goes on from its state.
        feed = live.read_log(spark, folder, "*.parquet", part.schema)
        live.voxels_available(feed, (0.0, 0.0, 0.0), 0.5, compact=2, place=place)
        known = spark.createDataFrame(points[: 50 * (i + 1)], schema)
        want = sorted(map(tuple, cloud.voxels(known, [], (0.0, 0.0, 0.0), 0.5).collect()))
        assert sorted(map(tuple, live.read_voxels(spark, place).collect())) == want
    assert live.names_below(spark, place.states) == ["3", "5"]
    assert [n for n in live.names_below(spark, place.out) if n.startswith("batch=")] == ["batch=4", "batch=5"]
    # A base that was not finished is not read.
    (Path(place.states.removeprefix("file:")) / "5" / "_SUCCESS").unlink()
    assert sorted(map(tuple, live.read_voxels(spark, place).collect())) == want
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").find("RocksDB") < 0
