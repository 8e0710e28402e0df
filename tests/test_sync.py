import random

import pytest
from pyspark.sql import functions as F

from sensorloom.operators import asof, interp, sync
from sensorloom.plans.export import export, interpolate_type, synchronise

LOG = "topic string, seq bigint, t bigint, value double"


def grid(spark, rows, topics, dt, start, stop, nearest=False):
    log = spark.createDataFrame(rows, LOG)
    bounds = spark.createDataFrame([(start, stop, -((start - stop) // dt))], "start bigint, stop bigint, n_steps bigint")
    out = asof.match_grid(log, bounds, topics, dt, nearest=nearest)
    return {(r.topic, r.idx): (r.match, r.err) for r in out.collect()}


def test_backward_edges(spark):
    rows = [("a", 1, 105, 0.0), ("a", 2, 110, 0.0), ("a", 3, 110, 0.0), ("a", 4, 135, 0.0)]
    got = grid(spark, rows, ["a", "b"], 10, 100, 140)
    assert got[("a", 0)] == (None, None)  # before the first message
    assert got[("a", 1)] == (110, 0)  # exactly on a stamp
    assert got[("a", 2)] == (110, 10) and got[("a", 3)] == (110, 20)
    assert ("a", 4) not in got  # the end is excluded
    assert all(got[("b", i)] == (None, None) for i in range(4))  # topic that never occurs


def test_message_before_the_log_start_counts(spark):
    got = grid(spark, [("a", 1, 60, 0.0)], ["a"], 10, 100, 120)
    assert got == {("a", 0): (60, 40), ("a", 1): (60, 50)}


def test_nearest_tie_goes_to_the_first_logged(spark):
    early_first = [("a", 1, 105, 0.0), ("a", 2, 115, 0.0)]
    late_first = [("a", 2, 105, 0.0), ("a", 1, 115, 0.0)]
    assert grid(spark, early_first, ["a"], 10, 100, 120, True)[("a", 1)] == (105, 5)
    assert grid(spark, late_first, ["a"], 10, 100, 120, True)[("a", 1)] == (115, 5)


@pytest.mark.parametrize("nearest", [False, True])
def test_grid_matches_brute_force(spark, nearest, monkeypatch):
    monkeypatch.setattr(asof, "GRID_BLOCK", 8)
    r = random.Random(3)
    rows = [(r.choice("ab"), i, r.randrange(1000, 2000), 0.0) for i in range(60)]
    got = grid(spark, rows, ["a", "b"], 10, 1000, 2000, nearest)
    for (topic, idx), (match, err) in got.items():
        target = 1000 + idx * 10
        best = None
        for _, s, t, _ in sorted((x for x in rows if x[0] == topic), key=lambda x: x[1]):
            e = abs(target - t)
            if (nearest or t <= target) and (best is None or e < best[1]):
                best = (t, e)
        assert (match, err) == (best or (None, None))


def test_tolerance_is_strict_and_mask_needs_all(spark):
    rows = [("a", 1, 100, 0.0), ("b", 2, 100, 0.0), ("a", 3, 120, 0.0)]
    log = spark.createDataFrame(rows, LOG)
    bounds = asof.grid_bounds(log.unionByName(spark.createDataFrame([("a", 9, 141, 0.0)], LOG)), [], "t", 10)
    m = asof.match_grid(log, bounds, ["a", "b"], 10)
    assert {(r.topic, r.idx) for r in sync.within_tolerance(m, 10).collect()} == {("a", 0), ("b", 0), ("a", 2)}
    steps = {r.idx: r.valid for r in sync.valid_steps(m, 11).collect()}
    assert steps == {0: True, 1: True, 2: False, 3: False, 4: False}
    assert {(r.idx, r.frame) for r in sync.compact(sync.valid_steps(m, 11)).collect()} == {(0, 0), (1, 1)}
    report = {r.topic: (r.bad, r.kept, r.total) for r in sync.sync_report(m, 11).collect()}
    assert report == {"a": (1, 2, 5), "b": (3, 2, 5)}


def test_interval_is_strict_on_the_matched_stamp(spark):
    log = spark.createDataFrame([("a", i, 100 + 10 * i, 0.0) for i in range(5)], LOG)
    interval = spark.createDataFrame([(100.0, 130.0)], "t_min double, t_max double")
    done = synchronise(log, ["a"], 10, 5, interval=interval)
    assert {(r.target, r.frame) for r in done.frames.collect()} == {(110, 0), (120, 1)}


def test_grid_with_run_keys(spark):
    log = spark.createDataFrame([("r1", "a", 1, 0), ("r1", "a", 2, 25), ("r2", "a", 3, 7), ("r2", "a", 4, 30)], "run string, topic string, seq bigint, t bigint")
    done = synchronise(log, ["a"], 10, 100, keys=["run"])
    assert {(r.run, r.target) for r in done.frames.collect()} == {("r1", 0), ("r1", 10), ("r1", 20), ("r2", 7), ("r2", 17), ("r2", 27)}
    assert done.frame_matches(["run"]).count() == 6


def test_nearest_cutoff_is_inclusive(spark):
    left = spark.createDataFrame([(0,), (100,), (300,)], "t bigint")
    right = spark.createDataFrame([(1, 10), (2, 90), (3, 110), (4, 311)], "seq bigint, t bigint")
    got = {r.t: r.match.s for r in asof.match_nearest(left, right, [], cutoff=10).collect()}
    assert got == {0: 1, 100: 2}


def test_backward_series_match(spark):
    left = spark.createDataFrame([("k", 5), ("k", 10), ("k", 17)], "k string, t bigint")
    right = spark.createDataFrame([("k", 1, 10, 1.0), ("k", 2, 10, 2.0), ("k", 3, 15, 3.0)], "k string, seq bigint, t bigint, v double")
    got = {r.t: (r.match and r.match.v, r.err) for r in asof.match_backward(left, right, ["k"], payload=["v"]).collect()}
    assert got == {5: (None, None), 10: (1.0, 0), 17: (3.0, 2)}


def test_payload_of_equal_stamps_is_the_last_logged(spark):
    log = spark.createDataFrame([("a", 1, 100, 1.0), ("a", 2, 100, 2.0), ("a", 3, 200, 3.0)], LOG)
    m = asof.match_grid(log, asof.grid_bounds(log, [], "t", 50), ["a"], 50)
    got = {r.idx: r.value for r in sync.attach_payload(m, log, ["topic"], ["value"]).collect()}
    assert got == {0: 2.0, 1: 2.0}


def test_series_match_in_small_blocks(spark, small_blocks):
    r = random.Random(5)
    left, right = [r.randrange(500) for _ in range(60)], [(i, r.randrange(500)) for i in range(60)]
    m = asof.match_series(spark.createDataFrame([("k", t) for t in left], "k string, t bigint"),
                          spark.createDataFrame([("k", s, t) for s, t in right], "k string, seq bigint, t bigint"), ["k"])
    got = {x.t: (x.prev and (x.prev.t, x.prev.s), x.next and (x.next.t, x.next.s)) for x in m.collect()}
    assert set(got) == set(left)
    for t, (p, n) in got.items():
        before, after = [x for x in right if x[1] <= t], [x for x in right if x[1] >= t]
        assert p == (max(((b, -a) for a, b in before), default=None) and (lambda z: (z[0], -z[1]))(max((b, -a) for a, b in before)))
        assert n == (min((b, a) for a, b in after) if after else None)


def test_mutual_pairs_use_no_message_twice(spark, small_blocks):
    r = random.Random(11)
    rows = [("k", r.choice("xy"), i, r.randrange(300)) for i in range(80)]
    log = spark.createDataFrame(rows, "k string, topic string, seq bigint, t bigint")
    got = sync.approximate_sync(log, ["k"], ["x", "y"], 6).collect()
    assert got and len({g.seq for g in got}) == len(got) == len({g.seq_1 for g in got})

    def firsts(topic):
        out = {}
        for _, tp, s, t in rows:
            if tp == topic:
                out[t] = min(s, out.get(t, s))
        return out

    x, y = firsts("x"), firsts("y")

    def near(t, other):
        return min(other, key=lambda o: (abs(o - t), other[o]))

    want = {(x[t], y[near(t, y)]) for t in x if abs(near(t, y) - t) <= 6 and near(near(t, y), x) == t}
    assert {(g.seq, g.seq_1) for g in got} == want


def test_interpolation_clamps_within_tolerance(spark):
    series = spark.createDataFrame([("k", 1, 100, 1.0), ("k", 2, 200, 3.0)], "k string, seq bigint, t bigint, v double")
    at = spark.createDataFrame([("k", t) for t in (40, 90, 100, 150, 200, 210, 260)], "k string, t bigint")
    got = {r.t: r.v for r in interp.interpolate(at, series, ["k"], ["v"], 50).collect()}
    assert got == {40: None, 90: 1.0, 100: 1.0, 150: 2.0, 200: 3.0, 210: 3.0, 260: None}


def test_target_modes(spark):
    a, b, c = (spark.createDataFrame([("k", i)], "k string, t bigint") for i in (1, 2, 3))
    pick = {m: interp.target_stamps(m, a, b, c, ["k"]).first().t for m in (interp.UNCHANGED, interp.MATCH_TARGET, interp.MATCH_TOPIC)}
    assert pick == {"UNCHANGED": 1, "MATCH_TARGET": 2, "MATCH_TOPIC": 3}


def test_camera_topic(spark):
    topics = ["/cam/image_raw/compressed", "/cam/image/compressed", "/cam/compressed", "/cam"]
    df = spark.createDataFrame([(t,) for t in topics], "t string")
    assert {r[0] for r in df.select(sync.camera_info_topic(F.col("t"))).collect()} == {"/cam/camera_info"}


def test_interpolation_by_type(spark):
    rows = [(1, 0, 0.0, 0.0), (2, 10, 1.0, 2.0)]
    series = spark.createDataFrame(rows, "seq bigint, t bigint, vx double, wz double")
    at = spark.createDataFrame([(5,), (30,)], "t bigint")
    got = {r.t: (r.vx, r.wz) for r in interpolate_type(at, series, "Command", [], 2).collect()}
    assert got == {5: (0.5, 1.0), 30: (None, None)}
    for name in ("Image", "Transform"):
        with pytest.raises(ValueError):
            interpolate_type(at, series, name, [], 2)


def test_export_needs_messages_of_every_type(spark, tmp_path):
    with pytest.raises(ValueError):
        export({}, [{"name": "a", "topic": "a", "type": "Imu"}], 1, 1, str(tmp_path))


def test_frames_beyond_the_range_of_stamps_match_nothing(spark, tmp_path):
    """Keys of copies shifted by a million million: the stamp of such a frame would need more than 64 bits."""
    from sensorloom.plans.sync_queries import BASE, PERIOD, nearest_cutoff
    from sensorloom.plans.registry import Tables

    spark.createDataFrame([(0,), (2,), (10**12,), (-(10**12),), (None,)], "o_orderkey bigint").write.parquet(f"{tmp_path}/orders.parquet")
    events = spark.createDataFrame(
        [(7, BASE + 5, 1, "view", 0.0, "{}"), (8, BASE + 2 * PERIOD - 4, 1, "view", 0.0, "{}")],
        "event_id bigint, t bigint, user_id bigint, event_type string, value double, props string",
    )
    events.withColumn("ts", F.timestamp_micros("t").cast("timestamp_ntz")).drop("t").write.parquet(f"{tmp_path}/events.parquet")
    got = [tuple(r) for r in nearest_cutoff(Tables(spark, str(tmp_path))).select("idx", "t", "match_seq", "err").sort("idx").collect()]
    assert got == [(0, BASE, 7, 5), (1, BASE + 2 * PERIOD, 8, 4)]
