"""The frame store: pruned reads, upserts, commits that die, resumed runs."""

import pytest

from sensorloom.sources.frames import FrameStore

SCHEMA = "run string, idx bigint, value double"


@pytest.fixture
def store(spark, tmp_path):
    return FrameStore(spark, str(tmp_path / "frames"), ["run"], block=10)


def frames(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return {(r.run, r.idx): r.value for r in df.collect()}


def test_upserts_and_commits(spark, store, monkeypatch):
    first = [(k, i, float(i)) for k in ("a", "b", None) for i in range(35)]
    assert store.upsert(frames(spark, first)) == 1
    want = {(k, i): v for k, i, v in first}
    change = [("a", 3, -3.0), (None, 34, -34.0), ("c", 100, 1.0)]
    monkeypatch.setattr(FrameStore, "_commit", lambda self, live, number: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # killed after its data, before its commit
        store.upsert(frames(spark, change))
    monkeypatch.undo()
    assert content(store.read()) == want and store.version() == 1
    before = set(r.file for r in store._live().collect())
    assert store.upsert(frames(spark, change)) == 2
    want |= {(k, i): v for k, i, v in change}
    rows = store.read()
    assert content(rows) == want and rows.count() == len(want)
    assert len(content(store.read(version=1))) == 105
    # Blocks that weren't touched still lie in their old files.
    live = store._live().collect()
    assert len(live) == 13 and sum(r.file not in before for r in live) == 3
    assert store.resume(frames(spark, [("a", 3, 0.0), ("a", 77, 7.0)])) == 3
    assert content(store.read()) == want | {("a", 77): 7.0}


def test_two_writers(spark, store):
    store.upsert(frames(spark, [("a", 1, 1.0)]))
    live = store._live()
    store.upsert(frames(spark, [("a", 2, 2.0)]))
    with pytest.raises(RuntimeError, match="another writer"):
        store._commit(live, 2)
    assert content(store.read()) == {("a", 1): 1.0, ("a", 2): 2.0}


def test_reads_open_only_files_with_asked_frames(spark, store):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        store.upsert(frames(spark, [("ab"[i % 2], i, float(i)) for i in range(400)]))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    everything = {r.file for r in store._live().collect()}
    asked = spark.createDataFrame([(11,), (12,), (5000,)], "idx bigint")
    assert content(store.read_frames(asked)) == {("b", 11): 11.0, ("a", 12): 12.0}
    assert 1 <= len(store.files_of(asked)) <= 2 < len(everything)
    names = lambda files: {f.rsplit("/", 1)[1] for f in files if "/data/" in f}
    assert names(store.read_frames(asked).inputFiles()) == names(store.files_of(asked))
    one = spark.createDataFrame([("a", 12), ("b", 12)], "run string, idx bigint")
    assert content(store.read_frames(one)) == {("a", 12): 12.0}
    assert store.read_frames(spark.createDataFrame([(9999,)], "idx bigint")).collect() == []
