import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom import model
from sensorloom.functions import stamps
from sensorloom.operators import audit
from sensorloom.sources import readers, writers

N = 12


@pytest.mark.parametrize("name", model.REGISTRY)
def test_round_trip_of_every_type(spark, tmp_path, name):
    a = model.generate(spark, name, N)
    path = str(tmp_path / "source")
    a.write.parquet(path)
    a = spark.read.parquet(path)
    assert [f.name for f in a.schema.fields][5:] == model.REGISTRY[name].column_names
    assert a.select("idx").distinct().count() == N
    out = str(tmp_path / "dataset")
    writers.write_dataset(a.withColumn("group", F.lit("g")), out)
    b = readers.read_dataset(spark, out)
    assert model.same_records(a, b, name).isEmpty()
    assert readers.read_dataset(spark, out, idx=3).select("idx").distinct().count() == 1
    moved = b.withColumn("stamp", F.when(F.col("idx") == 2, F.col("stamp") + 1e-6).otherwise(F.col("stamp")))
    assert model.same_records(a, moved, name).select("idx").distinct().count() == 1
    if model.REGISTRY[name].child:
        assert model.same_records(a, b.withColumn("child_frame_id", F.lit(None).cast("string")), name).count() == N


@pytest.mark.parametrize("name", [n for n, s in model.REGISTRY.items() if s.nest])
def test_message_round_trip(spark, tmp_path, name):
    path = str(tmp_path / "m")
    model.generate(spark, name, N).write.parquet(path)
    a = spark.read.parquet(path)
    keep = ["run", "name", "idx", "stamp", "frame_id"]
    messages = model.nest(a.withColumn("m", F.concat("m", F.lit([0.0, 0.0, 0.0, 1.0]))) if "m" in a.columns else a, name, keep)
    back = model.flatten(messages, name, keep)
    assert model.same_records(a, back, name).isEmpty()


def test_types_without_message_form(spark):
    with pytest.raises(ValueError):
        model.flatten(spark.range(1), "VoxelGrid", [])


def test_rotated_grid_is_rejected(spark):
    payload = "named_struct('layers', array('a'), 'data', array(array(cast(1 as float))), 'nx', 1, 'ny', 1, 'resolution', 1D, 'length_x', 1D, 'length_y', 1D, 'position', named_struct('x', 0D, 'y', 0D, 'z', 0D), 'orientation', named_struct('x', 0D, 'y', 0D, 'z', 0.7D, 'w', 0.7D))"
    df = spark.range(1).select(F.expr(payload).alias("payload"))
    with pytest.raises(Exception, match="rotated"):
        model.flatten(df, "GridMap", []).collect()


def test_point_files(spark, tmp_path):
    tmp_path = tmp_path / "run-12345678-9" / "a00000001b"
    tmp_path.mkdir(parents=True)
    pts = np.random.default_rng(1).normal(size=(7, 4)).astype("<f4")
    pts.tofile(tmp_path / "00000003.bin")
    np.save(tmp_path / "00000004.npy", pts[:2, :3])
    (tmp_path / "notes.txt").write_text("x")
    got = readers.points(spark, str(tmp_path)).orderBy("pt").collect()
    assert [r.idx for r in got] == [3] * 7 and np.allclose([[r.x, r.y, r.z] for r in got], pts[:, :3])
    assert {(r.idx, r.pt) for r in readers.points(spark, str(tmp_path), "npy").collect()} == {(4, 0), (4, 1)}
    with pytest.raises(ValueError):
        readers.points(spark, str(tmp_path), "ply")


def test_matrix_over_several_blocks(spark, tmp_path):
    rows = np.random.default_rng(2).normal(size=(500, 3))
    for i in range(2):
        np.savetxt(tmp_path / f"part-{i}.txt", rows[250 * i : 250 * (i + 1)])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.matrix(spark, str(tmp_path), 3).orderBy("idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.idx for r in got] == list(range(500)) and np.allclose([r["values"] for r in got], rows)
    with pytest.raises(Exception, match="expected 2 numbers"):
        readers.matrix(spark, str(tmp_path), 2).collect()


def test_matrices_by_folder(spark, tmp_path):
    rows = np.arange(1200.0).reshape(600, 2)
    for name, part in (("a", rows[:400]), ("b", rows[400:])):
        (tmp_path / f"topic={name}").mkdir()
        np.savetxt(tmp_path / f"topic={name}" / "part-0.txt", part)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = readers.matrix(spark, str(tmp_path), 2, keys=("topic",)).orderBy("topic", "idx").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [(r.topic, r.idx) for r in got] == [("a", i) for i in range(400)] + [("b", i) for i in range(200)]
    assert np.allclose([r["values"] for r in got], rows)


def test_runs_at_any_depth(spark, tmp_path):
    for folder in ("z", "site/run=b", "site/old/run=a (1)"):
        (tmp_path / folder).mkdir(parents=True)
        (tmp_path / folder / "x.parquet").write_bytes(b"123")
    (tmp_path / "top.parquet").write_bytes(b"1")
    for root in (str(tmp_path), f"file://{tmp_path}/"):
        got = readers.runs(spark, root).collect()
        assert [r.output for r in got] == ["site/old/run=a (1)", "site/run=b", "z"]
        assert [(r.run, r.n_files, r.bytes) for r in got] == [("a (1)", 1, 3), ("b", 1, 3), ("z", 1, 3)]


def test_catalog(spark):
    rows = readers.catalog(spark, [{"name": "a", "topic": "/a", "type": "Imu"}], [{"group": "g", "name": "a", "topic": "/b", "type": "Path", "max_age": 1.0, "args": {"interpolation": "x", "n": 1}}])
    got = {(r.group, r.name): r for r in rows.collect()}
    assert set(got) == {("", "a"), ("g", "a")}
    assert rows.select(readers.interpolation_args(F.col("args")).alias("a")).collect()[1].a == {"n": "1"}
    with pytest.raises(ValueError):
        readers.catalog(spark, [{"name": "a", "topic": "/a", "type": "Imu"}] * 2)


def test_calibration_layouts(spark):
    texts = ['{"cam0":{"intrinsics":[1,2,3,4]}}', '{"K":[1,0,3,0,2,4,0,0,1]}', '{"intrinsics":{"K":[1,0,3,0,2,4,0,0,1]}}']
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {tuple(r[0]) for r in df.select(readers.calibration(F.col("t"))).collect()} == {(1.0, 2.0, 3.0, 4.0)}
    with pytest.raises(Exception, match="unknown calibration"):
        spark.createDataFrame([("{}",)], "t string").select(readers.calibration(F.col("t"))).collect()


def test_stereo_calibration(spark):
    text = '{"cam0":{"intrinsics":[1,2,3,4],"distortion_coeffs":[0.1,0.2]},"cam1":{"intrinsics":[5,6,7,8],"distortion_coeffs":[0.3],"T_cn_cnm1":[1,0,0,9,0,1,0,0,0,0,1,0,0,0,0,1]}}'
    row = spark.createDataFrame([(text,)], "t string").select(readers.stereo_calibration(F.col("t")).alias("c")).select("c.*").first()
    assert row.k_left == [1, 0, 3, 0, 2, 4, 0, 0, 1] and row.k_right == [5, 0, 7, 0, 6, 8, 0, 0, 1]
    assert (row.d_left, row.d_right, row.right_to_left[3]) == ([0.1, 0.2], [0.3], 9.0)


def test_lookup_modes(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    info = spark.createDataFrame([(1, "x")], "k int, v string")
    assert {r.k: r.v for r in audit.lookup(df, info, "k", "v", "NULL", ["k"]).collect()} == {1: "x", 2: "NULL"}
    with pytest.raises(Exception, match="missing key 2"):
        audit.lookup(df, info, "k", "v", None, ["k"], strict=True).collect()


def test_half_precision_bits(spark):
    edges = [2.0**k * (1 + d) for k in range(-26, 17) for d in (-(2.0**-23), 0, 2.0**-23, 2.0**-11, 3 * 2.0**-11)]
    v = np.array([0.0, 1.5, 65504.0, 65519.99, 65520.0, 1e9, np.inf, -np.inf, -3.3, 1e-4, 200.0, 3e-8, 2.9e-8, *edges], "float32")
    df = spark.createDataFrame([(i, float(x)) for i, x in enumerate(v)], "i int, x double")
    got = [r.b for r in df.select("i", writers.float16_bits(F.col("x").cast("float")).alias("b")).orderBy("i").collect()]
    assert got == v.astype(np.float16).view(np.uint16).tolist()


def test_dense_fill_and_difference(spark):
    df = spark.createDataFrame([("a", 0, 1.0, 1), ("a", 0, 2.0, 2), ("a", 3, 5.0, 3)], "k string, idx bigint, v double, seq int")
    assert [r.v for r in audit.last_write_dense(df, ["k"], "idx", "v", "seq", -1.0).orderBy("idx").collect()] == [2.0, -1.0, -1.0, 5.0]
    assert tuple(audit.difference(df, df.union(df.limit(1))).first()) == (0, 1, 3)


def test_tree_and_stamp_files(spark, tmp_path):
    edges = spark.createDataFrame([("/b", "/a", False)], "child string, parent string, is_static boolean")
    samples = spark.createDataFrame([("/b", 5, 1.0), ("/b", 6, 2.0)], "child string, t bigint, x double")
    writers.write_tree(edges, samples, str(tmp_path / "tf"))
    assert (tmp_path / "tf" / "samples" / "edge=-a_to_-b").is_dir()
    e, s = readers.read_tree(spark, str(tmp_path / "tf"))
    assert audit.difference(edges, e).first().only_first == 0 and audit.difference(samples, s).first().only_first == 0
    m = spark.createDataFrame([("a", 0, 1_500_000, 250_000), ("a", 1, None, None)], "topic string, frame bigint, match bigint, err bigint")
    writers.write_stamps(m, str(tmp_path / "stamps"))
    assert [r.value for r in spark.read.text(str(tmp_path / "stamps" / "topic=a")).collect()] == ["1.500000 0.250000", "-1 inf"]


def test_names_and_stamps(spark):
    row = spark.range(1).select(
        stamps.frame_name(F.lit(7)).alias("a"), stamps.frame_name(F.lit(123456789)).alias("b"), stamps.stamp_from_name(F.lit("12-5.png")).alias("c"),
        *[c.alias(n) for c, n in zip(stamps.split_nanos(F.lit(-1).cast("bigint")), "de")],
    ).first()
    assert tuple(row) == ("00000007", "123456789", 12.5, -1, 999_999_999)


def test_metric_lines(spark):
    df = spark.createDataFrame([("voxel_mapper: 1.25 ms 9.9\nother 3.5\nvoxel_mapper none\nvoxel_mapper 2.0",)], "t string")
    assert sorted(r.metric for r in audit.metric_lines(df, "t", "voxel_mapper").collect()) == [1.25, 2.0]
