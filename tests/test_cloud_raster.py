import numpy as np
import pytest
from pyspark.sql import functions as F

from sensorloom.functions.geometry import IDENTITY
from sensorloom.operators import cloud, raster
from sensorloom.plans.export import depth_frames

CAMERA = (10.0, 10.0, 0.0, 0.0)


def seen(spark, pts, width=10, height=10, max_depth=5.0):
    df = spark.createDataFrame([tuple(map(float, p)) for p in pts], "x double, y double, z double")
    return sorted((r.u, r.v, r.z) for r in cloud.in_view(df, width, height, *CAMERA, max_depth).collect())


def test_projection_edges(spark):
    assert seen(spark, [(0, 0, 0), (0, 0, -1), (0, 0, 5)]) == []  # at the camera, behind, exactly max depth
    assert seen(spark, [(0, 0, 6)], max_depth=None) == [(0, 0, 6.0)]
    assert seen(spark, [(0.05, 0.25, 1)]) == [(0, 2, 1.0)]  # 0.5 and 2.5 round to even
    assert seen(spark, [(0.95, 0, 1)]) == []  # 9.5 rounds to the image width
    assert seen(spark, [(0.94, 0, 1)]) == [(9, 0, 1.0)]
    assert seen(spark, [(-0.001, 0, 1)]) == []


def test_nearest_point_and_empty_frames(spark):
    pts = [(0, 0.1, 0.1, 2.0), (0, 0.1, 0.1, 1.0), (0, 0.2, 0.2, 2.0), (1, 0.0, 0.0, -3.0)]
    df = spark.createDataFrame(pts, "f int, x double, y double, z double")
    d = cloud.depth_map(cloud.in_view(df, 10, 10, *CAMERA, 5.0), ["f"]).collect()
    assert {(r.f, r.u, r.v): r.depth for r in d} == {(0, 0, 0): 2.0, (0, 1, 1): 1.0}


def test_stack_clips_at_the_ends_and_skips_missing(spark):
    pts = spark.createDataFrame([(f, i) for f in (0, 1, 3, 9) for i in range(2)], "f int, pt int")
    got = cloud.stack_frames(pts, "f", 2, pts.select("f").distinct(), ["pt"]).groupBy("stack").agg(F.sort_array(F.collect_set("f")).alias("s"))
    assert {r.stack: r.s for r in got.collect()} == {0: [0, 1], 1: [0, 1, 3], 3: [1, 3], 9: [9]}


def test_depth_plan_with_mask_and_missing_transform(spark):
    pts = spark.createDataFrame([(0, 1, 0.1, 0.1, 1.0), (1, 2, 0.3, 0.3, 1.0), (2, 3, 0.1, 0.1, 1.0)], "f int, pt int, x double, y double, z double")
    tf = spark.createDataFrame([(0, IDENTITY), (1, IDENTITY)], "f int, matrix array<double>")
    mask = spark.createDataFrame([(1, 1, 1)], "u int, v int, mask int")
    got = depth_frames(pts, "f", 0, tf, CAMERA, 10, 10, 5.0, ["pt"], mask)
    # The only point of frame 0 is masked; the frame was not empty before masking, so it stays.
    assert {(r.f, r.u, r.v): r.depth for r in got.collect()} == {(0, 1, 1): 0.0, (1, 3, 3): 1.0}


def test_merge_takes_smallest_positive(spark):
    df = spark.createDataFrame([("p", 0.0), ("p", 3.0), ("p", 2.0), ("q", 0.0), ("q", -1.0)], "px string, d double")
    assert {r.px: r.depth for r in cloud.merge_depth(df, ["px"], "d").collect()} == {"p": 2.0, "q": 0.0}


@pytest.mark.parametrize("n", [1, 2, 50, 51, 99, 100, 150, 250])
def test_rank_bounds(spark, small_blocks, n):
    values = np.random.default_rng(n).permutation(n).astype(float)
    df = spark.createDataFrame([("f", float(v)) for v in values], "f string, x double")
    r = raster.rank_bounds(df, ["f"], "x").first()
    srt = np.sort(values)
    assert (r.lower, r.upper) == (srt[round(n * 0.01)], srt[round(n * 0.99) - 1])


@pytest.mark.parametrize("mode,top", [(raster.MINMAX, 50000), (raster.ADAPTIVE, 50000), (raster.ADAPTIVE, 100), (raster.RANKED, 100), (raster.PLAIN, 100)])
def test_normalise_matches_numpy(spark, small_blocks, mode, top):
    img = np.random.default_rng(1).integers(0, top, 300).astype(float)
    df = spark.createDataFrame([("f", i, float(v)) for i, v in enumerate(img)], "f string, i int, x double")
    got = [r.level for r in raster.normalise(df, ["f"], "x", ["i"], mode).orderBy("i").collect()]
    plain = (img - img.min()) / (img.max() - img.min()) * 255
    srt = np.sort(img)
    lo, hi = srt[round(3.0)], srt[round(300 * 0.99) - 1]
    ranked = (np.clip(img, lo, hi) - lo) / (hi - lo) * 255
    want = {raster.MINMAX: plain, raster.RANKED: ranked, raster.ADAPTIVE: plain if img.max() < 35000 else ranked}.get(mode, img / 255)
    assert got == want.astype(np.uint8).tolist()
    with pytest.raises(ValueError):
        raster.normalise(df, ["f"], "x", ["i"], "other")


def test_constant_image_has_no_level(spark):
    df = spark.createDataFrame([("f", i, 7.0) for i in range(5)], "f string, i int, x double")
    for mode in (raster.MINMAX, raster.RANKED):
        assert {r.level for r in raster.normalise(df, ["f"], "x", ["i"], mode).collect()} == {None}


@pytest.mark.parametrize("p", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_percentile_matches_numpy(spark, small_blocks, p):
    x = np.random.default_rng(9).normal(size=83).round(1)
    df = spark.createDataFrame([("f", float(v)) for v in x], "f string, x double")
    assert np.isclose(raster.percentile(df, ["f"], "x", p, "o").first().o, np.percentile(x, p * 100))


def undistort(img, k, d, p, model, r):
    h, w = img.shape
    out = np.zeros_like(img)
    R = np.array(r).reshape(3, 3) if r else np.eye(3)
    for v in range(h):
        for u in range(w):
            ray = R.T @ [(u - p[2]) / p[0], (v - p[3]) / p[1], 1.0]
            x, y = ray[0] / ray[2], ray[1] / ray[2]
            r2 = x * x + y * y
            if model == "equidistant":
                q = np.sqrt(r2)
                th = np.arctan(q)
                s = th * (1 + d[0] * th**2 + d[1] * th**4 + d[2] * th**6 + d[3] * th**8) / q if q > 0 else 1.0
                xd, yd = x * s, y * s
            else:
                rad = 1 + d[0] * r2 + d[1] * r2**2 + d[4] * r2**3
                xd = x * rad + 2 * d[2] * x * y + d[3] * (r2 + 2 * x * x)
                yd = y * rad + d[2] * (r2 + 2 * y * y) + 2 * d[3] * x * y
            su, sv = xd * k[0] + k[2], yd * k[1] + k[3]
            for a in (0, 1):
                for b in (0, 1):
                    iu, iv = int(np.floor(su)) + a, int(np.floor(sv)) + b
                    if 0 <= iu < w and 0 <= iv < h:
                        out[v, u] += img[iv, iu] * (1 - abs(su - iu)) * (1 - abs(sv - iv))
    return out


@pytest.mark.parametrize("model,d", [("plumb_bob", [-0.2, 0.05, 0.01, -0.01, 0.02]), ("equidistant", [0.1, -0.05, 0.01, 0.002])])
@pytest.mark.parametrize("r", [None, [0.9998, -0.02, 0.0, 0.02, 0.9998, 0.0, 0.0, 0.0, 1.0]])
def test_rectification_matches_numpy(spark, model, d, r):
    img = np.random.default_rng(3).integers(0, 255, (12, 16)).astype(float)
    df = spark.createDataFrame([("f", u, v, float(img[v, u])) for v in range(12) for u in range(16)], "f string, u int, v int, g double")
    k, p = (14.0, 14.0, 8.0, 6.0), (13.0, 13.0, 8.0, 6.0)
    got = np.zeros_like(img)
    for row in raster.rectify(df, ["f"], "g", k, d, p, model, r).collect():
        got[row.v, row.u] = row.g
    assert np.allclose(got, undistort(img, k, d, p, model, r))


def test_no_distortion_returns_the_image(spark):
    df = spark.createDataFrame([("f", 0, 0, 1.0)], "f string, u int, v int, g double")
    assert raster.rectify(df, ["f"], "g", CAMERA, [0.0] * 5, CAMERA, "plumb_bob") is df


def test_grid_layout_round_trip(spark):
    df = spark.range(12).select(F.col("id").cast("int").alias("p"))
    x, y = raster.grid_cell(F.col("p"), 3, 4)
    flipped = np.arange(12).reshape(3, 4)[::-1, ::-1].T  # rows are y, columns are x
    for r in df.withColumns({"x": x, "y": y}).withColumn("back", raster.grid_position(F.col("x"), F.col("y"), 3, 4)).collect():
        assert flipped[r.y, r.x] == r.p == r.back


def test_voxels(spark):
    df = spark.createDataFrame([(0.1, 0.1, 0.1, 5), (0.4, 0.2, 0.3, 3), (-0.1, 0.0, 0.0, 9)], "x double, y double, z double, t bigint")
    got = {(r.ix, r.iy, r.iz): (r.hits, r.min_x, r.max_x, r.first_update, r.last_update) for r in cloud.voxels(df, [], (0.0, 0.0, 0.0), 0.5).collect()}
    assert got == {(0, 0, 0): (2, 0.1, 0.4, 3, 5), (-1, 0, 0): (1, -0.1, -0.1, 9, 9)}
