"""Queries on point clouds, poses and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from sensorloom.functions import geometry as g
from sensorloom.operators import audit, cloud
from sensorloom.operators.interp import interpolate
from sensorloom.plans.export import depth_frames
from sensorloom.plans.registry import components, query, vectors_sql
from sensorloom.sources.writers import float16_bits

# Fixed values of the registered queries: camera, image size and depth limit.
CAMERA = (50.0, 50.0, 32.0, 24.0)
WIDTH, HEIGHT, MAX_DEPTH = 64, 48, 3.0

VIEW = f"""{vectors_sql(8)},
p AS (SELECT vec_id, label, e0 AS x, e1 AS y, e2 * 10 AS z FROM v)"""
SEEN = f"""{VIEW},
f AS (SELECT *, x * 50 / z + 32 AS uu, y * 50 / z + 24 AS vv FROM p WHERE z > 0 AND z < {MAX_DEPTH}),
s AS (SELECT *, CAST(round_even(uu, 0) AS INTEGER) AS u, CAST(round_even(vv, 0) AS INTEGER) AS v FROM f
      WHERE uu >= 0 AND uu < {WIDTH} AND vv >= 0 AND vv < {HEIGHT}),
seen AS (SELECT * FROM s WHERE u < {WIDTH} AND v < {HEIGHT})"""


def cloud_points(embeddings):
    """embeddings, or a stream of them, as points."""
    return components(embeddings, 8).select(
        "vec_id", "label", F.col("e0").alias("x"), F.col("e1").alias("y"), (F.col("e2") * 10).alias("z")
    )


def _points(t):
    return cloud_points(t.embeddings)


def _seen(t):
    return cloud.in_view(_points(t), WIDTH, HEIGHT, *CAMERA, MAX_DEPTH)


@query(f"WITH {SEEN} SELECT label, u, v, min(z) AS depth FROM seen GROUP BY label, u, v")
def project_depth(t):
    """Nearest depth per frame and pixel."""
    return cloud.depth_map(_seen(t), ["label"])


@query(
    f"""WITH {VIEW},
st AS (SELECT vec_id, unnest(range(label - 2, label + 3)) AS stack, x, y, z FROM p),
c AS (SELECT stack, count(*) AS n, round(sum(x), 6) + 0.0 AS sum_x FROM st WHERE stack IN (SELECT label FROM p) GROUP BY stack)
SELECT CAST(stack AS INTEGER) AS stack, n, sum_x FROM c"""
)
def frame_stack(t):
    """Union of each frame's cloud with those of two frames on either side."""
    pts = _points(t)
    return cloud.stack_frames(pts, "label", 2, pts.select("label").distinct(), ["vec_id"]).groupBy("stack").agg(
        F.count(F.lit(1)).alias("n"), (F.round(F.sum("x"), 6) + 0.0).alias("sum_x")
    )


@query(
    f"""WITH {VIEW},
st AS (SELECT CAST(unnest(range(label - 1, label + 2)) AS INTEGER) AS frame, x, y, z FROM p),
c AS (SELECT frame, cos(frame * 0.1) * x - sin(frame * 0.1) * y AS x, sin(frame * 0.1) * x + cos(frame * 0.1) * y AS y, z FROM st WHERE frame IN (SELECT label FROM p)),
f AS (SELECT *, x * 50 / z + 32 AS uu, y * 50 / z + 24 AS vv FROM c WHERE z > 0 AND z < {MAX_DEPTH}),
s AS (SELECT *, CAST(round_even(uu, 0) AS INTEGER) AS u, CAST(round_even(vv, 0) AS INTEGER) AS v FROM f
      WHERE uu >= 0 AND uu < {WIDTH} AND vv >= 0 AND vv < {HEIGHT})
SELECT frame AS label, u, v, CASE WHEN u < 20 THEN 0.0::DOUBLE ELSE round(min(z), 6) END AS depth FROM s WHERE u < {WIDTH} AND v < {HEIGHT} GROUP BY frame, u, v"""
)
def depth_extract(t):
    """Depth maps of stacked clouds, each frame with its own camera pose and an image mask."""
    pts = _points(t)
    zero = F.lit(0.0)
    q = g.euler_quaternion(zero, zero, F.col("label") * 0.1)
    poses = pts.select("label").distinct().withColumn("matrix", g.pose_matrix(zero, zero, zero, *q))
    mask = (
        t.vectors(1).select(F.explode(F.sequence(F.lit(0), F.lit(19))).alias("u")).distinct()
        .withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(HEIGHT - 1)))).withColumn("mask", F.lit(1))
    )
    out = depth_frames(pts, "label", 1, poses, CAMERA, WIDTH, HEIGHT, MAX_DEPTH, ["vec_id"], mask)
    return out.withColumn("depth", F.round("depth", 6))


@query(
    f"""WITH {SEEN}, d AS (SELECT label, u, v, min(z) AS depth FROM seen GROUP BY label, u, v),
m AS (SELECT u, v, max(CASE WHEN e5 > 0 THEN 1 ELSE 0 END) AS mask FROM (SELECT CAST(abs(vec_id) % {WIDTH} AS INTEGER) AS u, CAST(vec_id // {WIDTH} % {HEIGHT} AS INTEGER) AS v, e5 FROM v) GROUP BY u, v)
SELECT label, u, v, CASE WHEN mask = 1 THEN 0.0::DOUBLE ELSE depth END AS depth FROM d LEFT JOIN m USING (u, v)"""
)
def mask_region(t):
    """Depth set to zero under a mask image."""
    cell = t.vectors(6).select(
        (F.col("vec_id") % WIDTH).cast("int").alias("u"),
        (F.floor(F.col("vec_id") / WIDTH) % HEIGHT).cast("int").alias("v"),
        F.when(F.col("e5") > 0, 1).otherwise(0).alias("m"),
    )
    mask = cell.groupBy("u", "v").agg(F.max("m").alias("mask"))
    return cloud.mask_region(cloud.depth_map(_seen(t), ["label"]), mask, ["u", "v"], ["label"])


@query(
    f"""WITH {SEEN}, d AS (SELECT label, u, v, CAST(CAST(min(z) AS FLOAT) AS DOUBLE) AS x FROM seen GROUP BY label, u, v),
e AS (SELECT *, greatest(-14, floor(log2(x))) AS e FROM d)
SELECT label, u, v, CAST(CASE WHEN x >= 65520 THEN 31744 ELSE (e + 14) * 1024 + round_even(x / pow(2.0::DOUBLE, e - 10), 0) END AS INTEGER) AS bits FROM e"""
)
def depth_f16(t):
    """Depth maps as half-precision bits."""
    depth = cloud.depth_map(_seen(t), ["label"])
    return depth.select("label", "u", "v", float16_bits(F.col("depth").cast("float")).alias("bits"))


@query(
    """SELECT l_suppkey, l_linenumber, coalesce(min(CASE WHEN l_quantity > 25 THEN l_quantity - 25 END), 0.0) AS depth
FROM lineitem GROUP BY l_suppkey, l_linenumber"""
)
def merge_depth(t):
    """Smallest positive depth per pixel over all scans."""
    maps = t.lineitem.select("l_suppkey", "l_linenumber", (F.col("l_quantity") - 25).alias("d"))
    return cloud.merge_depth(maps, ["l_suppkey", "l_linenumber"], "d")


@query(f"WITH {VIEW} SELECT vec_id, label, x, y, z FROM p WHERE x > 0 AND z < 1")
def mask_points(t):
    """Points a mask keeps."""
    return _points(t).filter((F.col("x") > 0) & (F.col("z") < 1))


FEATURED = """f AS (SELECT doc_id, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id))"""


def _featured(t):
    """Documents as points; those with labels have a feature vector."""
    labels = t.labels.select("doc_id", F.array(F.col("quality").cast("double"), F.col("toxic").cast("double")).alias("features"))
    return t.documents.select("doc_id", "n_chars").join(labels, "doc_id", "left")


@query(f"WITH {FEATURED} SELECT doc_id, n_chars, CAST(quality AS DOUBLE) AS f0 FROM f WHERE n_chars > 500")
def mask_features(t):
    """A mask applied to points and their features alike."""
    kept = _featured(t).filter(F.col("n_chars") > 500)
    return kept.select("doc_id", "n_chars", F.get("features", F.lit(0)).alias("f0"))


@query(
    f"""WITH {FEATURED} SELECT quality IS NOT NULL AS has_features, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS size FROM f GROUP BY 1"""
)
def split_features(t):
    """Points with and without features, summarised."""
    featured, bare = cloud.split_by_features(_featured(t))
    both = featured.withColumn("has_features", F.lit(True)).unionByName(bare.withColumn("has_features", F.lit(False)))
    return both.groupBy("has_features").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("size"))


@query(f"WITH {VIEW} SELECT label, count(*) AS n FROM p GROUP BY label")
def points_per_frame(t):
    """Points per message."""
    return _points(t).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query(
    f"""WITH {VIEW} SELECT label, min(x) AS min_x, max(x) AS max_x, round(avg(x), 6) + 0.0 AS mean_x, max(x) - min(x) AS range_x,
max(y) - min(y) AS range_y, max(z) - min(z) AS range_z FROM p GROUP BY label"""
)
def pose_range(t):
    """Extent of every track."""
    return _points(t).groupBy("label").agg(
        F.min("x").alias("min_x"),
        F.max("x").alias("max_x"),
        (F.round(F.avg("x"), 6) + 0.0).alias("mean_x"),
        *[(F.max(c) - F.min(c)).alias(f"range_{c}") for c in "xyz"],
    )


@query(f"WITH {VIEW} SELECT 'a' AS source, vec_id, x FROM p WHERE NOT isnan(x) UNION ALL SELECT 'b', vec_id, y FROM p")
def union_points(t):
    """Two clouds one after the other, NaN points skipped."""
    pts = _points(t)
    a = pts.filter(cloud.finite("x")).select(F.lit("a").alias("source"), "vec_id", "x")
    return a.unionByName(pts.select(F.lit("b").alias("source"), "vec_id", F.col("y").alias("x")))


VOXEL = f"""{VIEW},
c AS (SELECT *, CAST(floor((x + 1) / 0.2) AS BIGINT) AS ix, CAST(floor((y + 1) / 0.2) AS BIGINT) AS iy, CAST(floor((z + 1) / 0.2) AS BIGINT) AS iz FROM p)"""
ORIGIN = (-1.0, -1.0, -1.0)


@query(
    f"""WITH {VOXEL} SELECT ix, iy, iz, (ix * 100 + iy) * 100 + iz AS raster, count(*) AS hits, min(x) AS min_x, max(x) AS max_x, min(z) AS min_z, max(z) AS max_z,
min(vec_id) AS first_update, max(vec_id) AS last_update FROM c GROUP BY ix, iy, iz"""
)
def voxel_agg(t):
    """Hits, bounds and update times per voxel."""
    out = cloud.voxels(_points(t), [], ORIGIN, 0.2, "vec_id")
    raster = cloud.raster_index(F.col("ix"), F.col("iy"), F.col("iz"), 100, 100)
    return out.withColumn("raster", raster).select(
        "ix", "iy", "iz", "raster", "hits", "min_x", "max_x", "min_z", "max_z", "first_update", "last_update"
    )


@query(
    f"""WITH {vectors_sql(64)}, c AS (SELECT embedding, CAST(floor((CAST(embedding[1] AS DOUBLE) + 1) / 0.2) AS BIGINT) AS ix,
CAST(floor((CAST(embedding[2] AS DOUBLE) + 1) / 0.2) AS BIGINT) AS iy, CAST(floor((CAST(embedding[3] AS DOUBLE) + 1) / 0.2) AS BIGINT) AS iz FROM embeddings),
l AS (SELECT ix, iy, iz, unnest(embedding) AS value, unnest(range(0, 64)) AS channel FROM c)
SELECT ix, iy, iz, CAST(channel AS INTEGER) AS channel, round(avg(CAST(value AS DOUBLE)), 6) + 0.0 AS value FROM l GROUP BY ix, iy, iz, channel"""
)
def voxel_features(t):
    """Mean feature vector per voxel, in long form."""
    pts = t.embeddings.select("embedding", *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate("xyz")])
    out = cloud.voxel_features(pts, [], ORIGIN, 0.2, "embedding")
    return out.withColumn("value", F.round("value", 6) + 0.0)


@query(
    f"""WITH {VOXEL}, k AS (SELECT ix, iy, iz, avg(CASE WHEN label < 5 THEN e.v END) AS f FROM c JOIN (SELECT vec_id, abs(CAST(embedding[4] AS DOUBLE)) AS v FROM embeddings) e USING (vec_id) GROUP BY ix, iy, iz)
SELECT ix, iy, iz, round(coalesce(f, 0.8), 6) AS colour FROM k"""
)
def voxel_color(t):
    """Mean colour per voxel; grey where no point has features."""
    v = t.vectors(4).select("label", F.col("e0").alias("x"), F.col("e1").alias("y"), (F.col("e2") * 10).alias("z"), F.abs("e3").alias("f"))
    cells = v.withColumns({f"i{c}": cloud.voxel_index(F.col(c), -1.0, 0.2) for c in "xyz"})
    mean = cells.groupBy("ix", "iy", "iz").agg(F.avg(F.when(F.col("label") < 5, F.col("f"))).alias("f"))
    return mean.select("ix", "iy", "iz", F.round(cloud.voxel_colour(F.col("f")), 6).alias("colour"))


@query(f"WITH {vectors_sql(6)} SELECT vec_id, e0 AS x, CASE WHEN label % 2 = 0 THEN e3 END AS r, label % 2 = 0 AS coloured FROM v")
def optional_cols(t):
    """Colours attached only where their count matches that of the points."""
    v = t.vectors(6).withColumns({
        "pts": F.array("e0", "e1", "e2"),
        "colours": F.when(F.col("label") % 2 == 0, F.array("e3", "e4", "e5")).otherwise(F.array("e3")),
    })
    fits = F.size("colours") == F.size("pts")
    return v.select(
        "vec_id", F.get("pts", F.lit(0)).alias("x"), F.when(fits, F.get("colours", F.lit(0))).alias("r"), fits.alias("coloured")
    )


QUAT = "sqrt(e3 * e3 + e4 * e4 + e5 * e5 + e6 * e6)"
ROT = f"""{vectors_sql(16)},
q AS (SELECT *, e3 / {QUAT} AS a, e4 / {QUAT} AS b, e5 / {QUAT} AS c, e6 / {QUAT} AS d FROM v),
m AS (SELECT *, 1 - 2 * (b * b + c * c) AS m00, 2 * (a * b - c * d) AS m01, 2 * (a * c + b * d) AS m02,
  2 * (a * b + c * d) AS m10, 1 - 2 * (a * a + c * c) AS m11, 2 * (b * c - a * d) AS m12,
  2 * (a * c - b * d) AS m20, 2 * (b * c + a * d) AS m21, 1 - 2 * (a * a + b * b) AS m22 FROM q)"""


def _matrix(prefix="e"):
    return g.pose_matrix(*[F.col(f"{prefix}{i}") for i in range(7)])


def _cells(m, cells):
    return [(F.round(F.get(m, F.lit(i)), 6) + 0.0).alias(n) for n, i in cells.items()]


MATRIX_CELLS = {"m00": 0, "m01": 1, "m02": 2, "m10": 4, "m11": 5, "m12": 6, "m20": 8, "m21": 9, "m22": 10, "x": 3, "y": 7, "z": 11}


@query(
    f"""WITH {ROT} SELECT vec_id, {", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in MATRIX_CELLS if c.startswith("m"))},
round(e0, 6) + 0.0 AS x, round(e1, 6) + 0.0 AS y, round(e2, 6) + 0.0 AS z FROM m"""
)
def pose_to_matrix(t):
    """Matrix of every pose."""
    return t.vectors(7).withColumn("m", _matrix()).select("vec_id", *_cells("m", MATRIX_CELLS))


SIGN = "CASE WHEN d < 0 THEN -1 ELSE 1 END"


@query(
    f"""WITH {ROT} SELECT vec_id, round(e0, 6) + 0.0 AS x, {", ".join(f"round({c} * {SIGN}, 6) + 0.0 AS q{n}" for c, n in zip("abcd", "xyzw"))} FROM q"""
)
def matrix_to_pose(t):
    """Pose to matrix and back; the quaternion is canonical."""
    m = t.vectors(7).withColumn("m", g.affine_to_matrix(g.matrix_to_affine(_matrix())))
    quat = g.matrix_quaternion(F.col("m"))
    return m.select(
        "vec_id",
        (F.round(g.matrix_position(F.col("m"))[0], 6) + 0.0).alias("x"),
        *[(F.round(q, 6) + 0.0).alias(f"q{n}") for q, n in zip(quat, "xyzw")],
    )


@query(
    f"""WITH {ROT} SELECT vec_id, round(m00 * e7 + m01 * e8 + m02 * e9 + e0, 6) + 0.0 AS x, round(m10 * e7 + m11 * e8 + m12 * e9 + e1, 6) + 0.0 AS y,
round(m20 * e7 + m21 * e8 + m22 * e9 + e2, 6) + 0.0 AS z FROM m"""
)
def transform_points(t):
    """Points moved by a pose."""
    v = t.vectors(10).withColumn("m", _matrix())
    moved = g.transform_point(F.col("m"), F.col("e7"), F.col("e8"), F.col("e9"))
    return v.select("vec_id", *[(F.round(p, 6) + 0.0).alias(c) for p, c in zip(moved, "xyz")])


@query(
    f"""WITH {ROT},
n AS (SELECT *, lead(vec_id) OVER w AS nid, {", ".join(f"lead({c}) OVER w AS {c}_" for c in ("e0", "a", "b", "c", "d"))} FROM q WINDOW w AS (PARTITION BY label ORDER BY vec_id)),
h AS (SELECT *, CASE WHEN nid IS NULL THEN 0 ELSE CAST(vec_id * 1000 + 500 - vec_id * 1000 AS DOUBLE) / (nid * 1000 - vec_id * 1000) END AS w,
  a * a_ + b * b_ + c * c_ + d * d_ AS dot FROM n WHERE nid IS NOT NULL),
s AS (SELECT *, least(1.0, abs(dot)) AS cs, CASE WHEN dot < 0 THEN -1.0 ELSE 1.0 END AS sg FROM h),
u AS (SELECT *, CASE WHEN cs > 0.9995 THEN 1 - w ELSE sin((1 - w) * acos(cs)) / sin(acos(cs)) END AS wa,
  (CASE WHEN cs > 0.9995 THEN w ELSE sin(w * acos(cs)) / sin(acos(cs)) END) * sg AS wb FROM s),
r AS (SELECT *, wa * a + wb * a_ AS ra, wa * b + wb * b_ AS rb, wa * c + wb * c_ AS rc, wa * d + wb * d_ AS rd FROM u),
z AS (SELECT *, sqrt(ra * ra + rb * rb + rc * rc + rd * rd) * CASE WHEN rd < 0 THEN -1 ELSE 1 END AS len FROM r)
SELECT label, vec_id * 1000 + 500 AS t, round(e0 + (e0_ - e0) * w, 6) + 0.0 AS x, round(ra / len, 6) + 0.0 AS qx, round(rb / len, 6) + 0.0 AS qy,
  round(rc / len, 6) + 0.0 AS qz, round(rd / len, 6) + 0.0 AS qw FROM z"""
)
def interp_pose(t):
    """Poses between successive samples: linear position, shortest-arc rotation."""
    v = t.vectors(7)
    unit = g.normalized(*[F.col(f"e{i}") for i in range(3, 7)])
    series = v.select(
        "label", (F.col("vec_id") * 1000).alias("t"), F.col("vec_id").alias("seq"), F.col("e0").alias("x"),
        *[u.alias(c) for u, c in zip(unit, ("qx", "qy", "qz", "qw"))],
    )
    targets = v.select("label", (F.col("vec_id") * 1000 + 500).alias("t"))
    out = interpolate(targets, series, ["label"], ["x"], 0, ["qx", "qy", "qz", "qw"]).filter(F.col("x").isNotNull())
    return out.select("label", "t", *[(F.round(c, 6) + 0.0).alias(c) for c in ("x", "qx", "qy", "qz", "qw")])


@query(
    f"""WITH {ROT} SELECT vec_id, round(sqrt(e0 * e0 + e1 * e1 + e2 * e2), 6) AS speed, round(a, 6) + 0.0 AS qx, round(d, 6) + 0.0 AS qw FROM q"""
)
def vector_norm(t):
    """Norm of a vector and a normalised quaternion."""
    v = t.vectors(7)
    unit = g.normalized(*[F.col(f"e{i}") for i in range(3, 7)])
    speed = g.norm(F.col("e0"), F.col("e1"), F.col("e2"))
    return v.select(
        "vec_id", F.round(speed, 6).alias("speed"), (F.round(unit[0], 6) + 0.0).alias("qx"), (F.round(unit[3], 6) + 0.0).alias("qw")
    )


@query(
    f"""WITH {vectors_sql(3)} SELECT vec_id,
round(sin(e0 / 2) * cos(e1 / 2) * cos(e2 / 2) - cos(e0 / 2) * sin(e1 / 2) * sin(e2 / 2), 6) + 0.0 AS qx,
round(cos(e0 / 2) * sin(e1 / 2) * cos(e2 / 2) + sin(e0 / 2) * cos(e1 / 2) * sin(e2 / 2), 6) + 0.0 AS qy,
round(cos(e0 / 2) * cos(e1 / 2) * sin(e2 / 2) - sin(e0 / 2) * sin(e1 / 2) * cos(e2 / 2), 6) + 0.0 AS qz,
round(cos(e0 / 2) * cos(e1 / 2) * cos(e2 / 2) + sin(e0 / 2) * sin(e1 / 2) * sin(e2 / 2), 6) + 0.0 AS qw FROM v"""
)
def euler_to_quat(t):
    """Quaternions of fixed-axis angles."""
    q = g.euler_quaternion(F.col("e0"), F.col("e1"), F.col("e2"))
    return t.vectors(3).select("vec_id", *[(F.round(c, 6) + 0.0).alias(f"q{n}") for c, n in zip(q, "xyzw")])


@query(f"WITH {vectors_sql(4)} SELECT vec_id, e0 AS k00, e2 AS k02, e1 AS k11, e3 AS k12, 1.0::DOUBLE AS k22, e0 AS fx, e1 AS fy, e2 AS cx, e3 AS cy FROM v")
def camera_matrix(t):
    """Camera matrix of four parameters, and back."""
    k = t.vectors(4).withColumn("k", g.camera_matrix(*[F.col(f"e{i}") for i in range(4)]))
    back = g.camera_parameters(F.col("k"))
    return k.select(
        "vec_id", *[F.get("k", F.lit(i)).alias(n) for n, i in {"k00": 0, "k02": 2, "k11": 4, "k12": 5, "k22": 8}.items()],
        *[b.alias(n) for b, n in zip(back, ("fx", "fy", "cx", "cy"))],
    )


@query(f"WITH {vectors_sql(7)} SELECT vec_id, 13 AS n, e6 AS last_pose, 0.0::DOUBLE AS padded FROM v")
def array_pad(t):
    """Poses padded with zero velocities to full states."""
    state = F.concat(F.array(*[F.col(f"e{i}") for i in range(7)]), F.array_repeat(F.lit(0.0), 6))
    return t.vectors(7).withColumn("s", state).select(
        "vec_id", F.size("s").alias("n"), F.get("s", F.lit(6)).alias("last_pose"), F.get("s", F.lit(12)).alias("padded")
    )


@query(
    """WITH a AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS a FROM embeddings),
b AS (SELECT *, list_transform(a, lambda x: x * (1 + label * 4e-6)) AS b FROM a)
SELECT vec_id, len(list_filter(list_zip(a, b), lambda p: NOT (abs(p[1] - p[2]) <= 1e-8 + 1e-5 * abs(p[2])))) = 0 AS same FROM b"""
)
def approx_equal(t):
    """Element-wise equality within the tolerances."""
    a = F.transform("embedding", lambda x: x.cast("double"))
    b = F.transform(a, lambda x: x * (F.lit(1.0) + F.col("label") * 4e-6))
    return t.embeddings.select("vec_id", audit.all_close(a, b).alias("same"))
