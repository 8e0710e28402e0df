"""Queries that decode every message type into flat records and encode them again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorloom import model
from sensorloom.operators import raster
from sensorloom.plans.registry import query, vectors_sql
from sensorloom.sources.readers import interpolation_args


def _xyz(i: int) -> str:
    return f"named_struct('x', e{i}, 'y', e{i + 1}, 'z', e{i + 2})"


def _quat(i: int) -> str:
    return f"named_struct('x', e{i}, 'y', e{i + 1}, 'z', e{i + 2}, 'w', e{i + 3})"


def _pose(i: int) -> str:
    return f"named_struct('position', {_xyz(i)}, 'orientation', {_quat(i + 3)})"


def _twist(i: int) -> str:
    return f"named_struct('linear', {_xyz(i)}, 'angular', {_xyz(i + 3)})"


ODOM = f"named_struct('pose', {_pose(0)}, 'twist', {_twist(7)})"


# Frames of the messages, in SQL of both engines.
FRAME, CHILD = "'frame_' || label", "'body_' || vec_id"


def _messages(t, payload: str, n: int = 64) -> DataFrame:
    """Vectors packed into message payloads."""
    return t.vectors(n).select("vec_id", "label", F.expr(FRAME).alias("frame_id"), F.expr(CHILD).alias("child_frame_id"), F.expr(payload).alias("payload"))


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) + 0.0 for c in columns})


def _columns(names: str, start: int = 0) -> str:
    return ", ".join(f"e{start + i} AS {n}" for i, n in enumerate(names.split()))


V = f"WITH {vectors_sql(64)} "


@query(V + f"SELECT vec_id, {FRAME} AS frame_id, {CHILD} AS child_frame_id, {_columns('x y z qx qy qz qw vx vy vz wx wy wz')} FROM v")
def flatten_odom(t):
    """Odometry to 13 state values."""
    return model.flatten(_messages(t, ODOM), "OdomRBState", ["vec_id", "frame_id"])


NORM2 = "(e3 * e3 + e4 * e4 + e5 * e5 + e6 * e6)"
TF_SQL = V + f"""SELECT vec_id, round(1 - 2 * (e4 * e4 + e5 * e5) / {NORM2}, 6) + 0.0 AS m00, round(2 * (e3 * e4 - e5 * e6) / {NORM2}, 6) + 0.0 AS m01,
round(2 * (e4 * e5 + e3 * e6) / {NORM2}, 6) + 0.0 AS m21, round(e0, 6) + 0.0 AS x, round(e2, 6) + 0.0 AS z, 12 AS n, {FRAME} AS frame_id, {CHILD} AS child_frame_id FROM v"""


def _affine(df: DataFrame) -> DataFrame:
    cells = {"m00": 0, "m01": 1, "m21": 9, "x": 3, "z": 11}
    return df.select(
        "vec_id", *[(F.round(F.get("m", F.lit(i)), 6) + 0.0).alias(n) for n, i in cells.items()], F.size("m").alias("n"), "frame_id", "child_frame_id"
    )


@query(TF_SQL)
def flatten_odom_tf(t):
    """Odometry to a transform matrix."""
    return _affine(model.flatten(_messages(t, ODOM), "OdomTransform", ["vec_id", "frame_id"]))


@query(TF_SQL)
def flatten_tf(t):
    """Translation and rotation to a transform matrix."""
    payload = f"named_struct('translation', {_xyz(0)}, 'rotation', {_quat(3)})"
    return _affine(model.flatten(_messages(t, payload), "Transform", ["vec_id", "frame_id"]))


@query(V + "SELECT vec_id, e0 AS vx, e5 AS wz FROM v")
def flatten_command(t):
    """Forward speed and turn rate of a twist."""
    return model.flatten(_messages(t, _twist(0)), "Command", ["vec_id"])


@query(V + f"SELECT vec_id, {_columns('lx ly lz ax ay az')} FROM v")
def flatten_twist(t):
    """Linear and angular velocity."""
    return model.flatten(_messages(t, f"named_struct('twist', {_twist(0)})"), "TwistStamped", ["vec_id"])


IMU = f"named_struct('orientation', {_quat(0)}, 'angular_velocity', {_xyz(4)}, 'linear_acceleration', {_xyz(7)})"


@query(V + f"SELECT vec_id, {_columns('qx qy qz qw wx wy wz ax ay az')} FROM v")
def flatten_imu(t):
    """Orientation, turn rate and acceleration."""
    return model.flatten(_messages(t, IMU), "Imu", ["vec_id"])


@query(V + f"SELECT vec_id, {_columns('lat lon alt')} FROM v")
def flatten_navsat(t):
    """Latitude, longitude and altitude."""
    return model.flatten(_messages(t, "named_struct('latitude', e0, 'longitude', e1, 'altitude', e2)"), "NavSatFix", ["vec_id"])


@query(V + f"SELECT vec_id, {_columns('x y z qx qy qz qw')} FROM v")
def flatten_pose(t):
    """Pose of a pose with covariance."""
    payload = f"named_struct('pose', {_pose(0)}, 'covariance', array(e8, e9))"
    return model.flatten(_messages(t, payload), "PoseWithCovarianceStamped", ["vec_id"])


@query("SELECT event_id, value AS data FROM events")
def flatten_float(t):
    """Scalar without header."""
    rows = t.events.select("event_id", F.struct(F.col("value").alias("data")).alias("payload"))
    return model.flatten(rows, "Float32", ["event_id"])


@query("SELECT event_id, CASE WHEN value > 5 THEN 1 ELSE 0 END AS status, coalesce(CASE WHEN event_type = 'error' THEN NULL ELSE epoch_us(ts) END, 0) AS stamp FROM events")
def flatten_bool(t):
    """Flag as 0 or 1; headerless messages have stamp 0."""
    rows = t.log().select(
        F.col("seq").alias("event_id"),
        F.coalesce(F.when(F.col("topic") != "error", F.col("t")), F.lit(0).cast("bigint")).alias("stamp"),
        F.struct((F.col("value") > 5).alias("data")).alias("payload"),
    )
    return model.flatten(rows, "FFCStatus", ["event_id", "stamp"])


PATH = f"named_struct('poses', array({_pose(0)}, {_pose(7)}, {_pose(14)}))"


@query(
    V + """SELECT vec_id, 0 AS goal, e0 AS x, e1 AS y, e2 AS z FROM v UNION ALL SELECT vec_id, 1, e7, e8, e9 FROM v
UNION ALL SELECT vec_id, 2, e14, e15, e16 FROM v"""
)
def flatten_goals(t):
    """Goal positions."""
    goals = model.flatten(_messages(t, PATH), "GoalArray", ["vec_id"])
    return goals.select("vec_id", F.posexplode("goals").alias("goal", "g")).select("vec_id", "goal", "g.x", "g.y", "g.z")


@query(
    V + f"""SELECT vec_id, 0 AS step, {_columns('x y z qx qy qz qw')} FROM v UNION ALL SELECT vec_id, 1, {_columns('x y z qx qy qz qw', 7)} FROM v
UNION ALL SELECT vec_id, 2, {_columns('x y z qx qy qz qw', 14)} FROM v"""
)
def flatten_path(t):
    """Poses of a path."""
    poses = model.flatten(_messages(t, PATH), "Path", ["vec_id"])
    return poses.select("vec_id", F.posexplode("poses").alias("step", "p")).select("vec_id", "step", "p.*")


CAMERA = (
    "named_struct('k', array(e0,e1,e2,e3,e4,e5,e6,e7,e8), 'd', array(e9,e10), 'r', array(e11,e12), "
    "'p', array(e20,e21,e22,e23,e24,e25,e26,e27,e28,e29,e30,e31), 'distortion_model', 'plumb_bob', 'width', 640, 'height', label)"
)


@query(V + "SELECT vec_id, e20 AS k00, e22 AS k02, e24 AS k10, e30 AS k22, e0 AS raw00, e8 AS raw22 FROM v")
def flatten_intrinsics(t):
    """3×3 camera matrix, from the projection or from the raw matrix."""
    m = _messages(t, CAMERA)
    raw = model.flatten(m, "Intrinsics", ["vec_id", "payload"], use_p=False).withColumnRenamed("k", "raw")
    both = model.flatten(raw, "Intrinsics", ["vec_id", "raw"])
    cells = {"k00": 0, "k02": 2, "k10": 3, "k22": 8}
    return both.select(
        "vec_id", *[F.get("k", F.lit(i)).alias(n) for n, i in cells.items()],
        F.get("raw", F.lit(0)).alias("raw00"), F.get("raw", F.lit(8)).alias("raw22"),
    )


@query(V + "SELECT vec_id, e4 AS k11, e10 AS d1, e11 AS r0, e31 AS p23, 'plumb_bob' AS distortion_model, 640 AS width, label AS height FROM v")
def flatten_camera(t):
    """Calibration record of a camera."""
    c = model.flatten(_messages(t, CAMERA), "CameraInfo", ["vec_id"])
    return c.select(
        "vec_id", F.get("k", F.lit(4)).alias("k11"), F.get("d", F.lit(1)).alias("d1"), F.get("r", F.lit(0)).alias("r0"),
        F.get("p", F.lit(11)).alias("p23"), "distortion_model", "width", "height",
    )


def _float_xyz(i: int) -> str:
    return f"named_struct('x', cast(e{i} as float), 'y', cast(e{i + 1} as float), 'z', cast(e{i + 2} as float))"


@query(
    "WITH p AS (SELECT vec_id, embedding AS e, unnest(range(0, 21)) AS pt FROM embeddings) "
    "SELECT vec_id, CAST(pt AS INTEGER) AS pt, e[3 * pt + 1] AS x, e[3 * pt + 2] AS y, e[3 * pt + 3] AS z FROM p"
)
def flatten_points(t):
    """Points of a cloud message, one row each."""
    payload = "named_struct('points', array(" + ", ".join(_float_xyz(3 * i) for i in range(21)) + "))"
    return model.flatten(_messages(t, payload), "PointCloud", ["vec_id"]).select("vec_id", "pt", "x", "y", "z")


def _level(i: int) -> str:
    return f"cast(floor(abs(e{i}) * 255) as int)"


LEVELS = V[:-1] + """, l AS (SELECT vec_id, [CAST(floor(abs(x) * 255) AS INTEGER) FOR x IN list_transform(embedding, lambda y: CAST(y AS DOUBLE))] AS l FROM embeddings),
px AS (SELECT vec_id, l, unnest(range(0, 16)) AS p FROM l)"""


@query(
    LEVELS + """ SELECT vec_id, CAST(p // 4 AS INTEGER) AS v, CAST(p % 4 AS INTEGER) AS u, CAST(l[4 * p + 1] / 255.0::DOUBLE AS FLOAT) AS b,
CAST(l[4 * p + 2] / 255.0::DOUBLE AS FLOAT) AS g, CAST(l[4 * p + 3] / 255.0::DOUBLE AS FLOAT) AS r FROM px"""
)
def flatten_rgb(t):
    """First three of four channels of a 4×4 image, scaled to 0…1."""
    pixels = ", ".join("array(" + ", ".join(_level(4 * p + c) for c in range(4)) + ")" for p in range(16))
    payload = f"named_struct('width', 4, 'height', 4, 'pixels', array({pixels}))"
    return model.flatten(_messages(t, payload), "Image", ["vec_id"])


@query(
    LEVELS + """, g AS (SELECT vec_id, CAST(p // 4 AS INTEGER) AS v, CAST(p % 4 AS INTEGER) AS u, CAST(l[p + 1] / 255.0::DOUBLE AS FLOAT) AS x FROM px)
SELECT vec_id, v, u, x AS b, x AS g, x AS r FROM g"""
)
def flatten_gray3(t):
    """Grey image with three equal channels."""
    payload = "named_struct('width', 4, 'height', 4, 'pixels', array(" + ", ".join(_level(p) for p in range(16)) + "))"
    return model.flatten(_messages(t, payload), "ThermalImage", ["vec_id"])


@query(LEVELS + " SELECT vec_id, CAST(p // 4 AS INTEGER) AS v, CAST(p % 4 AS INTEGER) AS u, l[4 * p + 1] AS g FROM px")
def flatten_gray16(t):
    """First channel of a raw image, unscaled."""
    pixels = ", ".join("array(" + ", ".join(_level(4 * p + c) for c in range(4)) + ")" for p in range(16))
    payload = f"named_struct('width', 4, 'height', 4, 'pixels', array({pixels}))"
    return model.flatten(_messages(t, payload), "Thermal16bitImage", ["vec_id"])


GRID = (
    "named_struct('layers', array('height', 'slope', 'rough'), 'data', array("
    + ", ".join("array(" + ", ".join(f"cast(e{12 * l + p} as float)" for p in range(12)) + ")" for l in range(3))
    + f"), 'nx', 3, 'ny', 4, 'resolution', 0.5D, 'length_x', 1.5D, 'length_y', 2D, 'position', {_xyz(40)}, "
    "'orientation', named_struct('x', 0D, 'y', 0D, 'z', 0D, 'w', 1D))"
)


@query(
    """WITH c AS (SELECT vec_id, embedding AS e, unnest(range(0, 24)) AS i FROM embeddings),
k AS (SELECT *, i % 12 AS p, CASE WHEN i < 12 THEN 0 ELSE 2 END AS l FROM c)
SELECT vec_id, CASE l WHEN 0 THEN 'height' ELSE 'rough' END AS layer, CAST(2 - p // 4 AS INTEGER) AS ix, CAST(3 - p % 4 AS INTEGER) AS iy,
e[12 * l + p + 1] AS value, CAST(e[41] AS DOUBLE) - 0.75 AS origin_x, CAST(e[42] AS DOUBLE) - 1.0 AS origin_y FROM k"""
)
def flatten_grid(t):
    """Cells of two grid layers, axes flipped, with the grid origin."""
    cells = model.flatten(_messages(t, GRID), "GridMap", ["vec_id"], layers=["height", "rough"])
    return cells.select(
        "vec_id", "layer", "ix", "iy", "value",
        F.get("origin", F.lit(0)).alias("origin_x"), F.get("origin", F.lit(1)).alias("origin_y"),
    )


@query(
    """WITH c AS (SELECT vec_id, embedding AS e, unnest(range(0, 12)) AS p FROM embeddings)
SELECT vec_id, p, CAST(2 - p // 4 AS INTEGER) AS x, CAST(3 - p % 4 AS INTEGER) AS y, CAST(p AS INTEGER) AS back, e[p + 1] AS value FROM c"""
)
def grid_flip(t):
    """Flat position to cell and back."""
    cells = t.embeddings.select("vec_id", F.posexplode(F.slice("embedding", 1, 12)).alias("p", "value"))
    x, y = raster.grid_cell(F.col("p"), 3, 4)
    placed = cells.withColumns({"x": x, "y": y, "p": F.col("p").cast("bigint")})
    return placed.withColumn("back", raster.grid_position(F.col("x"), F.col("y"), 3, 4)).select(
        "vec_id", "p", "x", "y", "back", "value"
    )


@query(
    """SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_extendedprice - 0.5 * l_quantity AS origin, (l_extendedprice - 0.5 * l_quantity) + 0.5 * l_quantity AS centre FROM lineitem"""
)
def grid_origin(t):
    """Grid origin from its centre and length, and back."""
    centre, length = F.col("l_extendedprice"), F.col("l_quantity")
    origin = raster.grid_origin(centre, length)
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", origin.alias("origin"),
        raster.grid_centre(origin, length).alias("centre"),
    )


@query(
    V + f"""SELECT vec_id, {CHILD} AS child_frame_id, e0 AS odom_x, e6 AS odom_qw, e12 AS odom_wz, e0 AS goal_x, 1.0::DOUBLE AS goal_qw, e13 AS path_qw, e5 AS command_wz, 0.0::DOUBLE AS command_vy,
e8 AS imu_ay, 36 AS n_covariance, e20 AS p00, 0.0::DOUBLE AS p03, e30 AS p22, label % 2 = 1 AS flag FROM v"""
)
def renest(t):
    """Flat records encoded as messages of eight types again."""
    messages = {
        "odom": (ODOM, "OdomRBState"), "goal": (PATH, "GoalArray"), "path": (PATH, "Path"), "command": (_twist(0), "Command"), "imu": (IMU, "Imu"),
        "pose": (f"named_struct('pose', {_pose(0)}, 'covariance', array(e8, e9))", "PoseWithCovarianceStamped"),
        "camera": (CAMERA, "Intrinsics"), "status": ("named_struct('data', label % 2 = 1)", "FFCStatus"),
    }
    rows = t.vectors(64).select("vec_id", F.expr(CHILD).alias("child_frame_id"), *[F.expr(payload).alias(f"_{n}") for n, (payload, _) in messages.items()])
    for n, (_, name) in messages.items():
        keep = [c for c in rows.columns if c != f"_{n}"]
        flat = model.flatten(rows.withColumnRenamed(f"_{n}", "payload"), name, keep)
        rows = model.nest(flat, name, keep).withColumnRenamed("payload", f"_{n}")
    return rows.selectExpr(
        "vec_id", "child_frame_id", "_odom.pose.position.x as odom_x", "_odom.pose.orientation.w as odom_qw", "_odom.twist.angular.z as odom_wz",
        "_goal.poses[0].position.x as goal_x", "_goal.poses[2].orientation.w as goal_qw", "_path.poses[1].orientation.w as path_qw",
        "_command.angular.z as command_wz", "_command.linear.y as command_vy", "_imu.linear_acceleration.y as imu_ay",
        "size(_pose.covariance) as n_covariance", "_camera.p[0] as p00", "_camera.p[3] as p03", "_camera.p[10] as p22", "_status.data as flag",
    )


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(1 AS INTEGER) AS n_args FROM events")
def map_drop_key(t):
    """Decoder arguments without the interpolation setting."""
    given = F.from_json("props", "map<string,string>")
    args = F.map_concat(given, F.create_map(F.lit("interpolation"), F.lit("MATCH_TARGET")))
    left = interpolation_args(args)
    return t.events.select("event_id", F.try_element_at(left, F.lit("k")).alias("k"), F.size(left).alias("n_args"))
