"""Message types: schemas, flattening to records, re-nesting, equality and random data.

A message table has the columns ``run, seq, topic, log_ns, stamp_ns, frame_id,
child_frame_id`` and a ``payload`` struct.  Flat tables have ``run, name, idx, stamp,
frame_id`` and the columns of their type.  Points, pixels and grid cells take one row each.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.functions.geometry import (
    matrix_position,
    matrix_quaternion,
    matrix_to_affine,
    pose_matrix,
)
from sensorloom.operators.audit import all_close, same_stamp

SYNC, INTERP, STATIC = "SYNC", "INTERP", "STATIC"

XYZ = "struct<x:double,y:double,z:double>"
QUAT = "struct<x:double,y:double,z:double,w:double>"
POSE = f"struct<position:{XYZ},orientation:{QUAT}>"
TWIST = f"struct<linear:{XYZ},angular:{XYZ}>"
ODOM = f"struct<pose:{POSE},twist:{TWIST}>"
CAMERA = (
    "struct<k:array<double>,d:array<double>,r:array<double>,p:array<double>,"
    "distortion_model:string,width:int,height:int>"
)


@dataclass(frozen=True)
class TypeSpec:
    """How one message type is stored, decoded, encoded, interpolated and generated."""

    name: str
    time_spec: str
    columns: str
    message: str | None = None
    explode: str | None = None
    flat: tuple[str, ...] = ()
    nest: str | None = None
    vectors: tuple[str, ...] = ()
    quaternion: tuple[str, ...] = ()
    element: tuple[str, ...] = ()
    random: tuple[str, ...] = ()
    elements: int = 1
    expressions: dict = field(default_factory=dict)
    child: bool = False

    @property
    def column_names(self) -> list[str]:
        return [c.split()[0] for c in _split_top(self.columns)]


def _split_top(text: str) -> list[str]:
    """Split at commas outside of angle brackets."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "<") - (ch == ">")
        if ch == "," and depth == 0:
            parts.append(text[start:i].strip())
            start = i + 1
    parts.append(text[start:].strip())
    return [p for p in parts if p]


def _xyz(source: str, names: str = "x y z") -> tuple[str, ...]:
    return tuple(f"{source}.{a} as {n}" for a, n in zip("xyz", names.split()))


def _quat(source: str) -> tuple[str, ...]:
    return tuple(f"{source}.{a} as q{a}" for a in "xyzw")


def _nest_xyz(names: str = "x y z") -> str:
    x, y, z = names.split()
    return f"named_struct('x',{x},'y',{y},'z',{z})"


_NEST_QUAT = "named_struct('x',qx,'y',qy,'z',qz,'w',qw)"
_NEST_POSE = f"named_struct('position',{_nest_xyz()},'orientation',{_NEST_QUAT})"
_POSE_COLUMNS = "x double, y double, z double, qx double, qy double, qz double, qw double"
_IDENTITY_QUAT = "named_struct('x',0D,'y',0D,'z',0D,'w',1D)"
_R = "rand({seed})"


def _uniform(*names: str) -> tuple[str, ...]:
    return tuple(f"rand({{seed}}+{i}) as {n}" for i, n in enumerate(names))


def _normal(*names: str) -> tuple[str, ...]:
    return tuple(f"randn({{seed}}+{i}) as {n}" for i, n in enumerate(names))


def _unit_quaternion() -> tuple[str, ...]:
    parts = [f"randn({{seed}}+{20 + i})" for i in range(4)]
    length = "sqrt(" + "+".join(f"{p}*{p}" for p in parts) + ")"
    return tuple(f"{p}/{length} as q{a}" for p, a in zip(parts, "xyzw"))


_GRID_COLUMNS = (
    "layer string, ix int, iy int, value float, origin array<double>, length array<double>, resolution array<double>"
)
_GRID_MESSAGE = (
    "struct<layers:array<string>,data:array<array<float>>,nx:int,ny:int,resolution:double,"
    f"length_x:double,length_y:double,position:{XYZ},orientation:{QUAT}>"
)
_GRID_FLAT = (
    "payload.layers[l] as layer",
    "cast(payload.nx - 1 - p div payload.ny as int) as ix",
    "cast(payload.ny - 1 - p % payload.ny as int) as iy",
    "value",
    "array(payload.position.x - 0.5D * payload.length_x, payload.position.y - 0.5D * payload.length_y) as origin",
    "array(payload.length_x, payload.length_y) as length",
    "array(payload.resolution, payload.resolution) as resolution",
)
_GRID_RANDOM = (
    "concat('layer_', cast(e % 2 as string)) as layer",
    "cast(e div 2 % 8 as int) as ix",
    "cast(e div 16 as int) as iy",
    "cast(randn({seed}) as float) as value",
    "array(-4D, -4D) as origin",
    "array(8D, 8D) as length",
    "array(1D, 1D) as resolution",
)
_COLOUR_FLAT = (
    "cast(p div payload.width as int) as v",
    "cast(p % payload.width as int) as u",
    "cast(px[0] / 255D as float) as b",
    "cast(px[1] / 255D as float) as g",
    "cast(px[2] / 255D as float) as r",
)
_CHILD = "concat('child_', cast(idx as string)) as child_frame_id"
_PIXEL = "cast(e div 16 as int) as v, cast(e % 16 as int) as u"


def _image(name: str, flat: tuple[str, ...], pixel: str) -> TypeSpec:
    return TypeSpec(
        name,
        SYNC,
        "v int, u int, b float, g float, r float",
        f"struct<width:int,height:int,pixels:array<{pixel}>>",
        "posexplode(payload.pixels) as (p, px)",
        flat,
        element=("v", "u"),
        elements=192,
        random=(
            *_PIXEL.split(", "),
            *[f"cast(floor(rand({{seed}}+{i}) * 256) / 255D as float) as {c}" for i, c in enumerate("bgr")],
        ),
    )


# The registered type names and their time specification.
TYPES = [
    TypeSpec("BEVGrid", SYNC, _GRID_COLUMNS, _GRID_MESSAGE, "grid", _GRID_FLAT, element=("layer", "ix", "iy"), elements=128, random=_GRID_RANDOM),
    TypeSpec("GridMap", SYNC, _GRID_COLUMNS, _GRID_MESSAGE, "grid", _GRID_FLAT, element=("layer", "ix", "iy"), elements=128, random=_GRID_RANDOM),
    TypeSpec("Float32", INTERP, "data double", "struct<data:double>", flat=("payload.data as data",),
             nest="named_struct('data',data)", vectors=("data",), random=_uniform("data")),
    TypeSpec("Command", INTERP, "vx double, wz double", TWIST,
             flat=("payload.linear.x as vx", "payload.angular.z as wz"),
             nest="named_struct('linear',named_struct('x',vx,'y',0D,'z',0D),'angular',named_struct('x',0D,'y',0D,'z',wz))",
             vectors=("vx", "wz"), random=_uniform("vx", "wz")),
    _image("Image", _COLOUR_FLAT, "array<int>"),
    _image("CompressedImage", _COLOUR_FLAT, "array<int>"),
    TypeSpec("FeatureImage", SYNC, "v int, u int, features array<float>, keys array<struct<label:string,metainfo:string>>",
             element=("v", "u"), elements=128,
             random=("cast(e div 16 as int) as v", "cast(e % 16 as int) as u",
                     "array(cast(randn({seed}) as float), cast(randn({seed}+1) as float)) as features",
                     "transform(sequence(0,1), i -> named_struct('label', concat('feat_', i), 'metainfo', 'rand')) as keys")),
    _image("ThermalImage", (
        "cast(p div payload.width as int) as v", "cast(p % payload.width as int) as u",
        "cast(px / 255D as float) as b", "cast(px / 255D as float) as g", "cast(px / 255D as float) as r"), "int"),
    TypeSpec("Thermal16bitImage", SYNC, "v int, u int, g int",
             "struct<width:int,height:int,pixels:array<array<int>>>", "posexplode(payload.pixels) as (p, px)",
             ("cast(p div payload.width as int) as v", "cast(p % payload.width as int) as u", "px[0] as g"),
             element=("v", "u"), elements=192,
             random=(*_PIXEL.split(", "), "cast(rand({seed}) * 65536 as int) as g")),
    TypeSpec("Intrinsics", STATIC, "k array<double>", CAMERA,
             flat=("slice(payload.p,1,3) || slice(payload.p,5,3) || slice(payload.p,9,3) as k",),
             nest="named_struct('k',k,'d',cast(array() as array<double>),'r',array(1D,0D,0D,0D,1D,0D,0D,0D,1D),"
                  "'p',slice(k,1,3)||array(0D)||slice(k,4,3)||array(0D)||slice(k,7,3)||array(0D),"
                  "'distortion_model','','width',0,'height',0)",
             random=("array(rand({seed})*100, 0D, rand({seed}+1)*100, 0D, rand({seed}+2)*100, rand({seed}+3)*100, 0D, 0D, 1D) as k",)),
    TypeSpec("CameraInfo", STATIC,
             "k array<double>, d array<double>, r array<double>, p array<double>, distortion_model string, width int, height int",
             CAMERA, flat=tuple(f"payload.{c} as {c}" for c in ("k", "d", "r", "p", "distortion_model", "width", "height")),
             nest="named_struct('k',k,'d',d,'r',r,'p',p,'distortion_model',distortion_model,'width',width,'height',height)",
             random=("array(rand({seed})*100, 0D, rand({seed}+1)*100, 0D, rand({seed}+2)*100, rand({seed}+3)*100, 0D, 0D, 1D) as k",
                     "array(randn({seed}+4)*0.1D, randn({seed}+5)*0.1D, randn({seed}+6)*0.1D, randn({seed}+7)*0.1D, randn({seed}+8)*0.1D) as d",
                     "array(1D,0D,0D,0D,1D,0D,0D,0D,1D) as r",
                     "array(rand({seed})*100, 0D, rand({seed}+1)*100, 0D, 0D, rand({seed}+2)*100, rand({seed}+3)*100, 0D, 0D, 0D, 1D, 0D) as p",
                     "'plumb_bob' as distortion_model", "640 as width", "480 as height")),
    TypeSpec("PointCloud", SYNC, "pt int, x float, y float, z float, r float, g float, b float",
             "struct<points:array<struct<x:float,y:float,z:float>>>", "posexplode(payload.points) as (pt, p)",
             ("pt", "p.x as x", "p.y as y", "p.z as z",
              "cast(null as float) as r", "cast(null as float) as g", "cast(null as float) as b"),
             element=("pt",), elements=200,
             random=("cast(e as int) as pt", *[f"cast(rand({{seed}}+{i}) as float) as {c}" for i, c in enumerate("xyzrgb")])),
    TypeSpec("FeaturePointCloud", SYNC,
             "pt int, x float, y float, z float, features array<float>, keys array<struct<label:string,metainfo:string>>",
             element=("pt",), elements=200,
             random=("cast(e as int) as pt", *[f"cast(rand({{seed}}+{i}) as float) as {c}" for i, c in enumerate("xyz")],
                     "if(rand({seed}+3) < 0.5, transform(sequence(0,4), i -> cast(i * rand({seed}+4) as float)), null) as features",
                     "transform(sequence(0,4), i -> named_struct('label', concat('feat_', i), 'metainfo', 'rand')) as keys")),
    TypeSpec("Transform", INTERP, "m array<double>, child_frame_id string", f"struct<translation:{XYZ},rotation:{QUAT}>",
             expressions={"m": ("payload.translation", "payload.rotation")}, nest="transform", child=True,
             random=("array(1D,0D,0D,rand({seed}),0D,1D,0D,rand({seed}+1),0D,0D,1D,rand({seed}+2)) as m", _CHILD)),
    TypeSpec("OdomTransform", INTERP, "m array<double>, child_frame_id string", ODOM,
             expressions={"m": ("payload.pose.position", "payload.pose.orientation")}, nest="odom_transform", child=True,
             random=("array(1D,0D,0D,rand({seed}),0D,1D,0D,rand({seed}+1),0D,0D,1D,rand({seed}+2)) as m", _CHILD)),
    TypeSpec("OdomRBState", INTERP,
             _POSE_COLUMNS + ", vx double, vy double, vz double, wx double, wy double, wz double, child_frame_id string", ODOM,
             child=True,
             flat=(*_xyz("payload.pose.position"), *_quat("payload.pose.orientation"),
                   *_xyz("payload.twist.linear", "vx vy vz"), *_xyz("payload.twist.angular", "wx wy wz")),
             nest=f"named_struct('pose',{_NEST_POSE},'twist',named_struct('linear',{_nest_xyz('vx vy vz')},'angular',{_nest_xyz('wx wy wz')}))",
             vectors=("x", "y", "z", "vx", "vy", "vz", "wx", "wy", "wz"), quaternion=("qx", "qy", "qz", "qw"),
             random=(*_uniform("x", "y", "z"), *_unit_quaternion(),
                     *[f"rand({{seed}}+{30 + i}) as {c}" for i, c in enumerate(("vx", "vy", "vz", "wx", "wy", "wz"))], _CHILD)),
    TypeSpec("GoalArray", SYNC, "goals array<struct<x:double,y:double,z:double>>", f"struct<poses:array<{POSE}>>",
             flat=("transform(payload.poses, p -> p.position) as goals",),
             nest=f"named_struct('poses', transform(goals, g -> named_struct('position', g, 'orientation', {_IDENTITY_QUAT})))",
             random=("array(named_struct('x',rand({seed}),'y',rand({seed}+1),'z',rand({seed}+2)),"
                     "named_struct('x',rand({seed}+3),'y',rand({seed}+4),'z',rand({seed}+5))) as goals",)),
    TypeSpec("Path", SYNC,
             "poses array<struct<x:double,y:double,z:double,qx:double,qy:double,qz:double,qw:double>>",
             f"struct<poses:array<{POSE}>>",
             flat=("transform(payload.poses, p -> named_struct('x',p.position.x,'y',p.position.y,'z',p.position.z,"
                   "'qx',p.orientation.x,'qy',p.orientation.y,'qz',p.orientation.z,'qw',p.orientation.w)) as poses",),
             nest="named_struct('poses', transform(poses, p -> named_struct('position',named_struct('x',p.x,'y',p.y,'z',p.z),"
                  "'orientation',named_struct('x',p.qx,'y',p.qy,'z',p.qz,'w',p.qw))))",
             random=("array(named_struct('x',rand({seed}),'y',rand({seed}+1),'z',rand({seed}+2),'qx',rand({seed}+3),"
                     "'qy',rand({seed}+4),'qz',rand({seed}+5),'qw',rand({seed}+6))) as poses",)),
    TypeSpec("VoxelGrid", SYNC,
             "raster_idx bigint, features array<float>, hits bigint, misses bigint, min_xyz array<float>, "
             "max_xyz array<float>, first_update double, last_update double, origin array<double>, "
             "length array<double>, resolution array<double>",
             element=("raster_idx",), elements=150,
             random=("e as raster_idx", "if(rand({seed}) < 0.5, array(cast(randn({seed}+1) as float)), null) as features",
                     "cast(rand({seed}+2)*100 as bigint) as hits", "cast(rand({seed}+3)*100 as bigint) as misses",
                     "array(cast(rand({seed}+4) as float)) as min_xyz", "array(cast(1+rand({seed}+5) as float)) as max_xyz",
                     "rand({seed}+6) as first_update", "1+rand({seed}+7) as last_update",
                     "array(0D,0D,0D) as origin", "array(8D,8D,8D) as length", "array(1D,1D,1D) as resolution")),
    TypeSpec("Imu", INTERP, "qx double, qy double, qz double, qw double, wx double, wy double, wz double, ax double, ay double, az double",
             f"struct<orientation:{QUAT},angular_velocity:{XYZ},linear_acceleration:{XYZ}>",
             flat=(*_quat("payload.orientation"), *_xyz("payload.angular_velocity", "wx wy wz"), *_xyz("payload.linear_acceleration", "ax ay az")),
             nest=f"named_struct('orientation',{_NEST_QUAT},'angular_velocity',{_nest_xyz('wx wy wz')},'linear_acceleration',{_nest_xyz('ax ay az')})",
             vectors=("wx", "wy", "wz", "ax", "ay", "az"), quaternion=("qx", "qy", "qz", "qw"),
             random=(*_unit_quaternion(), *_normal("wx", "wy", "wz", "ax", "ay", "az"))),
    TypeSpec("NavSatFix", INTERP, "lat double, lon double, alt double", "struct<latitude:double,longitude:double,altitude:double>",
             flat=("payload.latitude as lat", "payload.longitude as lon", "payload.altitude as alt"),
             nest="named_struct('latitude',lat,'longitude',lon,'altitude',alt)", vectors=("lat", "lon", "alt"),
             random=("rand({seed})*180-90 as lat", "rand({seed}+1)*360-180 as lon", "rand({seed}+2)*5100-100 as alt")),
    TypeSpec("PoseWithCovarianceStamped", INTERP, _POSE_COLUMNS, f"struct<pose:{POSE},covariance:array<double>>",
             flat=(*_xyz("payload.pose.position"), *_quat("payload.pose.orientation")),
             nest=f"named_struct('pose',{_NEST_POSE},'covariance',array_repeat(0D,36))",
             vectors=("x", "y", "z"), quaternion=("qx", "qy", "qz", "qw"),
             random=(*_normal("x", "y", "z"), *_unit_quaternion())),
    TypeSpec("TwistStamped", INTERP, "lx double, ly double, lz double, ax double, ay double, az double", f"struct<twist:{TWIST}>",
             flat=(*_xyz("payload.twist.linear", "lx ly lz"), *_xyz("payload.twist.angular", "ax ay az")),
             nest=f"named_struct('twist',named_struct('linear',{_nest_xyz('lx ly lz')},'angular',{_nest_xyz('ax ay az')}))",
             vectors=("lx", "ly", "lz", "ax", "ay", "az"), random=_normal("lx", "ly", "lz", "ax", "ay", "az")),
    TypeSpec("FFCStatus", SYNC, "status int", "struct<data:boolean>",
             flat=("if(payload.data, 1, 0) as status",), nest="named_struct('data', status = 1)",
             random=("cast(rand({seed}) < 0.5 as int) as status",)),
]

REGISTRY = {spec.name: spec for spec in TYPES}


def registry_table(spark: SparkSession) -> DataFrame:
    """The registry as a table ``type, time_spec``; its size is fixed."""
    return spark.createDataFrame([(s.name, s.time_spec) for s in TYPES], "type string, time_spec string")


def flatten(messages: DataFrame, type_name: str, keep: list[str], use_p: bool = True, layers: list[str] = ()) -> DataFrame:
    """Flat records of messages of one type; ``keep`` names the columns carried along.

    ``use_p`` chooses the projection matrix for intrinsics, ``layers`` the grid layers.
    """
    spec = REGISTRY[type_name]
    if spec.message is None:
        raise ValueError(f"{type_name} has no message form")
    if spec.explode == "grid":
        return _flatten_grid(messages, spec, keep, list(layers))
    own = _child(spec, keep)
    if spec.expressions:
        position, orientation = spec.expressions["m"]
        m = pose_matrix(*[F.col(f"{position}.{a}") for a in "xyz"], *[F.col(f"{orientation}.{a}") for a in "xyzw"])
        return messages.select(*keep, matrix_to_affine(m).alias("m"), *own)
    if type_name == "Intrinsics" and not use_p:
        return messages.select(*keep, F.col("payload.k").alias("k"))
    rows = messages.selectExpr("*", spec.explode) if spec.explode else messages
    return rows.selectExpr(*keep, *spec.flat, *own)


def _child(spec: TypeSpec, keep: list[str]) -> list[str]:
    """The child frame of types that have one, unless it is carried along anyway."""
    return ["child_frame_id"] if spec.child and "child_frame_id" not in keep else []


def _flatten_grid(messages: DataFrame, spec: TypeSpec, keep: list[str], layers: list[str]) -> DataFrame:
    q = [F.col(f"payload.orientation.{a}") for a in "xyzw"]
    straight = all_close(F.array(*q), F.lit([0.0, 0.0, 0.0, 1.0]))
    checked = messages.filter(
        F.when(straight, F.lit(True)).otherwise(F.raise_error(F.lit("rotated grids are not supported")).cast("boolean"))
    )
    cells = checked.selectExpr("*", "posexplode(payload.data) as (l, cells)")
    if layers:
        cells = cells.filter(F.get(F.col("payload.layers"), F.col("l")).isin(layers))
    return cells.selectExpr("*", "posexplode(cells) as (p, value)").selectExpr(*keep, *spec.flat)


def nest(flat: DataFrame, type_name: str, keep: list[str]) -> DataFrame:
    """Message payloads, and the child frame of types that have one, from flat records of one row per datum."""
    spec = REGISTRY[type_name]
    if spec.nest is None:
        raise ValueError(f"{type_name} is stored in several rows per message")
    keep = [*keep, *_child(spec, keep)]
    if not spec.expressions:
        return flat.select(*keep, F.expr(spec.nest).alias("payload"))
    position = F.struct(*[c.alias(a) for c, a in zip(matrix_position(F.col("m")), "xyz")])
    orientation = F.struct(*[c.alias(a) for c, a in zip(matrix_quaternion(F.col("m")), "xyzw")])
    if spec.nest == "transform":
        return flat.select(*keep, F.struct(position.alias("translation"), orientation.alias("rotation")).alias("payload"))
    zero = F.struct(*[F.lit(0.0).alias(a) for a in "xyz"])
    return flat.select(
        *keep,
        F.struct(
            F.struct(position.alias("position"), orientation.alias("orientation")).alias("pose"),
            F.struct(zero.alias("linear"), zero.alias("angular")).alias("twist"),
        ).alias("payload"),
    )


def generate(spark: SparkSession, type_name: str, n: int, seed: int = 37) -> DataFrame:
    """``n`` random datums of a type, for tests."""
    spec = REGISTRY[type_name]
    rows = spark.range(n).selectExpr("cast(id as int) as idx")
    if spec.elements > 1:
        rows = rows.selectExpr("idx", f"explode(sequence(0L, {spec.elements - 1}L)) as e")
    exprs = [r.replace("{seed}", str(seed)) for r in spec.random]
    return rows.selectExpr("'run' as run", f"'{type_name}' as name", "idx", f"idx + 0.25D as stamp", "'random' as frame_id", *exprs)


def same_records(a: DataFrame, b: DataFrame, type_name: str) -> Column | DataFrame:
    """Datums that differ between two flat tables of a type, beyond the tolerances."""
    spec = REGISTRY[type_name]
    key = ["run", "name", "idx", *spec.element]
    values = [c for c in spec.column_names if c not in spec.element]
    left = a.select(*key, F.struct("stamp", "frame_id", *values).alias("l"))
    right = b.select(*key, F.struct("stamp", "frame_id", *values).alias("r"))
    ok = same_stamp(F.col("l.stamp"), F.col("r.stamp")) & F.col("l.frame_id").eqNullSafe(F.col("r.frame_id"))
    for c in values:
        x, y = F.col(f"l.{c}"), F.col(f"r.{c}")
        kind = a.schema[c].dataType.simpleString()
        if kind in ("double", "float"):
            same = all_close(F.array(x), F.array(y))
        elif kind in ("array<double>", "array<float>"):
            same = all_close(x, y)
        else:
            same = x == y
        ok = ok & (F.coalesce(same, F.lit(False)) | (x.isNull() & y.isNull()))
    joined = left.join(right, key, "full_outer")
    return joined.filter(~F.coalesce(ok, F.lit(False)))

