"""Rigid transforms, quaternions and projection as column expressions.

Quaternions are ``(x, y, z, w)``; matrices are row-major arrays of 16 doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

IDENTITY = [1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0, 1.0]

# Fixed value: rotation from camera axes to north-east-down axes.
CAMERA_TO_NED = (-0.5, -0.5, -0.5, 0.5)


def norm(*parts: Column) -> Column:
    return F.sqrt(sum((p * p for p in parts[1:]), parts[0] * parts[0]))


def normalized(*parts: Column) -> list[Column]:
    length = norm(*parts)
    return [p / length for p in parts]


def rotation(qx: Column, qy: Column, qz: Column, qw: Column) -> list[Column]:
    """Nine row-major entries of the rotation of a quaternion of any length."""
    s = F.lit(2.0) / (qx * qx + qy * qy + qz * qz + qw * qw)
    one = F.lit(1.0)
    return [
        one - s * (qy * qy + qz * qz), s * (qx * qy - qz * qw), s * (qx * qz + qy * qw),
        s * (qx * qy + qz * qw), one - s * (qx * qx + qz * qz), s * (qy * qz - qx * qw),
        s * (qx * qz - qy * qw), s * (qy * qz + qx * qw), one - s * (qx * qx + qy * qy),
    ]


def pose_matrix(x, y, z, qx, qy, qz, qw) -> Column:
    """4×4 matrix of a pose."""
    r = rotation(qx, qy, qz, qw)
    return F.array(
        r[0], r[1], r[2], x, r[3], r[4], r[5], y, r[6], r[7], r[8], z,
        F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0),
    )


def affine_to_matrix(rows: Column) -> Column:
    """4×4 matrix from its first three rows."""
    return F.concat(F.slice(rows, 1, 12), F.lit([0.0, 0.0, 0.0, 1.0]))


def matrix_to_affine(m: Column) -> Column:
    return F.slice(m, 1, 12)


def matrix_quaternion(m: Column) -> list[Column]:
    """Unit quaternion of a matrix, with ``w`` not negative.

    The largest of the four squared components is the divisor, so it is never near zero.
    """
    def e(i, j):
        return F.get(m, F.lit(4 * i + j))

    xx, yy, zz = e(0, 0), e(1, 1), e(2, 2)
    size = [1 + xx - yy - zz, 1 - xx + yy - zz, 1 - xx - yy + zz, 1 + xx + yy + zz]
    xy, xz, yz = e(0, 1) + e(1, 0), e(0, 2) + e(2, 0), e(1, 2) + e(2, 1)
    xw, yw, zw = e(2, 1) - e(1, 2), e(0, 2) - e(2, 0), e(1, 0) - e(0, 1)
    rows = [
        [size[0], xy, xz, xw],
        [xy, size[1], yz, yw],
        [xz, yz, size[2], zw],
        [xw, yw, zw, size[3]],
    ]
    top = F.greatest(*size)
    raw = F.array(*[F.lit(0.0)] * 4)
    for s, row in zip(size, rows):
        raw = F.when(s == top, F.array(*row)).otherwise(raw)
    scale = F.when(F.get(raw, F.lit(3)) < 0, F.lit(-0.5)).otherwise(F.lit(0.5)) / F.sqrt(top)
    return [F.get(raw, F.lit(i)) * scale for i in range(4)]


def matrix_position(m: Column) -> list[Column]:
    return [F.get(m, F.lit(i)) for i in (3, 7, 11)]


def matmul(a: Column, b: Column) -> Column:
    """Product of two rotation-translation matrices."""
    x = [F.get(a, F.lit(i)) for i in range(12)]
    y = [F.get(b, F.lit(i)) for i in range(12)]

    def cell(i, j):
        turned = x[4 * i] * y[j] + x[4 * i + 1] * y[4 + j] + x[4 * i + 2] * y[8 + j]
        return turned + x[4 * i + 3] if j == 3 else turned

    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(*[cell(i, j) for i in range(3) for j in range(4)], zero, zero, zero, one)


def rigid_inverse(m: Column) -> Column:
    """Inverse of a rotation-translation matrix."""
    def e(i, j):
        return F.get(m, F.lit(4 * i + j))

    rows = []
    for i in range(3):
        rows += [e(0, i), e(1, i), e(2, i), -(e(0, i) * e(0, 3) + e(1, i) * e(1, 3) + e(2, i) * e(2, 3))]
    return F.array(*rows, F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))


def chain(matrices: Column) -> Column:
    """Ordered product of an array of matrices; identity when empty."""
    rest = F.slice(matrices, F.lit(2), F.size(matrices))
    return F.when(F.size(matrices) == 0, F.lit(IDENTITY)).otherwise(F.aggregate(rest, F.get(matrices, F.lit(0)), matmul))


def transform_point(m: Column, x: Column, y: Column, z: Column) -> list[Column]:
    def row(i):
        return (
            F.get(m, F.lit(4 * i)) * x + F.get(m, F.lit(4 * i + 1)) * y + F.get(m, F.lit(4 * i + 2)) * z
            + F.get(m, F.lit(4 * i + 3))
        )

    return [row(0), row(1), row(2)]


def pinhole(x: Column, y: Column, z: Column, fx: float, fy: float, cx: float, cy: float) -> tuple[Column, Column]:
    """Pixel coordinates ``u, v`` of a camera point."""
    return x * F.lit(fx) / z + F.lit(cx), y * F.lit(fy) / z + F.lit(cy)


def camera_matrix(fx: Column, fy: Column, cx: Column, cy: Column) -> Column:
    zero, one = F.lit(0.0), F.lit(1.0)
    return F.array(fx, zero, cx, zero, fy, cy, zero, zero, one)


def camera_parameters(k: Column) -> list[Column]:
    """``fx, fy, cx, cy`` of a row-major 3×3 matrix."""
    return [F.get(k, F.lit(i)) for i in (0, 4, 2, 5)]


def slerp_weights(a: list[Column], b: list[Column], w: Column) -> tuple[Column, Column]:
    """Factors of two unit quaternions for shortest-arc interpolation at fraction ``w``."""
    dot = a[0] * b[0] + a[1] * b[1] + a[2] * b[2] + a[3] * b[3]
    sign = F.when(dot < 0, F.lit(-1.0)).otherwise(F.lit(1.0))
    d = F.least(F.lit(1.0), F.abs(dot))
    theta = F.acos(d)
    close = d > 0.9995
    wa = F.when(close, F.lit(1.0) - w).otherwise(F.sin((F.lit(1.0) - w) * theta) / F.sin(theta))
    wb = F.when(close, w).otherwise(F.sin(w * theta) / F.sin(theta)) * sign
    return wa, wb


def canonical(*q: Column) -> list[Column]:
    """Unit quaternion with ``w`` not negative."""
    flip = F.when(q[3] < 0, F.lit(-1.0)).otherwise(F.lit(1.0)) / norm(*q)
    return [c * flip for c in q]


def slerp(a: list[Column], b: list[Column], w: Column) -> list[Column]:
    """Shortest-arc interpolation of unit quaternions."""
    wa, wb = slerp_weights(a, b, w)
    return canonical(*[wa * p + wb * q for p, q in zip(a, b)])


def euler_quaternion(roll: Column, pitch: Column, yaw: Column) -> list[Column]:
    """Quaternion of rotations about the fixed x, y and z axes, in that order."""
    cr, sr = F.cos(roll / 2), F.sin(roll / 2)
    cp, sp = F.cos(pitch / 2), F.sin(pitch / 2)
    cy, sy = F.cos(yaw / 2), F.sin(yaw / 2)
    return [
        sr * cp * cy - cr * sp * sy,
        cr * sp * cy + sr * cp * sy,
        cr * cp * sy - sr * sp * cy,
        cr * cp * cy + sr * sp * sy,
    ]
