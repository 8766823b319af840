"""Line times, platform state between samples, and viewing rays.

States are joined to lines as `interpolation.segments` joins temperatures;
here are the expressions for vectors and attitude. Vectors are arrays of
three doubles, attitudes unit quaternions (x, y, z, w).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ordered


def _once(then: Callable[..., Column], **values: Column) -> Column:
    """`then` of values that are worked out once a row; a Column used several times is worked out as often, and once an element inside a lambda."""
    bound = F.array(F.struct(*[value.alias(name) for name, value in values.items()]))
    return F.transform(bound, lambda held: then(**{name: held[name] for name in values}))[0]


def line_time_us(line: Column, start_us: Column, line_period_us: Column, height: Column, scan_direction: Column) -> Column:
    """The imager clock at a line; a backward scan (direction below 0) takes the last line first."""
    step = F.when(scan_direction < 0, height - 1 - line).otherwise(line)
    return start_us + step.cast("double") * line_period_us


def bracket(times: DataFrame, states: DataFrame, keys: list[str], *, span: float = 4096.0) -> DataFrame:
    """Join `times` (keys, t) to the two neighbouring `states` (keys, t, state): adds `t0`, `s0`, `t1`, `s1`.

    One sort per `span` of t; before the first and after the last state the
    nearest one stands on both sides.
    """
    kind = states.schema["state"].dataType
    both = states.select(*keys, "t", "state", F.lit(0).alias("kind")).unionByName(times.select(*keys, "t").distinct().withColumn("state", F.lit(None).cast(kind)).withColumn("kind", F.lit(1)))
    found = ordered.neighbours(both, keys, "t", ["kind"], F.col("kind") == 0, F.struct(F.col("t"), F.col("state")), span=span)
    a, b = F.coalesce("before", "after"), F.coalesce("after", "before")
    found = found.where("kind = 1").select(*keys, "t", a["t"].alias("t0"), a["state"].alias("s0"), b["t"].alias("t1"), b["state"].alias("s1"))
    return times.join(found, [*keys, "t"])


def fraction(t: Column, t0: Column, t1: Column) -> Column:
    """Where t lies between t0 and t1, clamped to 0..1; 0 if they are equal."""
    inside = (t - t0) / F.when(t1 != t0, t1 - t0)
    return F.coalesce(F.least(F.greatest(inside, F.lit(0.0)), F.lit(1.0)), F.lit(0.0))


def linear(s0: Column, s1: Column, u: Column) -> Column:
    return F.zip_with(s0, s1, lambda a, b: a + (b - a) * u)


def hermite(p0: Column, v0: Column, p1: Column, v1: Column, u: Column, seconds: Column) -> Column:
    """Position between two states with velocities, `seconds` apart."""
    h00, h10, h01, h11 = 2 * u * u * u - 3 * u * u + 1, u * u * u - 2 * u * u + u, 3 * u * u - 2 * u * u * u, u * u * u - u * u
    ends = F.zip_with(p0, p1, lambda a, b: h00 * a + h01 * b)
    slopes = F.zip_with(v0, v1, lambda a, b: (h10 * a + h11 * b) * seconds)
    return F.zip_with(ends, slopes, lambda a, b: a + b)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def unit(v: Column) -> Column:
    """A vector scaled to unit length."""
    scaled = lambda v, length: F.transform(v, lambda x: x / length)
    return _once(lambda v: _once(scaled, v=v, length=F.sqrt(dot(v, v))), v=v)


def slerp(q0: Column, q1: Column, u: Column) -> Column:
    """Spherical interpolation along the shorter arc; nearly equal attitudes are interpolated linearly and scaled back to unit length."""

    def turned(q0, q1, u, straight):
        near = F.when(straight < 0, F.transform(q1, lambda x: -x)).otherwise(q1)
        cosine = F.least(F.abs(straight), F.lit(1.0))
        return _once(weighed, q0=q0, near=near, u=u, cosine=cosine, angle=F.acos(cosine))

    def weighed(q0, near, u, cosine, angle):
        sine = F.when(cosine < 0.9995, F.sin(angle))
        w0, w1 = F.coalesce(F.sin((1 - u) * angle) / sine, 1 - u), F.coalesce(F.sin(u * angle) / sine, u)
        return _once(lambda q0, near, w0, w1: F.zip_with(q0, near, lambda a, b: a * w0 + b * w1), q0=q0, near=near, w0=w0, w1=w1)

    return unit(_once(lambda q0, q1, u: _once(turned, q0=q0, q1=q1, u=u, straight=dot(q0, q1)), q0=q0, q1=q1, u=u))


def rotate(q: Column, v: Column) -> Column:
    """A vector turned by a unit quaternion."""

    def turned(v, x, y, z, w):
        rows = (
            (1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
            (2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
            (2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
        )
        return F.array(*[a * v[0] + b * v[1] + c * v[2] for a, b, c in rows])

    return _once(lambda q, v: _once(turned, v=v, **{name: q[i] for i, name in enumerate("xyzw")}), q=q, v=v)


def transform3(matrix: Column, v: Column) -> Column:
    """A 3 x 3 matrix (array of rows) times a vector."""
    return _once(lambda matrix, v: F.transform(matrix, lambda row: dot(row, v)), matrix=matrix, v=v)


def viewing_ray(column: Column, row: Column, centre: Column, pitch: Column, focal: Column, boresight: Column, attitude: Column) -> Column:
    """Unit direction in which a detector pixel looks: through the lens, the boresight matrix, and the platform's attitude."""
    camera = F.array((column - centre) * pitch, row * pitch, focal)
    return unit(rotate(attitude, transform3(boresight, camera)))
