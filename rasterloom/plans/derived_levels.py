"""Queries of the levels before and after calibration, over the acquisition of `derived`.

Before: the counts are framed as packets, some are damaged by rules on their
ids, and the streams are read back. After: rays, fits and warps.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import workspace
from ..functions import profiles
from ..operators import compression, fit, geometry, interpolation, ordered, regions, terrain, warp
from ..sources import packets
from .derived import COLUMNS, NODATA, _lines_of_scene, coefficients, lines, query, samples, scalars, sql, table

# ---- packets ----------------------------------------------------------------------

#: What happens to a vector's packet: lost, received twice, or damaged in its marker, header or payload. Every third is compressed, unless its marker goes.
FATE = "case when vec_id % 17 = 0 then 'lost' when vec_id % 19 = 0 then 'twice' when vec_id % 13 = 0 then 'marker' when vec_id % 23 = 0 then 'header' when vec_id % 11 = 0 then 'payload' else 'whole' end"
#: Bytes of a packet of 64 plain counts.
PLAIN_PACKET = packets.HEAD + 2 * 64 + packets.TAIL
#: Lines of a stream file, and bytes of a split: small, so that streams of the test tables are split.
FILE_LINES, SPLIT = 256, 4096


def stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packets of all vectors, written as stream files and read back in splits."""
    taken = table(spark, sf_dir, "embeddings").select("vec_id", F.col("label").alias("band"))
    placed = ordered.places(taken, ["band"], "vec_id", name="line")
    placed = lines(spark, sf_dir).join(placed, ["band", "line"]).withColumn("fate", F.expr(FATE))
    coded = (F.col("vec_id") % 3 == 0) & (F.col("fate") != "marker")
    small = compression.compress(placed.where(coded), ["band", "line", "fate"]).withColumn("codec", F.lit(compression.RICE))
    hexed = lambda x: F.lpad(F.hex(x), 4, "0")
    plain = placed.where(~coded).select("band", "line", "fate", F.unhex(F.array_join(F.transform("dn", hexed), "")).alias("payload"), F.lit(compression.PLAIN).alias("codec"))
    rows = small.unionByName(plain).where("fate <> 'lost'")
    fields = rows.select(
        F.format_string("band-%d-%d.bin", "band", F.floor(F.col("line") / FILE_LINES)).alias("name"), "fate", F.col("band").cast("int").alias("channel"), F.col("line").cast("long").alias("sequence"),
        (F.col("line") * 500).cast("long").alias("time_us"), "codec", F.lit(0).alias("flags"), "payload",
    )
    framed = packets.frames(fields, ["name", "sequence", "fate"])
    zeros = lambda at, n: F.overlay("frame", F.unhex(F.lit("00" * n)), at, F.lit(n))
    end = F.length("frame")
    damaged = (
        F.when(F.col("fate") == "marker", zeros(F.lit(1), 4))
        .when(F.col("fate") == "header", zeros(F.lit(packets.HEAD - 1), 2))
        .when(F.col("fate") == "payload", zeros(end - packets.TAIL + 1, packets.TAIL))
        .otherwise(F.col("frame"))
    )
    copies = F.explode(F.when(F.col("fate") == "twice", F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    folder = workspace.folder(spark)
    packets.write_frames(framed.select("name", "sequence", damaged.alias("frame"), copies.alias("copy")), folder, job="stream")
    return packets.read_packets(spark, folder, split_bytes=SPLIT)


FATES = f"select *, {FATE} as fate from (select vec_id, label as band, row_number() over (partition by label order by vec_id) - 1 as line, embedding as e from embeddings)"


#: The last packet before it in its file that still has its marker: bytes without a marker behind a damaged header belong to it.
TOLD = f"select *, last_value(case when fate <> 'marker' then fate end ignore nulls) over (partition by band, line // {FILE_LINES} order by line rows between unbounded preceding and 1 preceding) as told from fates where fate <> 'lost'"


@query("packet_status", sql(f"select band, count(*) filter (fate = 'whole') + 2 * count(*) filter (fate = 'twice') as ok, count(*) filter (fate = 'payload') as checksum, count(*) filter (fate = 'header') as header, {PLAIN_PACKET} * count(*) filter (fate = 'marker' and told is distinct from 'header') as noise_bytes from told group by band", fates=FATES, told=TOLD))
def packet_status(spark, sf_dir):
    """Per band: whole packets, damaged ones, and bytes that no marker tells about."""
    found = stream(spark, sf_dir).withColumn("band", F.regexp_extract("path", r"band-(\d+)-", 1).cast("int"))
    status = lambda s: F.count_if(F.col("status") == s).alias(s)
    noise = F.coalesce(F.sum(F.when(F.col("status") == packets.NOISE, F.col("length"))), F.lit(0)).alias("noise_bytes")
    return found.groupBy("band").agg(*map(status, (packets.OK, packets.CHECKSUM, packets.HEADER)), noise)


@query("packet_counts", sql("select band, line, col, case when d % 97 = 0 then 0 else d end as dn from (select band, line, generate_subscripts(e, 1) - 1 as col, cast(floor((cast(unnest(e) as double) + 1) * 1024) as int) as d from fates where fate in ('whole', 'twice'))", fates=FATES))
def packet_counts(spark, sf_dir):
    """The counts of all whole packets, decompressed where need be; a line received twice is one."""
    whole = stream(spark, sf_dir).where(F.col("status") == packets.OK).dropDuplicates(["channel", "sequence"])
    found = compression.decompress(whole, ["channel", "sequence"])
    return found.select(F.col("channel").alias("band"), F.col("sequence").alias("line"), F.posexplode("dn").alias("col", "dn"))


@query("packet_gaps", sql("select band, line, missing, repeated from (select band, line, coalesce(lead(line) over (partition by band order by line) - line - 1, 0) as missing, case when fate = 'twice' then 1 else 0 end as repeated from fates where fate in ('whole', 'twice')) where missing > 0 or repeated > 0", fates=FATES))
def packet_gaps(spark, sf_dir):
    """Sequence numbers that are missing after a packet, and packets received twice."""
    found = packets.sequence_gaps(stream(spark, sf_dir), ["channel"])
    return found.select(F.col("channel").alias("band"), F.col("sequence").alias("line"), "missing", "repeated")


# ---- rays, fits, warps ---------------------------------------------------------------

#: A square of 14 x 14 nodes, which the parts of every scale fill; heights of up to 2000 m from their sizes.
NODE_SIDE = 14
GROUND = terrain.Grid(45.0, 7.0, 0.08, cells=4)
TOP = 2100.0
SATELLITE = (45.5, 7.5, 500_000.0)


def ground_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    node = F.col("p_partkey") % (NODE_SIDE * NODE_SIDE)
    mean = table(spark, sf_dir, "part").groupBy(node.alias("node")).agg((F.sum("p_size") * 40 / F.count("*")).alias("height"))
    return mean.select(F.floor(F.col("node") / NODE_SIDE).alias("row"), (F.col("node") % NODE_SIDE).alias("col"), "height")


def order_rays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, origin, ray): from one platform towards places told by the orders; some look past the heights, some away from the Earth."""
    key = F.col("o_orderkey")
    lat = F.lit(45.02) + (key % 997) / F.lit(997.0) + F.when(key % 31 == 0, 2.0).otherwise(0.0)
    lon = F.lit(7.02) + (F.col("o_custkey") % 991) / F.lit(991.0)
    at = table(spark, sf_dir, "orders").select("o_orderkey", terrain.ecef(*map(F.lit, SATELLITE)).alias("origin"), terrain.ecef(lat, lon, F.lit(0.0)).alias("at"))
    to = F.zip_with("at", "origin", lambda a, o: F.when(key % 29 == 0, o - a).otherwise(a - o))
    length = F.sqrt(F.aggregate(F.col("to"), F.lit(0.0), lambda s, x: s + x * x))
    return at.withColumn("to", to).select("o_orderkey", "origin", F.transform("to", lambda x: x / length).alias("ray"))


E2, EP2 = "(1 - power(6356752.314245179 / 6378137.0, 2))", "(power(6378137.0 / 6356752.314245179, 2) - 1)"


def _ecef_sql(lat: str, lon: str, height: str) -> str:
    n = f"(6378137.0::double / sqrt(1 - {E2} * power(sin(radians({lat})), 2)))"
    return f"({n} + {height}) * cos(radians({lat})) * cos(radians({lon})) as {{0}}x, ({n} + {height}) * cos(radians({lat})) * sin(radians({lon})) as {{0}}y, ({n} * (1 - {E2}) + {height}) * sin(radians({lat})) as {{0}}z"


#: The ray's place is corrected 40 times by its gap to the ground, then reported; ground that is not there ends it.
RAYS_SQL = f"""
with recursive nodes as (select list(h order by node) as g from (select p_partkey % 196 as node, sum(p_size) * 40 / count(*)::double as h from part group by 1)),
aims as (select o_orderkey, 45.02::double + (o_orderkey % 997) / 997.0::double + case when o_orderkey % 31 = 0 then 2 else 0 end as lat, 7.02::double + (o_custkey % 991) / 991.0::double as lon from orders),
ends as (select o_orderkey, {_ecef_sql("lat", "lon", "0").format("a")}, {_ecef_sql("45.5::double", "7.5::double", "500000").format("o")} from aims),
rays as (select o_orderkey, ox, oy, oz, (ax - ox) * s / l as dx, (ay - oy) * s / l as dy, (az - oz) * s / l as dz from (select *, case when o_orderkey % 29 = 0 then -1 else 1 end as s, sqrt(power(ax - ox, 2) + power(ay - oy, 2) + power(az - oz, 2)) as l from ends)),
scaled as (select *, dx * dx / p + dy * dy / p + dz * dz / q as qa, ox * dx / p + oy * dy / p + oz * dz / q as qb, ox * ox / p + oy * oy / p + oz * oz / q - 1 as qc from (select *, power(6378137.0 + {TOP}, 2) as p, power(6356752.314245179 + {TOP}, 2) as q from rays)),
starts as (select *, case when qb * qb - qa * qc >= 0 and qb < 0 then (-qb - sqrt(qb * qb - qa * qc)) / qa end as t from scaled),
walk as (
  select o_orderkey, 0 as n, t from starts where t is not null
  union all
  select o_orderkey, n + 1, t + (h - ground) / -(dx * cos(lat) * cos(lon) + dy * cos(lat) * sin(lon) + dz * sin(lat)) from (
    select *, (1 - a) * ((1 - b) * g[k + 1] + b * g[k + 2]) + a * ((1 - b) * g[k + 15] + b * g[k + 16]) as ground from (
      select *, u - floor(u) as a, v - floor(v) as b, cast(floor(u) as int) * 14 + cast(floor(v) as int) as k from (
        select *, (degrees(lat) - 45) / 0.08::double as u, (degrees(lon) - 7) / 0.08::double as v, flat * cos(lat) + z * sin(lat) - 6378137.0::double * sqrt(1 - {E2} * power(sin(lat), 2)) as h from (
          select *, atan2(z + {EP2} * 6356752.314245179::double * power(sin(beta), 3), flat - {E2} * 6378137.0::double * power(cos(beta), 3)) as lat, atan2(y, x) as lon from (
            select *, sqrt(x * x + y * y) as flat, atan2(z * 6378137.0::double, sqrt(x * x + y * y) * 6356752.314245179::double) as beta from (
              select walk.o_orderkey, n, walk.t, dx, dy, dz, ox + walk.t * dx as x, oy + walk.t * dy as y, oz + walk.t * dz as z from walk join starts using (o_orderkey) where n < 40))))
      where u >= 0 and u < 13 and v >= 0 and v < 13), nodes)),
last as (select o_orderkey, max(n) as n, arg_max(t, n) as t from walk group by o_orderkey),
spots as (select o_orderkey, n, case when n = 40 then ox + last.t * dx end as x, case when n = 40 then oy + last.t * dy end as y, case when n = 40 then oz + last.t * dz end as z from last join starts using (o_orderkey)),
seen as (select *, sqrt(x * x + y * y) as flat, atan2(z * 6378137.0::double, sqrt(x * x + y * y) * 6356752.314245179::double) as beta from spots),
told as (select *, atan2(z + {EP2} * 6356752.314245179::double * power(sin(beta), 3), flat - {E2} * 6378137.0::double * power(cos(beta), 3)) as lat, atan2(y, x) as lon from seen)
select o_orderkey, case when n is null then 'miss' when n < 40 then 'no terrain' else 'hit' end as status,
  cast(floor(degrees(lat) * 10000000 + 0.25) as bigint) as lat_e7, cast(floor(degrees(lon) * 10000000 + 0.25) as bigint) as lon_e7,
  cast(floor((flat * cos(lat) + z * sin(lat) - 6378137.0::double * sqrt(1 - {E2} * power(sin(lat), 2))) * 100 + 0.25) as bigint) as height_cm
from orders left join told using (o_orderkey)
"""


@query("terrain_rays", RAYS_SQL)
def terrain_rays(spark, sf_dir):
    """Where the rays of orders meet ground whose heights are the sizes of parts."""
    tiles = terrain.height_tiles(ground_nodes(spark, sf_dir), GROUND)
    found = terrain.intersect(order_rays(spark, sf_dir), tiles, GROUND, ["o_orderkey"], top=TOP)
    whole = lambda c, scale: F.floor(F.col(c) * scale + F.lit(0.25))
    return found.select("o_orderkey", "status", whole("lat", 10_000_000).alias("lat_e7"), whole("lon", 10_000_000).alias("lon_e7"), whole("height", 100).alias("height_cm"))


#: The slopes of a plane in two variables, from covariances; a second round leaves out what is off by more than twice the root mean square.
PLANE = "select l_returnflag, count(*) as used, (covar_pop(z, x) * var_pop(y) - covar_pop(z, y) * covar_pop(x, y)) / (var_pop(x) * var_pop(y) - power(covar_pop(x, y), 2)) as b, (covar_pop(z, y) * var_pop(x) - covar_pop(z, x) * covar_pop(x, y)) / (var_pop(x) * var_pop(y) - power(covar_pop(x, y), 2)) as c, avg(x) as mx, avg(y) as my, avg(z) as mz from {} group by l_returnflag"
OFF = "select pts.*, z - (mz + b * (x - mx) + c * (y - my)) as off from pts join {} using (l_returnflag)"
FIT_SQL = sql(
    "select l_returnflag, used, round(mz - b * mx - c * my, 6) as at_zero, round(b, 9) as by_line, round(c, 9) as by_col from second",
    pts="select l_returnflag, l_linenumber::double as x, l_quantity::double as y, 10 + 0.5 * l_linenumber::double + 0.25 * l_quantity::double + l_discount::double * 4 - l_tax::double * 3 + case when l_orderkey % 40 = 0 then 30 else 0 end as z from lineitem",
    first=PLANE.format("pts"), off=OFF.format("first"), spread="select l_returnflag, 2 * sqrt(avg(off * off)) as most from off group by 1",
    kept="select off.* from off join spread using (l_returnflag) where abs(off) <= most", second=PLANE.format("kept"),
)


@query("sensor_fit", FIT_SQL)
def sensor_fit(spark, sf_dir):
    """A linear model of places by line and column, fitted twice; line items as tie points, some of them far off."""
    real = lambda c: F.col(c).cast("double")
    z = 10 + 0.5 * real("l_linenumber") + 0.25 * real("l_quantity") + real("l_discount") * 4 - real("l_tax") * 3 + F.when(F.col("l_orderkey") % 40 == 0, 30).otherwise(0)
    points = table(spark, sf_dir, "lineitem").select("l_returnflag", real("l_linenumber").alias("x"), real("l_quantity").alias("y"), z.alias("z"))
    found = fit.robust(points, ["l_returnflag"], fit.monomials([F.col("x"), F.col("y")], 1), F.col("z"), sigmas=2.0, rounds=2)
    c = F.col("coefficients")
    return found.select("l_returnflag", "used", F.round(c[0], 6).alias("at_zero"), F.round(c[1], 9).alias("by_line"), F.round(c[2], 9).alias("by_col"))


#: An output pixel's place in the source, the four counts around it, and their weights; places outside the source have no value.
WARP_SQL = sql(
    "select spots.band, spots.line, spots.col, case when y >= 0 and y <= h - 1 and x >= 0 and x <= 63 then cast((1 - u) * ((1 - v) * p00.dn + case when v > 0 then v * p01.dn else 0 end) + case when u > 0 then u * ((1 - v) * p10.dn + case when v > 0 then v * p11.dn else 0 end) else 0 end as float) else cast('nan' as float) end as dn from spots "
    + " ".join(f"left join px p{a}{b} on p{a}{b}.band = spots.band and p{a}{b}.line = spots.i + {a} and p{a}{b}.col = spots.j + {b}" for a in (0, 1) for b in (0, 1)),
    "px",
    tall="select band, max(line) + 1 as h from raw group by band",
    cells="select band, h, line, unnest(range(48)) as col from (select band, h, unnest(range(h)) as line from tall)",
    spots="select *, y - floor(y) as u, x - floor(x) as v, cast(floor(y) as bigint) as i, cast(floor(x) as bigint) as j from (select *, 0.3::double + 0.1::double * col + 0.75::double * line as y, 1.25::double + 1.375::double * col + -0.0625::double * line as x from cells)",
)


@query("warp_lines", WARP_SQL)
def warp_lines(spark, sf_dir):
    """The bands' counts on a turned and stretched grid, bilinear."""
    taken = lines(spark, sf_dir)
    models = taken.groupBy("band").agg((F.max("line") + 1).alias("height")).select(
        "band", "height", F.lit(COLUMNS).alias("width"), F.col("height").alias("out_height"), F.lit(48).alias("out_width"),
        F.array(*map(F.lit, (0.3, 0.1, 0.75))).alias("to_line"), F.array(*map(F.lit, (1.25, 1.375, -0.0625))).alias("to_col"),
    )
    found = warp.warp(taken, models, ["band"], value="dn", tile=32)
    return found.select("band", F.col("line").cast("long").alias("line"), F.posexplode("values").alias("col", "dn"))


# ---- platform states --------------------------------------------------------------------

#: Samples of the platform at unequal times, the first of those at one time: position, velocity, and an attitude about an axis of its own.
STATE_SQL = sql(
    """select cast(line as bigint) as line, round((2 * u * u * u - 3 * u * u + 1) * p0 + (3 * u * u - 2 * u * u * u) * p1 + ((u * u * u - 2 * u * u + u) * v0 + (u * u * u - u * u) * v1) * dt, 5) as x,
      round(qx / n, 7) as qx, round(qy / n, 7) as qy, round(qz / n, 7) as qz, round(qw / n, 7) as qw from (
      select *, sqrt(qx * qx + qy * qy + qz * qz + qw * qw) as n from (
        select *, w0 * a0 + w1 * a1 as qx, w0 * b0 + w1 * b1 as qy, w0 * c0 + w1 * c1 as qz, w0 * d0 + w1 * d1 as qw from (
          select *, case when cosine < 0.9995 then sin((1 - u) * acos(cosine)) / sin(acos(cosine)) else 1 - u end as w0, sign * case when cosine < 0.9995 then sin(u * acos(cosine)) / sin(acos(cosine)) else u end as w1 from (
            select *, least(abs(dotted), 1) as cosine, case when dotted < 0 then -1 else 1 end as sign from (
              select *, a0 * a1 + b0 * b1 + c0 * c1 + d0 * d1 as dotted, case when t1 > t0 then (line - t0) / (t1 - t0) else 0 end as u, t1 - t0 as dt from near)))))""",
    "ln",
    told="select x as t, arg_min(y, ord) as p, min(ord) as o from (select event_id as ord, (epoch_us(ts) - 1704153600000000) / cast(48384000000 as double) as x, value as y from events where event_type = 'view') group by x",
    unit="select t, p, (p / 100) as v, (o % 7 - 3) / n as a, (o % 5 - 2) / n as b, (o % 3 - 1) / n as c, 4 / n as d from (select *, sqrt(power(o % 7 - 3, 2) + power(o % 5 - 2, 2) + power(o % 3 - 1, 2) + 16) as n from told)",
    pairs="select *, lead(t) over w as t_, lead(p) over w as p_, lead(v) over w as v_, lead(a) over w as a_, lead(b) over w as b_, lead(c) over w as c_, lead(d) over w as d_, row_number() over w as k from unit window w as (order by t)",
    near="""select line, t as t0, coalesce(t_, t) as t1, p as p0, coalesce(p_, p) as p1, v as v0, coalesce(v_, v) as v1, a as a0, coalesce(a_, a) as a1, b as b0, coalesce(b_, b) as b1, c as c0, coalesce(c_, c) as c1, d as d0, coalesce(d_, d) as d1 from ln join pairs on t <= line and (t_ is null or line < t_)
      union all select line, t, t, p, p, v, v, a, a, b, b, c, c, d, d from ln join pairs on k = 1 and line < t""",
)


@query("platform_states", STATE_SQL)
def platform_states(spark, sf_dir):
    """Position (Hermite) and attitude (SLERP) of each line between the states around it."""
    told = samples(spark, sf_dir).groupBy("scene", "x").agg(F.min_by("y", "ord").alias("p"), F.min("ord").alias("o"))
    turn = [(F.col("o") % n - k).cast("double") for n, k in ((7, 3), (5, 2), (3, 1))] + [F.lit(4.0)]
    n = F.sqrt(sum((q * q for q in turn[1:]), turn[0] * turn[0]))
    state = F.struct(F.array("p").alias("p"), F.array(F.col("p") / 100).alias("v"), F.array(*[q / n for q in turn]).alias("q"))
    states = told.select("scene", F.col("x").alias("t"), state.alias("state"))
    times = _lines_of_scene(spark, sf_dir).select("scene", F.col("line").cast("double").alias("t"))
    held = geometry.bracket(times, states, ["scene"], span=64.0)
    u = geometry.fraction(F.col("t"), F.col("t0"), F.col("t1"))
    x = geometry.hermite(F.col("s0.p"), F.col("s0.v"), F.col("s1.p"), F.col("s1.v"), u, F.col("t1") - F.col("t0"))
    q = geometry.slerp(F.col("s0.q"), F.col("s1.q"), u)
    found = held.select(F.col("t").cast("long").alias("line"), x.alias("x"), q.alias("q"))
    return found.select("line", F.round(F.col("x")[0], 5).alias("x"), *[F.round(F.col("q")[i], 7).alias(f"q{c}") for i, c in enumerate("xyzw")])


# ---- profiles and regions --------------------------------------------------------------

#: Even bands are of a sensor with the linear model, found by band and setting; odd ones of a sensor with a polynomial, found by band alone.
SENSORS = (
    profiles.Profile("even", "linear_thermal", ("band", "tdi"), {"intercept": "thermal_intercept", "gradient": "thermal_gradient"}),
    profiles.Profile("odd", "polynomial", ("band",), {"intercept": "dark", "gradient": "drift", "polynomial": "series"}, fill=-1.0),
)
SENSOR_SQL = sql(
    "select px.band, px.line, px.col, case when px.dn = 0 then case when px.band % 2 = 0 then cast('nan' as float) else cast(-1 as float) end when px.band % 2 = 0 then cast(sc.a * ((cast(px.dn as float) - (co.ti + co.tg * temp.t)) * co.nu) + sc.o as float) else (cast(0.001 as float) * (cast(px.dn as float) - (co.ti + co.tg * temp.t)) + sc.a) * (cast(px.dn as float) - (co.ti + co.tg * temp.t)) + sc.o end as radiance from px join co using (col) join sc using (band) join temp on px.line = temp.line",
    "px", "co", "sc", "temp",
)


@query("sensor_profiles", SENSOR_SQL)
def sensor_profiles(spark, sf_dir):
    """Two sensors with different models, coefficient names and keys in one plan."""
    context = scalars(spark, sf_dir).crossJoin(F.broadcast(coefficients(spark, sf_dir)))  # one row
    sensor = F.when(F.col("band") % 2 == 0, "even").otherwise("odd")
    plain = lambda c: F.col(c).cast("array<double>")
    one = lambda c: F.array(F.col(c).cast("double"))
    linear = F.create_map(*[x for c in ("non_uniformity", "thermal_intercept", "thermal_gradient") for x in (F.lit(c), plain(c))], *[x for c in ("absolute", "absolute_offset") for x in (F.lit(c), one(c))])
    series = F.array(F.col("absolute_offset").cast("double"), F.col("absolute").cast("double"), F.lit(0.001))
    other = F.create_map(F.lit("dark"), plain("thermal_intercept"), F.lit("drift"), plain("thermal_gradient"), F.lit("series"), series)
    # of the entries of one key the first counts; those of another setting serve the sensor whose key leaves it out
    listed = context.select(F.col("band").cast("int").alias("band"), sensor.alias("sensor"), F.when(sensor == "even", linear).otherwise(other).alias("coefficients"), F.explode(F.array(F.lit(4), F.lit(8))).alias("tdi"))
    entries = listed.withColumn("ord", F.col("tdi")).withColumn("coefficients", F.when(F.col("tdi") == 4, F.col("coefficients")))
    known = interpolation.by_window(_lines_of_scene(spark, sf_dir), samples(spark, sf_dir), ["scene"]).select("line", "t")
    taken = lines(spark, sf_dir)
    bands = taken.select(F.col("band").cast("int").alias("band")).distinct().withColumn("sensor", F.when(F.col("band") % 2 == 0, "even").otherwise("odd")).withColumn("tdi", F.lit(4))
    found = profiles.look_up(bands, entries, profiles.profile_table(spark, SENSORS))
    values = profiles.calibrate_lines(taken.join(known, "line").join(found, "band").withColumn("nodata", F.lit(float(NODATA))), ["sensor", "band"])
    return values.select("band", "line", F.posexplode("radiance").alias("col", "radiance"))


#: A cell is set if its count is high; regions are what four neighbours lead to.
BRIGHT = 1180
REGION_SQL = sql(
    "select band, root // 64 as line, cast(root % 64 as int) as start, count(*) as pixels, min(line) as top, max(line) as bottom, cast(min(col) as int) as left, cast(max(col) as int) as right from (select band, line, col, min(root) as root from reach group by band, line, col) group by band, root",
    "px",
    on_="select band, line, col, line * 64 + col as id from px where dn >= 1180",
    reach="select band, line, col, id as root from on_ union select n.band, n.line, n.col, reach.root from reach join on_ n on n.band = reach.band and abs(n.line - reach.line) + abs(n.col - reach.col) = 1",
).replace("with raw", "with recursive raw", 1).replace("on_", "lit")


def bright_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    mask = lines(spark, sf_dir).select("band", "line", F.transform("dn", lambda d: d >= BRIGHT).alias("mask"))
    return regions.label(regions.runs(mask, ["band"]), ["band"], strip=16)


@query("bright_regions", REGION_SQL)
def bright_region_sizes(spark, sf_dir):
    """Connected regions of high counts, over strips of 16 lines: first pixel, size and box."""
    found = regions.measure(bright_regions(spark, sf_dir), ["band"])
    return found.select("band", F.col("region.line").alias("line"), F.col("region.start").alias("start"), "pixels", "top", "bottom", "left", "right")


SHADOW_SQL = sql(
    "select distinct s.band, s.line + cast(floor(m * 0.0125::double + 0.5) as bigint) as line, s.col + cast(floor(m * -0.00625::double + 0.5) as bigint) as col from (select * from labelled join (select band, root from labelled group by band, root having count(*) >= 3) using (band, root)) s, (select unnest([200, 300, 400]) as m), tall where tall.band = s.band and s.line + cast(floor(m * 0.0125::double + 0.5) as bigint) between 0 and h - 1 and s.col + cast(floor(m * -0.00625::double + 0.5) as bigint) between 0 and 63",
    "px",
    tall="select band, max(line) + 1 as h from raw group by band",
    on_="select band, line, col, line * 64 + col as id from px where dn >= 1180",
    reach="select band, line, col, id as root from on_ union select n.band, n.line, n.col, reach.root from reach join on_ n on n.band = reach.band and abs(n.line - reach.line) + abs(n.col - reach.col) = 1",
    labelled="select band, line, col, min(root) as root from reach group by band, line, col",
).replace("with raw", "with recursive raw", 1).replace("on_", "lit")


@query("region_shadows", SHADOW_SQL)
def region_shadows(spark, sf_dir):
    """Where regions of three pixels or more throw shadows, from 200 to 400 metres up."""
    tall = lines(spark, sf_dir).groupBy("band").agg((F.max("line") + 1).alias("h"))
    found = regions.large(bright_regions(spark, sf_dir), ["band"], 3).join(tall, "band")
    thrown = regions.cast_shadows(found, ["band"], (F.lit(0.0125), F.lit(-0.00625)), 200, 400, step=100, height=F.col("h"), width=F.lit(COLUMNS))
    return thrown.select("band", "line", F.explode(F.sequence(F.col("start"), F.col("stop") - 1)).alias("col"))
