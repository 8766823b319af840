"""An acquisition derived from the driver's tables, and the queries over it.

bands: the labels of `embeddings`; lines: vectors of a label in id order;
counts: quantised components, some set to the NoData value 0; coefficients
per column from `part`; scale and offset per band from `nation`; telemetry
from the view events. Every query has its SQL beside it, put together from
the same named relations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import item_id, micrometres, to_byte
from ..operators import calibration, geometry, interpolation, ordered, preview, quality, raw_lines, reflectance, timing
from ..sources import package

#: Start of the telemetry clock, and microseconds per line.
ORIGIN_US, LINE_US = 1_704_153_600_000_000, 48_384_000_000
COLUMNS = 64
NODATA = 0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# ---- relations, in Spark --------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(band, line, dn array)."""
    count = lambda e: F.floor((e.cast("double") + 1) * 1024).cast("int")
    dn = F.transform("embedding", lambda e: F.when(count(e) % 97 == 0, F.lit(NODATA)).otherwise(count(e)))
    taken = table(spark, sf_dir, "embeddings").select(F.col("label").alias("band"), "vec_id", dn.alias("dn"))
    return ordered.places(taken, ["band"], "vec_id", name="line").select("band", F.col("line").cast("int").alias("line"), "dn")


def coefficients(spark: SparkSession, sf_dir: str, divide: float = 20.0) -> DataFrame:
    """One row: the three coefficient arrays, in column order; of the parts dealt to a column the one with the least key."""
    part = table(spark, sf_dir, "part").groupBy((F.col("p_partkey") % COLUMNS).alias("col"))
    part = part.agg(F.min_by("p_size", "p_partkey").alias("p_size"), F.min_by("p_retailprice", "p_partkey").alias("p_retailprice"))
    ranked = F.array_sort(F.collect_list(F.struct("col", "p_size", "p_retailprice")))  # COLUMNS entries
    rows = part.agg(ranked.alias("p"))
    number = lambda f: F.transform("p", lambda p: f(p).cast("float"))
    return rows.select(
        number(lambda p: 1 + (p["p_size"] - 25) / F.lit(1000.0)).alias("non_uniformity"),
        number(lambda p: p["p_retailprice"] / F.lit(divide)).alias("thermal_intercept"),
        number(lambda p: p["p_size"] / F.lit(100.0)).alias("thermal_gradient"),
    )


def scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").select(key.alias("band"), ((key + 1) / F.lit(100.0)).cast("float").alias("absolute"), F.col("n_regionkey").cast("float").alias("absolute_offset"))


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(scene, ord, x, y): telemetry of the one scene."""
    events = table(spark, sf_dir, "events").where("event_type = 'view'")
    x = (F.unix_micros(F.col("ts").cast("timestamp")) - ORIGIN_US) / F.lit(float(LINE_US))
    return events.select(F.lit("scene").alias("scene"), F.col("event_id").alias("ord"), x.alias("x"), F.col("value").alias("y"))


def band_lines(spark: SparkSession, sf_dir: str, divide: float = 20.0) -> DataFrame:
    """Lines with their context and temperature.

    All bands share the scene's temperatures, so these are worked out once a
    line; this telemetry grows with the tables, so by the one-sort form.
    """
    context = scalars(spark, sf_dir).crossJoin(F.broadcast(coefficients(spark, sf_dir, divide)))  # one row
    known = interpolation.by_window(_lines_of_scene(spark, sf_dir), samples(spark, sf_dir), ["scene"]).select("line", "t")
    taken = lines(spark, sf_dir).join(known, "line")
    return taken.join(context, "band").withColumn("nodata", F.lit(float(NODATA)))


def pixels(spark: SparkSession, sf_dir: str, divide: float = 20.0) -> DataFrame:
    keep = ["band", "line", "t", "nodata", "absolute", "absolute_offset"]
    return calibration.to_pixels(band_lines(spark, sf_dir, divide), keep)


def radiance(spark: SparkSession, sf_dir: str, divide: float = 20.0) -> DataFrame:
    return calibration.calibrate_pixels(pixels(spark, sf_dir, divide)).select("band", "line", "col", "dn", "radiance")


# ---- the same relations, in SQL ---------------------------------------------------

RELATIONS: dict[str, str] = {
    "raw": "select label as band, row_number() over (partition by label order by vec_id) - 1 as line, embedding as e from embeddings",
    "counted": "select band, line, generate_subscripts(e, 1) - 1 as col, cast(floor((cast(unnest(e) as double) + 1) * 1024) as int) as d from raw",
    "px": "select band, line, col, case when d % 97 = 0 then 0 else d end as dn from counted",
    "co": "select col, cast(1 + (p_size - 25) / cast(1000 as double) as float) as nu, cast(p_retailprice / cast({divide} as double) as float) as ti, cast(p_size / cast(100 as double) as float) as tg from (select p_partkey % 64 as col, arg_min(p_size, p_partkey) as p_size, arg_min(p_retailprice, p_partkey) as p_retailprice from part group by 1)",
    "sc": "select n_nationkey as band, cast((n_nationkey + 1) / cast(100 as double) as float) as a, cast(n_regionkey as float) as o from nation",
    "tele": "select event_id as ord, (epoch_us(ts) - 1704153600000000) / cast(48384000000 as double) as x, value as y from events where event_type = 'view'",
    "pieces": "select x as x0, y as y0, lead(x) over (order by x, ord) as x1, lead(y) over (order by x, ord) as y1, row_number() over (order by x, ord) as n from tele",
    "seg": "select x0, y0, x1, y1 from pieces where x1 is null or x1 > x0 union all select null, null, x0, y0 from pieces where n = 1",
    "ln": "select distinct cast(line as double) as line from raw",
    "temp": "select line, cast(case when x1 is null or x0 = line then y0 when x0 is null then y1 else (y1 - y0) / (x1 - x0) * (line - x0) + y0 end as float) as t from ln, seg where (x0 is null or x0 <= line) and (x1 is null or line < x1)",
    "rad": "select px.band, px.line, px.col, px.dn, temp.t, case when px.dn = 0 then cast('nan' as float) else cast(sc.a * ((cast(px.dn as float) - (co.ti + co.tg * temp.t)) * co.nu) + sc.o as float) end as radiance from px join co using (col) join sc using (band) join temp on px.line = temp.line",
    "stats": "select band, count(*) as pixels, count(*) filter (not isnan(radiance) and not isinf(radiance)) as valid, count(*) filter (isnan(radiance)) as nodata, count(*) filter (isinf(radiance)) as non_finite, count(*) filter (not isnan(radiance) and not isinf(radiance) and radiance < 0) as negative, min(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end) as min, max(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end) as max, avg(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end) as mean, stddev_pop(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end) as std from rad group by band",
}
#: Relation -> those it reads.
USES = {"counted": ["raw"], "px": ["counted"], "pieces": ["tele"], "seg": ["pieces"], "ln": ["raw"], "temp": ["ln", "seg"], "rad": ["px", "co", "sc", "temp"], "stats": ["rad"]}


def sql(body: str, *relations: str, divide: str = "20", **more: str) -> str:
    """A statement over named relations, with those and what they need in front."""
    order: list[str] = []

    def need(name: str) -> None:
        for other in USES.get(name, []):
            need(other)
        if name not in order:
            order.append(name)

    for name in relations:
        need(name)
    parts = [f"{n} as ({RELATIONS[n].format(divide=divide) if n == 'co' else RELATIONS[n]})" for n in order] + [f"{n} as ({text})" for n, text in more.items()]
    return (f"with {', '.join(parts)} " if parts else "") + body


def query(name: str, statement: str):
    """Register a query with the SQL that gives the same rows."""

    def put(function):
        QUERIES[name], SQL[name] = function, statement
        return function

    return put


# ---- radiometry --------------------------------------------------------------------


@query("calibrate_radiance", sql("select band, line, col, dn, radiance from rad", "rad"))
def calibrate_radiance(spark, sf_dir):
    return radiance(spark, sf_dir)


@query("calibrate_lines", sql("select band, line, count(*) as n, count(*) filter (isnan(radiance)) as empty, max(case when not isnan(radiance) then radiance end) as brightest from rad group by band, line", "rad"))
def calibrate_lines(spark, sf_dir):
    """The line form of the model: no row per pixel."""
    done = calibration.calibrate_lines(band_lines(spark, sf_dir))
    good = F.filter("radiance", lambda x: ~F.isnan(x))
    return done.select("band", "line", F.size("radiance").cast("long").alias("n"), (F.size("radiance") - F.size(good)).cast("long").alias("empty"), F.array_max(good).alias("brightest"))


@query("dark_signal", sql("select sc.band, temp.line, co.col, co.ti + co.tg * temp.t as dark from (select distinct band, line from raw) r join temp on r.line = temp.line join sc on r.band = sc.band cross join co", "temp", "co", "sc"))
def dark_signal(spark, sf_dir):
    return calibration.dark_pixels(pixels(spark, sf_dir)).select("band", "line", "col", "dark")


@query("flat_field", sql("select px.band, px.line, px.col, (cast(px.dn as float) - (co.ti + co.tg * temp.t)) * co.nu as relative from px join co using (col) join temp on px.line = temp.line", "px", "co", "temp"))
def flat_field(spark, sf_dir):
    from ..functions.models import flat_field as apply

    px = calibration.dark_pixels(pixels(spark, sf_dir))
    return px.select("band", "line", "col", apply(F.col("dn"), F.col("dark"), {"non_uniformity": F.col("non_uniformity")}).alias("relative"))


@query("nodata_mask", sql("select band, line, col from rad where isnan(radiance)", "rad"))
def nodata_mask(spark, sf_dir):
    return radiance(spark, sf_dir).where(F.isnan("radiance")).select("band", "line", "col")


@query("nodata_sentinel", sql("select band, line, col, case when isnan(radiance) then cast(-9999 as float) else radiance end as radiance from rad", "rad"))
def nodata_sentinel(spark, sf_dir):
    return calibration.calibrate_pixels(pixels(spark, sf_dir), fill=-9999.0).select("band", "line", "col", "radiance")


@query("polynomial_model", sql("select px.band, px.line, px.col, case when px.dn = 0 then cast('nan' as float) else ((cast(0.001 as float) * (cast(px.dn as float) - (co.ti + co.tg * temp.t)) + sc.a) * (cast(px.dn as float) - (co.ti + co.tg * temp.t)) + sc.o) end as radiance from px join co using (col) join sc using (band) join temp on px.line = temp.line", "px", "co", "sc", "temp"))
def polynomial_model(spark, sf_dir):
    """Second order: offset + scale * x + 0.001 * x^2."""
    px = pixels(spark, sf_dir).withColumn("polynomial", F.array("absolute_offset", "absolute", F.lit(0.001).cast("float")))
    return calibration.calibrate_pixels(px, model="polynomial").select("band", "line", "col", "radiance")


@query("band_subset", sql("select band, line, col, radiance from rad where band in (1, 3)", "rad"))
def band_subset(spark, sf_dir):
    return radiance(spark, sf_dir).where(F.col("band").isin(1, 3)).select("band", "line", "col", "radiance")


# ---- interpolation and clocks ---------------------------------------------------------


def _lines_of_scene(spark, sf_dir):
    return lines(spark, sf_dir).select(F.lit("scene").alias("scene"), "line").distinct()


@query("interp_temperature_timed", sql("select cast(line as int) as line, t from temp", "temp"))
def interp_temperature_timed(spark, sf_dir):
    return interpolation.by_segments(_lines_of_scene(spark, sf_dir), samples(spark, sf_dir), ["scene"]).select("line", "t")


@query("interp_temperature_window", sql("select cast(line as int) as line, t from temp", "temp"))
def interp_temperature_window(spark, sf_dir):
    return interpolation.by_window(_lines_of_scene(spark, sf_dir), samples(spark, sf_dir), ["scene"]).select(F.col("line").cast("int").alias("line"), "t")


UNIFORM = "select row_number() over (order by event_id) - 1 as ord, value as y, count(*) over () as k from events where event_type = 'view'"
SPREAD = "select ord, y, case when ord = k - 1 then 999.0 else ord * (cast(999 as double) / (k - 1)) end as x from uni"
USEG = "select x as x0, y as y0, lead(x) over (order by x, ord) as x1, lead(y) over (order by x, ord) as y1 from spread"


@query("interp_temperature_uniform", sql("select l.line, cast(case when x1 is null or x0 = l.line then y0 else (y1 - y0) / (x1 - x0) * (l.line - x0) + y0 end as float) as t from (select unnest(range(1000)) as line) l, useg where x0 <= l.line and (x1 is null or l.line < x1)", uni=UNIFORM, spread=SPREAD, useg=USEG))
def interp_temperature_uniform(spark, sf_dir):
    """A thousand lines, samples without times; as these are all events of the table, by the form for any number."""
    spread = interpolation.uniform_positions(samples(spark, sf_dir).select("scene", "ord", "y"), F.lit(1000), ["scene"])
    every = spark.range(1000).select(F.col("id").alias("line"), F.lit("scene").alias("scene"))
    return interpolation.by_window(every, spread, ["scene"]).select("line", "t")


@query("single_sample_profile", sql("select e.event_type as scene, l.line, cast(e.value as float) as t from (select unnest(range(100)) as line) l, (select event_type, max(value) as value from events group by 1) e"))
def single_sample_profile(spark, sf_dir):
    """Event types as scenes; the one sample of each is its largest value."""
    one = table(spark, sf_dir, "events").groupBy(F.col("event_type").alias("scene")).agg(F.max("value").alias("y")).withColumns({"x": F.lit(50.0), "ord": F.lit(0)})
    held = interpolation.sample_array(one, ["scene"])
    every = held.withColumn("line", F.explode(F.sequence(F.lit(0), F.lit(99))))
    return every.select("scene", "line", interpolation.by_array(F.col("line"), F.col("samples")).alias("t"))


CLOCK = "(cast(e.event_id as double) * 500 - (cast(a.o_orderkey as double) * 10 + (cast(1000 as double) - a.o_custkey) * 1000.0 + cast(-0.5 as double) * 1e6)) / cast(250 as double)"


@query("sample_line_positions", sql(f"select e.user_id, e.event_id, case when m.missing = 0 then {CLOCK} end as sample_line from events e join (select user_id, count(*) filter (event_type = 'error') as missing from events group by 1) m using (user_id) join (select o_custkey, min(o_orderkey) as o_orderkey from orders group by 1) a on e.user_id = a.o_custkey"))
def sample_line_positions(spark, sf_dir):
    """Users as scenes, events as samples (errors lack their time), the first order of the like-named customer as anchor."""
    kind = F.when(F.col("event_type") != "error", F.col("event_id").cast("double") * 500)
    taken = table(spark, sf_dir, "events").select("user_id", "event_id", kind.alias("imager_time"))
    first = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("user_id")).agg(F.min("o_orderkey").alias("k"))
    scenes = first.select("user_id", (F.col("k").cast("double") * 10).alias("imager_us"), F.col("user_id").cast("double").alias("platform_ms"), F.lit(1000.0).alias("start_ms"), F.lit(-0.5).alias("offset_s"), F.lit(250.0).alias("line_period_us"))
    placed = timing.sample_lines(taken, scenes, ["user_id"]).where(F.col("imager_us").isNotNull())
    return placed.select("user_id", "event_id", "sample_line")


@query("sync_anchor_first_match", sql("select o_custkey as scene, cast(min(o_orderkey) as double) as imager_us, cast(arg_min(o_totalprice, o_orderkey) as double) as platform_ms from orders where o_orderstatus = 'F' group by 1"))
def sync_anchor_first_match(spark, sf_dir):
    """Orders as clock entries of their customer; status F is the anchor format."""
    entries = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("scene"), F.col("o_orderkey").alias("ord"), F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("time_format"),
        F.col("o_orderkey").alias("imager_time"), F.col("o_totalprice").alias("platform_time"),
    )
    return timing.first_anchor(entries, ["scene"])


@query("missing_times", sql("select user_id, count(*) filter (event_type = 'error') as n_missing, count(*) as n from events group by 1"))
def missing_times(spark, sf_dir):
    taken = table(spark, sf_dir, "events").select("user_id", F.when(F.col("event_type") != "error", F.col("event_id").cast("double")).alias("imager_time"))
    return timing.drop_partial_times(taken, ["user_id"]).groupBy("user_id").agg(F.max("n_missing").alias("n_missing"), F.count("*").alias("n"))


@query("epoch_clock", sql("select event_id, epoch_us(ts) / 1000.0::double as epoch_ms from events"))
def epoch_clock(spark, sf_dir):
    iso = F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    return table(spark, sf_dir, "events").select("event_id", timing.epoch_ms(iso).alias("epoch_ms"))


# ---- calibration tables and band metadata ------------------------------------------------


def _entries(spark, sf_dir):
    """Line items as calibration entries: part, line number and supplier modulo 8 are the key, document order is (order, line)."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        (F.col("l_partkey") % 50).alias("band"), F.col("l_linenumber").alias("start_row"), (F.col("l_suppkey") % 8).alias("tdi"), (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("ord"),
        F.col("l_extendedprice").alias("absolute"), F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("uuid"),
    )


ENTRIES = "select l_partkey % 50 as band, l_linenumber as start_row, l_suppkey % 8 as tdi, l_orderkey * 8 + l_linenumber as ord, l_extendedprice as absolute, l_orderkey || '-' || l_linenumber as uuid from lineitem"


@query("calibration_lookup_first", sql("select band, start_row, tdi, min(ord) as ord, arg_min(absolute, ord) as absolute from ent group by all", ent=ENTRIES))
def calibration_lookup_first(spark, sf_dir):
    return calibration.first_entries(_entries(spark, sf_dir)).select("band", "start_row", "tdi", "ord", "absolute")


@query("calibration_uuid_last", sql("select band, arg_max(uuid, ord) as uuid from ent group by band", ent=ENTRIES))
def calibration_uuid_last(spark, sf_dir):
    return calibration.last_uuids(_entries(spark, sf_dir), ["band"])


@query("calibration_multi_entry", sql("select band, start_row, tdi, count(*) as n from ent group by all having count(*) > 1", ent=ENTRIES))
def calibration_multi_entry(spark, sf_dir):
    return _entries(spark, sf_dir).groupBy("band", "start_row", "tdi").agg(F.count("*").alias("n")).where("n > 1")


NEAR = "select b.n_nationkey as band, e.start_row, e.tdi, e.ord, row_number() over (partition by b.n_nationkey order by abs(e.tdi - 4) * 65536 + abs(e.start_row - 9), e.ord) as n from nation b join (select band, start_row, tdi, min(ord) as ord from ent group by all) e on b.n_nationkey = e.band"


@query("calibration_nearest", sql("select band, start_row, tdi, ord from near where n = 1", ent=ENTRIES, near=NEAR))
def calibration_nearest(spark, sf_dir):
    """No entry has start row 9, so each band takes the nearest."""
    wanted = table(spark, sf_dir, "nation").select(F.lit(0).alias("scope"), F.col("n_nationkey").cast("long").alias("band"), F.col("n_nationkey").alias("band_id"), F.lit(9).alias("start_row"), F.lit(4).alias("tdi"))
    entries = _entries(spark, sf_dir).withColumn("scope", F.lit(0)).withColumns({"row_used": F.col("start_row"), "tdi_used": F.col("tdi")})
    near = calibration.look_up_nearest(wanted, entries, ["scope"])
    return near.select("band", F.col("row_used").alias("start_row"), F.col("tdi_used").alias("tdi"), "ord")


@query("band_filter_join", sql("select s_suppkey as ord, n_name as band, n_nationkey as band_id from supplier join nation on s_nationkey = n_nationkey where n_nationkey < 20"))
def band_filter_join(spark, sf_dir):
    """Suppliers as rasters, nations below 20 as the filter map."""
    filters = table(spark, sf_dir, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("band_id"), F.col("n_name").alias("band"))
    return table(spark, sf_dir, "supplier").join(filters, F.col("s_nationkey") == F.col("band_id")).select(F.col("s_suppkey").alias("ord"), "band", "band_id")


@query("band_unmatched_anti", sql("select s_suppkey as ord, s_nationkey as band_id from supplier where s_nationkey >= 20"))
def band_unmatched_anti(spark, sf_dir):
    filters = table(spark, sf_dir, "nation").where("n_nationkey < 20")
    lost = table(spark, sf_dir, "supplier").join(filters, F.col("s_nationkey") == F.col("n_nationkey"), "left_anti")
    return lost.select(F.col("s_suppkey").alias("ord"), F.col("s_nationkey").alias("band_id"))




@query("imager_positional_join", sql("select n_nationkey as band_id, case when n_nationkey < len(cwl) then cwl[n_nationkey + 1] else cast('nan' as double) end as cwl_nm from nation, waves", waves="select list(cast(400.5 + 25 * r_regionkey as double) order by r_regionkey) as cwl from region"))
def imager_positional_join(spark, sf_dir):
    """Wavelengths by position; past the end of the list NaN."""
    waves = table(spark, sf_dir, "region").agg(F.array_sort(F.collect_list((F.lit(400.5) + 25 * F.col("r_regionkey")).cast("double"))).alias("cwl"))
    joined = table(spark, sf_dir, "nation").crossJoin(F.broadcast(waves))  # one row
    return joined.select(F.col("n_nationkey").alias("band_id"), F.coalesce(F.get("cwl", F.col("n_nationkey")), F.lit(float("nan"))).alias("cwl_nm"))


@query("band_metadata", sql("select n_name as band, n_name || '_L1B' as item_id, round((n_nationkey * 37.123 + 401)::double / 1000, 4) as micrometres from nation"))
def band_metadata(spark, sf_dir):
    wave = (F.col("n_nationkey") * F.lit(37.123) + 401).cast("double")
    return table(spark, sf_dir, "nation").select(F.col("n_name").alias("band"), item_id(F.col("n_name"), F.lit("L1B")).alias("item_id"), micrometres(wave).alias("micrometres"))


@query("json_props_extract", sql("select event_id, cast(json_extract(props, '$.k') as bigint) as k, len(json_keys(props)) as n from events"))
def json_props_extract(spark, sf_dir):
    props = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", props["k"].cast("long").alias("k"), F.size(props).cast("long").alias("n"))


@query("json_tolerant", sql("select doc_id, cast(text as varchar) like '{%' and json_valid(text) as is_object from documents"))
def json_tolerant(spark, sf_dir):
    """Documents that are no JSON object give null, not an error."""
    return table(spark, sf_dir, "documents").select("doc_id", F.from_json("text", "map<string,string>", {"mode": "PERMISSIVE"}).isNotNull().alias("is_object"))


# ---- quality ---------------------------------------------------------------------------------

ROUNDED = "band, pixels, valid, nodata, non_finite, negative, min, max, round(mean, 6) as mean, round(std, 6) as std"
RATED = f"select {ROUNDED}, case when pixels = 0 then 0 else nodata / pixels end as nodata_fraction, case when valid = 0 then 0 else negative / valid end as negative_fraction from stats"


def _rounded(report: DataFrame) -> DataFrame:
    return report.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query("qa_band_stats", sql(f"select {ROUNDED} from stats", "stats"))
def qa_band_stats(spark, sf_dir):
    return _rounded(radiance(spark, sf_dir).groupBy("band").agg(*quality.statistics()))


@query("qa_band_stats_negative", sql(f"select {ROUNDED} from stats", "stats", divide="1"))
def qa_band_stats_negative(spark, sf_dir):
    """A larger dark signal, so that some radiance is negative."""
    return _rounded(radiance(spark, sf_dir, 1.0).groupBy("band").agg(*quality.statistics()))


FLAG_SQL = "concat_ws(',', case when valid = 0 then 'all_invalid' end, case when valid > 0 and max = min then 'zero_dynamic_range' end, case when nodata_fraction > {nodata} then 'high_nodata' end, case when negative_fraction > {negative} then 'negative_radiance' end, case when non_finite > 0 then 'non_finite_values' end)"


@query("qa_flags", sql(f"select band, nodata_fraction, negative_fraction, {FLAG_SQL.format(nodata=0.011, negative=0.05)} as flags, {FLAG_SQL.format(nodata=0.011, negative=0.05)} = '' as passed from rated", "stats", divide="1", rated=RATED))
def qa_flags(spark, sf_dir):
    report = quality.band_report(radiance(spark, sf_dir, 1.0), ["band"], quality.Thresholds(None, 0.05, 0.011))
    return report.select("band", "nodata_fraction", "negative_fraction", F.array_join("flags", ",").alias("flags"), "passed")


@query("qa_product_verdict", sql("select coalesce(bool_and(nodata / pixels <= 0.5 and (valid = 0 or negative / valid <= 0.05) and non_finite = 0 and valid > 0 and max > min), true) as passed, count(*) as bands from stats", "stats"))
def qa_product_verdict(spark, sf_dir):
    return quality.verdict(quality.band_report(radiance(spark, sf_dir), ["band"]))


@query("qa_saturation", sql("select band, count(*) filter (dn >= 1300) as saturated, count(*) filter (dn >= 1300) > 0 as flagged from px group by band", "px"))
def qa_saturation(spark, sf_dir):
    report = quality.band_report(radiance(spark, sf_dir), ["band"], quality.Thresholds(saturation_dn=1300))
    return report.select("band", "saturated", F.array_contains("flags", "saturation").alias("flagged"))


@query("window_block_stats", sql("select band, line // 16 as block, count(*) as pixels, min(dn) as low, max(dn) as high from px group by all", "px"))
def window_block_stats(spark, sf_dir):
    """Blocks of 16 lines; the last may be short."""
    px = calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"])
    return px.groupBy("band", F.floor(F.col("line") / 16).alias("block")).agg(F.count("*").alias("pixels"), F.min("dn").alias("low"), F.max("dn").alias("high"))


# ---- previews -----------------------------------------------------------------------------------


def _overview(factor: int):
    @query(f"overview_{factor}x", sql(f"select band, cast(line // {factor} as int) as line, cast(col // {factor} as int) as col, round(coalesce(avg(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end), cast('nan' as double)), 6) as radiance from rad group by all", "rad"))
    def overview(spark, sf_dir):
        small = preview.overview(radiance(spark, sf_dir), ["band"], factor)
        return small.withColumn("radiance", F.round("radiance", 6))

    return overview


for _factor in preview.OVERVIEW_FACTORS:
    _overview(_factor)

SHAPES = "select band, max(line) + 1 as h from raw group by band"
DECIMATED = "select rad.band, cast(line * 20 // h as int) as line, cast(col * 20 // 64 as int) as col, coalesce(avg(case when not isnan(radiance) and not isinf(radiance) then cast(radiance as double) end), cast('nan' as double)) as radiance from rad join shapes using (band) group by all"


def _decimated(spark, sf_dir):
    tall = lines(spark, sf_dir).groupBy("band").agg((F.max("line") + 1).alias("h"))
    px = radiance(spark, sf_dir).join(F.broadcast(tall), "band")  # a row per band
    return preview.decimate(px, ["band"], F.col("h"), F.lit(COLUMNS), F.lit(20), F.lit(20))


@query("decimate_average", sql("select band, line, col, round(radiance, 6) as radiance from dec", "rad", shapes=SHAPES, dec=DECIMATED))
def decimate_average(spark, sf_dir):
    return _decimated(spark, sf_dir).withColumn("radiance", F.round("radiance", 6))


BOUNDS = "select band, quantile_cont(case when not isnan(radiance) then cast(radiance as double) end, 0.02) as lo, quantile_cont(case when not isnan(radiance) then cast(radiance as double) end, 0.98) as hi from rad group by band"


@query("percentile_stretch", sql("select band, round(lo, 6) as low, round(hi, 6) as high from bounds", "rad", bounds=BOUNDS))
def percentile_stretch(spark, sf_dir):
    bounds = preview.stretch_bounds(radiance(spark, sf_dir), ["band"])
    return bounds.select("band", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"))


LEVELS = "select rad.band, line, col, case when lo is null then 0 when isnan(radiance) then cast('nan' as double) else least(greatest((cast(radiance as double) - lo) / (case when hi <= lo then 1 else hi - lo end), 0), 1) end as level from rad join bounds using (band)"
BYTE = "cast(coalesce(max(case when band = {band} then case when isnan(level) then 0 else trunc(level * 255) end end), 0) as int)"


@query("rgb_stack_uint8", sql(f"select line, col, {BYTE.format(band=0)} as r, {BYTE.format(band=1)} as g, {BYTE.format(band=2)} as b from levels where band in (0, 1, 2) group by line, col", "rad", bounds=BOUNDS, levels=LEVELS))
def rgb_stack_uint8(spark, sf_dir):
    levels = preview.stretched(radiance(spark, sf_dir).where(F.col("band").isin(0, 1, 2)), ["band"])
    return preview.stack_rgb(levels, [], (0, 1, 2))


@query("missing_rgb_bands", sql("select min(x) as missing from (values (0), (1), (99)) v(x) where x not in (select label from embeddings)"))
def missing_rgb_bands(spark, sf_dir):
    have = table(spark, sf_dir, "embeddings").select(F.col("label").alias("band"))
    return preview.missing_bands(have, (0, 1, 99)).select(F.array_min("missing").alias("missing"))


# ---- other levels ---------------------------------------------------------------------------------


@query("esun_weighted", sql("select l_linenumber as band, round(sum((p_size + 1) * l_quantity) / sum(l_quantity) * 1000, 4) as esun from lineitem join part on l_partkey = p_partkey group by 1"))
def esun_weighted(spark, sf_dir):
    """Parts as the solar spectrum, line items as band responses."""
    spectrum = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("wavelength"), (F.col("p_size") + 1.0).alias("irradiance"))
    response = table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").alias("band"), F.col("l_partkey").alias("wavelength"), F.col("l_quantity").alias("response"))
    return reflectance.solar_irradiance(spectrum, response, ["band"]).withColumn("esun", F.round("esun", 4))


@query("toa_reflectance", sql("select band, line, col, round(pi() * radiance * 1.01::double * 1.01::double / (cast(band + 1 as double) * 150 * cos(radians(35::double))), 9) as reflectance from rad where not isnan(radiance)", "rad"))
def toa_reflectance(spark, sf_dir):
    lit = radiance(spark, sf_dir).where(~F.isnan("radiance"))
    value = reflectance.top_of_atmosphere(F.col("radiance").cast("double"), (F.col("band") + 1).cast("double") * 150, F.lit(1.01), F.lit(35.0))
    return lit.select("band", "line", "col", F.round(value, 9).alias("reflectance"))


@query("surface_reflectance", sql("select band, line, col, round((0.02::double * radiance - 0.1::double) / (1 + 0.15::double * (0.02::double * radiance - 0.1::double)), 9) as reflectance from rad where not isnan(radiance)", "rad"))
def surface_reflectance(spark, sf_dir):
    lit = radiance(spark, sf_dir).where(~F.isnan("radiance"))
    return lit.select("band", "line", "col", F.round(reflectance.surface(F.col("radiance").cast("double"), F.lit(0.02), F.lit(0.1), F.lit(0.15)), 9).alias("reflectance"))


@query("tdi_accumulate", sql("select r.scene, r.setup as band, px.line - (px.band - r.start_row) as line, px.col, sum(px.dn) as dn from px join (select 0 as scene, 1 as setup, 2 as start_row, 4 as tdi union all select 0, 2, 5, 3) r on px.band >= r.start_row and px.band < r.start_row + r.tdi group by all", "px"))
def tdi_accumulate(spark, sf_dir):
    """Bands of the derived acquisition as detector rows of one scene; two settings."""
    raw = calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"]).select(F.lit(0).alias("scene"), F.col("band").alias("row"), "line", "col", "dn")
    setup = spark.createDataFrame([(0, 1, 2, 4, 1), (0, 2, 5, 3, 1)], "scene int, band int, start_row int, tdi int, scan_direction int")
    return raw_lines.accumulate_rows(raw, setup, ["scene"])


@query("bin_pixels", sql("select band, line // 4 as line, col // 4 as col, sum(dn) as dn from px group by all", "px"))
def bin_pixels(spark, sf_dir):
    return raw_lines.bin_pixels(calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"]).select("band", "line", "col", "dn"), ["band"], 4)


@query("line_gaps", sql("select o_custkey as scene, line, missing, repeated from (select o_custkey, line, coalesce(lead(line) over (partition by o_custkey order by line) - line - 1, 0) as missing, n - 1 as repeated from (select o_custkey, o_orderkey // 4 as line, count(*) as n from orders group by all)) where missing > 0 or repeated > 0"))
def line_gaps(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("scene"), F.floor(F.col("o_orderkey") / 4).alias("line"))
    return raw_lines.line_gaps(orders, ["scene"])


@query("dead_pixel_fill", sql("select band, line, col, cast(case when not dead then dn when l is null then r when r is null then l else (l + r) / 2 end as double) as dn from (select *, last_value(case when not dead then cast(dn as double) end ignore nulls) over (partition by band, line order by col rows between unbounded preceding and 1 preceding) as l, first_value(case when not dead then cast(dn as double) end ignore nulls) over (partition by band, line order by col rows between 1 following and unbounded following) as r from (select *, col % 7 = 0 as dead from px))", "px"))
def dead_pixel_fill(spark, sf_dir):
    px = calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"]).select("band", "line", "col", F.col("dn").cast("double").alias("dn"), (F.col("col") % 7 == 0).alias("dead"))
    return raw_lines.fill_dead_columns(px, ["band"], "dn").drop("dead")


@query("stretch_levels", sql("select band, line, col, cast(trunc(level * 255) as int) as level from levels where not isnan(level)", "rad", bounds=BOUNDS, levels=LEVELS))
def stretch_levels(spark, sf_dir):
    levels = preview.stretched(radiance(spark, sf_dir), ["band"]).where(~F.isnan("level"))
    return levels.select("band", "line", "col", to_byte(F.col("level")).alias("level"))


@query("line_times", sql("select band, line, cast(1000000 as double) + case when band % 2 = 1 then h - 1 - line else line end * cast(500 as double) as t_us from raw join (select band, max(line) + 1 as h from raw group by band) using (band)", "raw"))
def line_times(spark, sf_dir):
    """Odd bands scan backwards."""
    taken = lines(spark, sf_dir)
    tall = taken.groupBy("band").agg((F.max("line") + 1).alias("h"))
    taken = taken.join(F.broadcast(tall), "band")  # a row per band
    time = geometry.line_time_us(F.col("line"), F.lit(1e6), F.lit(500.0), F.col("h"), F.when(F.col("band") % 2 == 1, -1).otherwise(1))
    return taken.select("band", "line", time.alias("t_us"))


@query("state_linear", sql("select cast(line as bigint) as line, round(case when x1 is null or x0 = line then y0 when x0 is null then y1 else y0 + (y1 - y0) * ((line - x0) / (x1 - x0)) end, 9) as x from ln, useg where (x0 is null or x0 <= line) and (x1 is null or line < x1)", "ln", tele2="select x, arg_min(y, ord) as y from (select event_id as ord, (epoch_us(ts) - 1704153600000000) / cast(48384000000 as double) as x, value as y from events where event_type = 'view') group by x", pcs="select x as x0, y as y0, lead(x) over (order by x) as x1, lead(y) over (order by x) as y1, row_number() over (order by x) as n from tele2", useg="select x0, y0, x1, y1 from pcs union all select null, null, x0, y0 from pcs where n = 1"))
def state_linear(spark, sf_dir):
    """Platform states (here one coordinate of the telemetry) between samples; of samples at the same time the first counts."""
    unique = samples(spark, sf_dir).groupBy("scene", "x").agg(F.min_by("y", "ord").alias("y"))
    states = unique.select("scene", F.col("x").alias("t"), F.array("y").alias("state"))
    times = _lines_of_scene(spark, sf_dir).select("scene", F.col("line").cast("double").alias("t"))
    held = geometry.bracket(times, states, ["scene"])
    at = geometry.linear(F.col("s0"), F.col("s1"), geometry.fraction(F.col("t"), F.col("t0"), F.col("t1")))
    return held.select(F.col("t").cast("long").alias("line"), F.round(at[0], 9).alias("x"))


@query("scene_mask", sql("select line, col, case when b > 12 and r > 12 and n > 12 then 'cloud' when b < 8 and r < 8 and n < 8 then 'shadow' when n > 12 and b > 12 then 'glint' else 'clear' end as mask from (select line, col, max(case when band = 0 then dn end) / 100.0::double as b, max(case when band = 1 then dn end) / 100.0::double as r, max(case when band = 2 then dn end) / 100.0::double as n from px where band < 3 group by all) where b is not null and r is not null and n is not null", "px"))
def scene_mask(spark, sf_dir):
    px = calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"]).where("band < 3")
    side = px.groupBy("line", "col").pivot("band", [0, 1, 2]).agg(F.max("dn") / F.lit(100.0)).dropna()
    return side.select("line", "col", reflectance.scene_mask(F.col("0"), F.col("1"), F.col("2"), 12.0, 8.0).alias("mask"))


@query("destripe_columns", sql("select px.band, line, px.col, cast(floor((dn + bm - cm) * 1000000 + 0.25) as bigint) as dn_millionths from px join (select band, col, avg(dn::double) as cm from px group by all) c on px.band = c.band and px.col = c.col join (select band, avg(dn::double) as bm from px group by all) b on px.band = b.band", "px"))
def destripe_columns(spark, sf_dir):
    px = calibration.to_pixels(band_lines(spark, sf_dir), ["band", "line"]).select("band", "line", "col", F.col("dn").cast("double").alias("dn"))
    # the quarter keeps halves, on which engines round differently, off the edge
    return raw_lines.destripe(px, ["band"], "dn").select("band", "line", "col", F.floor(F.col("dn") * 1_000_000 + F.lit(0.25)).alias("dn_millionths"))


# ---- documents of packages, and geometry ------------------------------------------------------------


@query("filter_ids_last", sql("select cast(s_nationkey as varchar) as package, 'B' || s_suppkey % 5 as band, cast(max(s_suppkey) as int) as band_id from supplier group by all"))
def filter_ids_last(spark, sf_dir):
    """Nations as packages, their suppliers as a filter document; of a band name that occurs twice, the last."""
    entry = F.struct("s_suppkey", F.concat(F.lit("B"), (F.col("s_suppkey") % 5).cast("string")).alias("name"), F.col("s_suppkey").cast("string").alias("id"))
    listed = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").cast("string").alias("package")).agg(F.array_sort(F.collect_list(entry)).alias("f"))
    text = F.to_json(F.transform("f", lambda f: F.struct(f["name"].alias("name"), f["id"].alias("id"))))
    return package.filter_ids(listed.select("package", F.lit("calibration").alias("place"), F.lit("filters_1.json").alias("name"), text.alias("text")))


IDENTITY = "select cast(s_suppkey as varchar) as package, 'S' || s_suppkey as scene_id, case when s_suppkey % 3 = 0 then '1970-01-01T00:00:' || lpad(cast(s_suppkey % 60 as varchar), 2, '0') || 'Z' else '1970-01-02T00:00:' || lpad(cast(s_suppkey % 60 as varchar), 2, '0') || 'Z' end as acquired_at, cast(case when s_suppkey % 3 = 0 then 0 else 86400000 end + s_suppkey % 60 * 1000 as double) as start_ms, s_suppkey / 10.0::double as offset_s, cast(s_suppkey + 100 as double) as line_period_us, '{\"_omitted\": true, \"count\": 2}' as scenes from supplier"


@query("scene_identity", sql(IDENTITY))
def scene_identity(spark, sf_dir):
    """Suppliers as packages: identity, time (the start where it is given), clock offset, first session, trimmed provenance."""
    key = F.col("s_suppkey")
    second = F.concat(F.lpad((key % 60).cast("string"), 2, "0"), F.lit("Z"))
    start = F.when(key % 3 == 0, F.lit("")).otherwise(F.concat(F.lit("1970-01-02T00:00:"), second))
    properties = F.struct(start.alias("start_datetime"), F.concat(F.lit("1970-01-01T00:00:"), second).alias("datetime"), (key / 10).cast("string").alias("v:time_sync_offset"))
    item = F.to_json(F.struct(F.lit("1.1.0").alias("stac_version"), F.concat(F.lit("S"), key.cast("string")).alias("id"), properties.alias("properties")))
    one = lambda value: F.array(F.lit(value))
    configuration = F.struct(
        (key + 100).alias("LinePeriod"), F.lit(1).alias("SpectralBands"), one(4).alias("BandSetup"), one(0).alias("BandStartRow"), one(665.0).alias("BandCWL"), F.lit(1).alias("ScanDirection"), F.lit(0).alias("BinningFactor")
    )
    session = F.struct(configuration.alias("ImagerConfiguration"), F.struct(F.lit(1).alias("a"), F.lit(2).alias("b")).alias("Scenes"))
    meta = F.to_json(F.struct(F.struct(session.alias("z"), F.struct(F.lit(0).alias("none")).alias("a")).alias("Sessions")))
    files = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), text.alias("text")) for name, text in (("item.json", item), ("metadata.json", meta))]))
    docs = table(spark, sf_dir, "supplier").select(key.cast("string").alias("package"), F.lit("root").alias("place"), files.alias("f")).select("package", "place", "f.*")
    return package.scenes(docs).select("package", "scene_id", "acquired_at", "start_ms", "offset_s", "line_period_us", F.col("metadata")["Scenes"].alias("scenes"))


HERMITE = "select l_orderkey, l_linenumber, round((2 * u ** 3 - 3 * u ** 2 + 1) * p0 + (3 * u ** 2 - 2 * u ** 3) * p1 + ((u ** 3 - 2 * u ** 2 + u) * v0 + (u ** 3 - u ** 2) * v1) * 10, 6) as x from (select *, l_quantity::double as p0, l_extendedprice::double / 1000 as p1, l_tax::double as v0, l_discount::double as v1, l_discount::double * 10 as u from lineitem)"


@query("state_hermite", sql(HERMITE))
def state_hermite(spark, sf_dir):
    """Positions between states with velocities, ten seconds apart; line items as pairs of states."""
    real = lambda name: F.col(name).cast("double")
    x = geometry.hermite(F.array(real("l_quantity")), F.array(real("l_tax")), F.array(real("l_extendedprice") / 1000), F.array(real("l_discount")), real("l_discount") * 10, F.lit(10.0))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(x[0], 6).alias("x"))


def _turn(angle):
    """The attitude turned by an angle about the third axis."""
    return F.array(F.lit(0.0), F.lit(0.0), F.sin(angle / 2), F.cos(angle / 2))


TURNED = "select *, l_discount::double as a, l_discount::double + 0.5 + l_tax::double as b, l_quantity::double / 50 as u from lineitem"


@query("attitude_slerp", sql("select l_orderkey, l_linenumber, round(sin((a + (b - a) * u) / 2), 9) as z, round(cos((a + (b - a) * u) / 2), 9) as w from t", t=TURNED))
def attitude_slerp(spark, sf_dir):
    """Attitudes about one axis, of which the angles are interpolated."""
    start = F.col("l_discount").cast("double")
    found = geometry.slerp(_turn(start), _turn(start + 0.5 + F.col("l_tax").cast("double")), F.col("l_quantity").cast("double") / 50)
    turned = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", found.alias("q"))
    return turned.select("l_orderkey", "l_linenumber", F.round(F.col("q")[2], 9).alias("z"), F.round(F.col("q")[3], 9).alias("w"))


RAY = "select l_orderkey, l_linenumber, round((x * cos(a) - y * sin(a)) / n, 9) as x, round((x * sin(a) + y * cos(a)) / n, 9) as y, round(2 / n, 9) as z from (select *, sqrt(x * x + y * y + 4) as n from (select *, l_linenumber * 0.01::double as y, (l_quantity::double - 25) * 0.01::double as x from t))"


@query("viewing_rays", sql(RAY, t=TURNED))
def viewing_rays(spark, sf_dir):
    """Rays of detector pixels on a platform turned about its viewing axis."""
    straight = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)]) for i in range(3)])
    ray = geometry.viewing_ray(F.col("l_quantity").cast("double"), F.col("l_linenumber").cast("double"), F.lit(25.0), F.lit(0.01), F.lit(2.0), straight, _turn(F.col("l_discount").cast("double")))
    seen = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ray.alias("ray"))
    return seen.select("l_orderkey", "l_linenumber", *[F.round(F.col("ray")[i], 9).alias(c) for i, c in enumerate("xyz")])
