"""Acquisition packages as DataFrames.

A package is a folder with a catalogue item, `metadata.json`, rasters, and a
`calibration` folder. One call reads any number of packages below a root: the
documents are one scan, and every table that comes out is keyed by `package`,
so a thousand packages cost the same few jobs as one. Document order matters
in several rules, so JSON objects are read as maps, which keep it.
"""

from __future__ import annotations

from dataclasses import dataclass, fields
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import nan, optional_double
from ..operators import interpolation, timing

MAP = "map<string,string>"
CONFIGURATION = (
    "LinePeriod double, SpectralBands int, BandSetup array<int>, BandStartRow array<int>, BandCWL array<double>, ScanDirection int, BinningFactor int"
)
RADIOMETRIC = "band string, row int, tdi int, absolute double, absolute_offset string, coefficients array<array<double>>, polynomial array<double>, UUID string"


@dataclass(frozen=True)
class Packages:
    """Tables of all packages: scenes, bands, entries (calibration), samples (telemetry with line positions)."""

    scenes: DataFrame
    bands: DataFrame
    unmatched: DataFrame
    entries: DataFrame
    samples: DataFrame


def documents(spark: SparkSession, root: str, calibration: str = "calibration") -> DataFrame:
    """(package, place, name, text): every JSON document; text is null where it is not UTF-8."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").option("recursiveFileLookup", True).load(root)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(root) from error
        raise
    pattern = rf"^(.*?)(/{calibration})?/([^/]+)$"
    return files.select(
        F.regexp_extract("path", pattern, 1).alias("package"),
        F.when(F.regexp_extract("path", pattern, 2) == "", "root").otherwise("calibration").alias("place"),
        F.regexp_extract("path", pattern, 3).alias("name"),
        F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
    )


def raster_files(spark: SparkSession, root: str) -> DataFrame:
    """(package, path, name) of the files that a raster glob finds; contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.tif*").option("recursiveFileLookup", True).load(root)
    return files.select(F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("package"), "path", F.regexp_extract("path", r"([^/]+)$", 1).alias("name"))


def _object(text: Column) -> Column:
    """A JSON object as an ordered map; null for anything else, malformed text included."""
    return F.from_json(text, MAP, {"mode": "PERMISSIVE"})


def _first(rows: DataFrame, by: str = "name") -> DataFrame:
    """The first document of each package, in name order."""
    return rows.groupBy("package").agg(F.min_by(F.struct(*rows.columns), by).alias("d")).select("d.*")


def _need(value: Column, message: str, kind: str) -> Column:
    return F.when(value.isNotNull(), value).otherwise(F.raise_error(F.lit(message)).cast(kind))


def catalogue_items(docs: DataFrame) -> DataFrame:
    """(package, item map): the first root document that is an object with a `stac_version`."""
    items = docs.where("place = 'root'").withColumn("item", _object(F.col("text"))).where(F.map_contains_key("item", F.lit("stac_version")))
    return _first(items.select("package", "name", "item")).select("package", "item")


def scenes(docs: DataFrame) -> DataFrame:
    """One row per package: identity, session, imager configuration, clock inputs, provenance."""
    meta = docs.where("place = 'root' and name = 'metadata.json'").withColumn("m", _object(F.col("text")))
    sessions = F.map_entries(_object(F.col("m")["Sessions"]))
    meta = meta.select("package", _object(F.get(sessions, F.lit(0))["value"]).alias("session"))
    extra = docs.where("place = 'root' and name = 'ancillary.json'").select("package", F.when(F.is_valid_utf8("text") & F.try_parse_json("text").isNotNull(), F.col("text")).alias("ancillary"))
    everything = docs.select("package").distinct().join(catalogue_items(docs), "package", "left").join(meta, "package", "left").join(extra, "package", "left")
    properties = F.coalesce(_object(F.col("item")["properties"]), F.create_map().cast(MAP))
    everything = everything.withColumn("properties", properties).withColumn("session", _need(F.col("session"), "metadata.json is missing or has no Sessions block", MAP))
    configuration = F.from_json(F.col("session")["ImagerConfiguration"], CONFIGURATION, {"mode": "PERMISSIVE"})
    everything = everything.withColumn("c", configuration)
    whole = reduce(lambda a, b: a & b, [F.col(f"c.{n.split()[0]}").isNotNull() for n in CONFIGURATION.split(", ")])
    offsets = F.filter(F.map_entries("properties"), lambda e: F.endswith(e["key"], F.lit("time_sync_offset")))
    kept = F.map_filter("session", lambda k, v: k != "Scenes")
    count = F.when(F.startswith(F.ltrim(F.col("session")["Scenes"]), F.lit("{")), F.size(_object(F.col("session")["Scenes"])))
    summary = F.when(count.isNull(), kept).otherwise(F.map_concat(kept, F.create_map(F.lit("Scenes"), F.concat(F.lit('{"_omitted": true, "count": '), count.cast("string"), F.lit("}")))))
    acquired = F.coalesce(F.nullif(F.col("properties")["start_datetime"], F.lit("")), F.col("properties")["datetime"])
    return everything.select(
        "package", F.coalesce(F.col("item")["id"], F.lit("unknown")).alias("scene_id"), acquired.alias("acquired_at"), timing.epoch_ms(acquired).alias("start_ms"),
        F.coalesce(F.get(offsets, F.lit(0))["value"].try_cast("double"), F.lit(0.0)).alias("offset_s"),
        F.when(whole, F.col("c.LinePeriod")).otherwise(F.raise_error(F.lit("an imager configuration key is missing")).cast("double")).alias("line_period_us"),
        F.col("c.SpectralBands").alias("spectral_bands"), F.col("c.BandSetup").alias("band_setup"), F.col("c.BandStartRow").alias("band_start_row"), F.col("c.BandCWL").alias("band_cwl"),
        F.col("c.ScanDirection").alias("scan_direction"), F.col("c.BinningFactor").alias("binning_factor"),
        F.col("item")["assets"].alias("assets"), "session", F.coalesce("ancillary", F.lit("{}")).alias("ancillary"), summary.alias("metadata"),
    )


def calibration_entries(docs: DataFrame) -> DataFrame:
    """(package, ord, band, start_row, tdi, absolute, absolute_offset, arrays, uuid, geometric) of the first CPF document; malformed text is an error."""
    first = _first(docs.where("place = 'calibration' and name like 'CPF%.json'").select("package", "name", "text"))
    parsed = first.withColumn("d", F.from_json("text", f"radiometric array<struct<{RADIOMETRIC.replace(' ', ':').replace(',:', ', ')}>>, geometric string", {"mode": "FAILFAST"}))
    rows = parsed.select("package", F.col("d.geometric").alias("geometric"), F.posexplode("d.radiometric").alias("ord", "e"))
    return rows.select(
        "package", "ord", "e.band", F.col("e.row").alias("start_row"), "e.tdi", "e.absolute", optional_double(F.col("e.absolute_offset")).alias("absolute_offset"),
        F.element_at("e.coefficients", 1).alias("non_uniformity"), F.element_at("e.coefficients", 2).alias("thermal_intercept"), F.element_at("e.coefficients", 3).alias("thermal_gradient"),
        "e.polynomial", F.col("e.UUID").alias("uuid"), "geometric",
    )


def filter_ids(docs: DataFrame) -> DataFrame:
    """(package, band, band_id): the detector of each band name; of a name that occurs twice, the last."""
    first = _first(docs.where("place = 'calibration' and name like 'filters%.json'").select("package", "name", "text"))
    rows = first.select("package", F.posexplode(F.from_json("text", "array<struct<name:string,id:string>>", {"mode": "FAILFAST"})).alias("ord", "f"))
    return rows.groupBy("package", F.col("f.name").alias("band")).agg(F.max_by(F.col("f.id").cast("double").cast("int"), "ord").alias("band_id"))


def require_calibration(docs: DataFrame, patterns: tuple[str, ...] = ("CPF%.json", "filters%.json")) -> None:
    """An error for packages that lack a calibration document; only their names reach the driver."""
    has = [F.max(F.when(F.expr(f"place = 'calibration' and name like '{p}'"), 1)).isNotNull().alias(f"p{i}") for i, p in enumerate(patterns)]
    lacking = docs.groupBy("package").agg(*has).where(" or ".join(f"not p{i}" for i in range(len(patterns)))).limit(5).collect()
    if lacking:
        raise FileNotFoundError(f"no calibration file like {' and '.join(patterns)} in " + ", ".join(r["package"] for r in lacking))


def raster_paths(scene: DataFrame, files: DataFrame) -> DataFrame:
    """(package, ord, band, path) of the rasters that exist: the item's TIFF assets, or, where it has none, all files of the glob by stem."""
    assets = scene.select("package", F.posexplode(F.map_entries(F.from_json("assets", f"map<string,{MAP}>"))).alias("ord", "a"))
    tiffs = assets.where(F.contains(F.lower(F.coalesce(F.col("a.value")["type"], F.lit(""))), F.lit("tiff")))
    tiffs = tiffs.select("package", "ord", F.col("a.key").alias("band"), F.concat("package", F.lit("/"), F.regexp_replace(F.col("a.value")["href"], r"^\./", "")).alias("path"))
    named = tiffs.join(files.select("path"), "path").select("package", "ord", "band", "path")
    order = F.row_number().over(Window.partitionBy("package").orderBy("name")) - 1
    loose = files.join(tiffs.select("package").distinct(), "package", "left_anti").select("package", order.alias("ord"), F.regexp_replace("name", r"\.[^.]*$", "").alias("band"), "path")
    return named.unionByName(loose)


def band_catalogue(paths: DataFrame, filters: DataFrame, scene: DataFrame, headers: DataFrame) -> DataFrame:
    """Bands with detector, setting, wavelength and raster header, in detector order.

    A wavelength list that ends early gives NaN; a setting or start row that
    is not there, and a negative detector, are errors.
    """
    known = paths.join(filters, ["package", "band"]).join(scene.select("package", "band_setup", "band_start_row", "band_cwl"), "package").join(headers, "path")
    ident = F.when(F.col("band_id") >= 0, F.col("band_id")).otherwise(F.raise_error(F.lit("negative detector id")).cast("int"))
    return known.withColumn("band_id", ident).select(
        "package", "band", "band_id", F.coalesce(F.get("band_cwl", F.col("band_id")), nan("double")).alias("cwl_nm"), "path", "width", "height", "dtype", "nodata", "ord",
        F.element_at("band_start_row", F.col("band_id") + 1).alias("start_row"), F.element_at("band_setup", F.col("band_id") + 1).alias("tdi"),
    ).orderBy("package", "band_id", "ord")


def telemetry(scene: DataFrame) -> DataFrame:
    """(package, ord, y, imager_time): temperatures in document order; an entry without the key is dropped, one with null is kept as NaN."""
    rows = scene.select("package", F.posexplode(F.from_json(F.col("session")["ImagerTelemetry"], "array<string>")).alias("ord", "e")).withColumn("e", _object(F.col("e")))
    rows = rows.where(F.map_contains_key("e", F.lit("SensorTemperature")))
    return rows.select("package", "ord", F.coalesce(F.col("e")["SensorTemperature"].cast("double"), nan("double")).alias("y"), F.col("e")["ImagerTime"].cast("double").alias("imager_time"))


def anchors(scene: DataFrame) -> DataFrame:
    rows = scene.select("package", F.posexplode(F.from_json(F.col("session")["TimeSync"], "array<string>")).alias("ord", "e")).withColumn("e", _object(F.col("e")))
    entries = rows.select("package", "ord", F.col("e")["TimeFormat"].try_cast("double").alias("time_format"), F.col("e")["ImagerTime"].alias("imager_time"), F.col("e")["PlatformTime"].alias("platform_time"))
    return timing.first_anchor(entries, ["package"])


def timed_samples(scene: DataFrame) -> DataFrame:
    """Telemetry with `sample_line`, null where a scene's clocks cannot be aligned."""
    clocks = scene.select("package", "start_ms", "offset_s", "line_period_us").join(anchors(scene), "package", "left")
    return timing.sample_lines(telemetry(scene), clocks, ["package"]).select("package", "ord", "y", "n_missing", "sample_line")


def read_packages(spark: SparkSession, root: str, *, calibration: str = "calibration") -> Packages:
    """All packages below `root` (or the one that `root` is)."""
    from .tiff import headers

    docs = documents(spark, root, calibration)
    require_calibration(docs)
    scene, files = scenes(docs), raster_files(spark, root)
    paths, filters = raster_paths(scene, files), filter_ids(docs)
    unmatched = paths.join(filters, ["package", "band"], "left_anti")
    bands = band_catalogue(paths, filters, scene, headers(paths))
    return Packages(scene, bands, unmatched, calibration_entries(docs), timed_samples(scene))


def kept(packages: Packages) -> Packages:
    """The same tables, held by Spark once they are worked out, as several steps ask for each; `release` lets them go."""
    return Packages(**{f.name: getattr(packages, f.name).persist() for f in fields(packages)})


def release(packages: Packages) -> None:
    for f in fields(packages):
        getattr(packages, f.name).unpersist()


def band_positions(samples: DataFrame, bands: DataFrame) -> DataFrame:
    """(package, band, samples): sorted sample arrays per band; a scene without positions is spread evenly over each band's lines."""
    timed = samples.withColumn("timed", F.min(F.col("sample_line").isNotNull()).over(Window.partitionBy("package")))
    spread = timed.join(bands.select("package", "band", "height"), "package")
    spaced = interpolation.uniform_positions(spread, F.col("height"), ["package", "band"])
    placed = spaced.withColumn("x", F.when(F.col("timed"), F.col("sample_line")).otherwise(F.col("x")))
    return interpolation.sample_array(placed, ["package", "band"])
