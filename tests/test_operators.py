"""Operators on the small fixtures, against values worked out by hand or by numpy."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import columns, models
from rasterloom.operators import calibration, geometry, interpolation, ordered, preview, quality, raw_lines, reflectance, timing

NAN, INF = float("nan"), float("inf")


def profile(spark, temperatures, positions, height):
    rows = [("s", i, float(y), None if positions is None else float(positions[i])) for i, y in enumerate(temperatures)]
    samples = spark.createDataFrame(rows, "scene string, ord int, y double, x double")
    if positions is None:
        samples = interpolation.uniform_positions(samples, F.lit(height), ["scene"])
    lines = spark.range(height).select(F.lit("s").alias("scene"), F.col("id").alias("line"))
    held = lines.join(interpolation.sample_array(samples, ["scene"]), "scene")
    forms = [
        held.select("line", interpolation.by_array(F.col("line"), F.col("samples")).alias("t")),
        interpolation.by_segments(lines, samples, ["scene"]),
        interpolation.by_window(lines, samples, ["scene"]),
    ]
    found = [[r["t"] for r in f.orderBy("line").collect()] for f in forms]
    assert found[0] == found[1] == found[2]
    return found[0]


def test_profiles(spark):
    assert profile(spark, [0, 10], None, 11) == list(range(11))
    assert profile(spark, [0, 10], [0, 5], 11) == [0, 2, 4, 6, 8] + [10] * 6
    assert profile(spark, [5], None, 7) == [5] * 7
    assert profile(spark, [5, 7], None, 1) == [7.0]  # both samples at line 0: the later one holds from there


@pytest.mark.parametrize("seed", range(3))
def test_profiles_equal_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    x = np.sort(rng.uniform(-5, 45, 9)).round(seed)
    y = rng.normal(20, 5, 9)
    x = np.unique(x)
    y = y[: len(x)]
    assert profile(spark, y, x, 40) == np.interp(np.arange(40), x, y).astype(np.float32).tolist()


FIXTURE = "line int, dn array<int>, t float, nodata double, absolute double, absolute_offset double, non_uniformity array<double>, thermal_intercept array<double>, thermal_gradient array<double>, height int"
BLOCK = [[100, 100, 100], [200, 150, 120], [300, 250, 130], [400, 350, 140]]
EXPECTED = [[280, 500, 196], [478, 700, 214], [676, 1100, 222], [874, 1500, 230]]


def fixture(spark, block, nodata=0.0, nu=(1.0, 2.0, 0.5)):
    rows = [(i, dn, float(i), nodata, 2.0, 100.0, list(nu), [10.0, 0.0, 4.0], [1.0, 0.0, 2.0], 4) for i, dn in enumerate(block)]
    return spark.createDataFrame(rows, FIXTURE)


def test_formula_in_both_forms(spark):
    lines = calibration.check_lines(fixture(spark, BLOCK))
    assert [r["radiance"] for r in calibration.calibrate_lines(lines).orderBy("line").collect()] == EXPECTED
    px = calibration.calibrate_pixels(calibration.to_pixels(lines, ["line", "t", "nodata", "absolute", "absolute_offset"]))
    assert [r["radiance"] for r in px.orderBy("line", "col").collect()] == sum(EXPECTED, [])
    assert px.schema["radiance"].dataType.simpleString() == "float"


def test_lines_are_independent(spark):
    block = np.arange(1, 13).reshape(4, 3).tolist()
    whole = calibration.calibrate_lines(fixture(spark, block))
    halves = [whole.where("line < 2"), whole.where("line >= 2")]
    assert sum([[r["radiance"] for r in h.orderBy("line").collect()] for h in halves], []) == [r["radiance"] for r in whole.orderBy("line").collect()]


def test_nodata(spark):
    block = [[0, 5, 5], [5, 5, 0], [5, 5, 5], [5, 5, 5]]
    found = [r["radiance"] for r in calibration.calibrate_lines(fixture(spark, block)).orderBy("line").collect()]
    assert [[math.isnan(x) for x in r] for r in found] == [[x == 0 for x in r] for r in block]
    none = [r["radiance"] for r in calibration.calibrate_lines(fixture(spark, block, None)).collect()]
    assert not any(math.isnan(x) for r in none for x in r)


def test_guards(spark):
    with pytest.raises(Exception, match="width"):
        calibration.check_lines(fixture(spark, [[1, 2]])).collect()
    with pytest.raises(Exception, match="outside"):
        calibration.check_lines(fixture(spark, [[1, 2, 3]] * 5)).collect()
    with pytest.raises(KeyError):
        calibration.calibrate_lines(fixture(spark, BLOCK), model="none")


def test_another_model_can_be_registered(spark):
    @models.register("doubled")
    def doubled(count, temperature, coefficients):
        return columns.real(count) * columns.real(2.0)

    found = calibration.calibrate_lines(fixture(spark, BLOCK), model="doubled").orderBy("line").first()
    assert found["radiance"] == [200.0, 200.0, 200.0]
    del models.MODELS["doubled"]


def test_polynomial_equals_numpy(spark):
    c = [3.0, 0.5, 0.25]
    lines = fixture(spark, BLOCK).withColumn("polynomial", F.array(*[F.lit(x) for x in c]))
    found = [r["radiance"] for r in calibration.calibrate_lines(lines, model="polynomial").orderBy("line").collect()]
    t = np.arange(4)[:, None]
    x = np.array(BLOCK) - (np.array([10, 0, 4]) + np.array([1, 0, 2]) * t)
    np.testing.assert_allclose(found, c[0] + c[1] * x + c[2] * x**2, rtol=1e-5)


def report(spark, values, thresholds=quality.Thresholds(), counts=None):
    rows = [("R", float(v), None if counts is None else counts[i]) for i, v in enumerate(values)]
    px = spark.createDataFrame(rows, "band string, radiance float, dn int")
    return quality.band_report(px if counts else px.drop("dn"), ["band"], thresholds).first()


@pytest.mark.parametrize(
    ("values", "flags"),
    [
        ([1.0, 2.0], []),
        ([NAN, NAN], ["all_invalid", "high_nodata"]),
        ([2.0, 2.0], ["zero_dynamic_range"]),
        ([1.0, 2.0, NAN, NAN], []),
        ([1.0, 2.0, NAN, NAN, NAN], ["high_nodata"]),
        ([-1.0] + [1.0] * 19, []),
        ([-1.0, -2.0] + [1.0] * 18, ["negative_radiance"]),
        ([1.0, 2.0, INF], ["non_finite_values"]),
        ([-INF, INF], ["all_invalid", "non_finite_values"]),
    ],
)
def test_flags(spark, values, flags):
    r = report(spark, values)
    assert r["flags"] == flags and r["passed"] == (not flags)
    good = np.array([v for v in values if math.isfinite(v)])
    assert r["valid"] == len(good) and r["pixels"] == len(values)
    if len(good):
        assert (r["min"], r["max"]) == (good.min(), good.max()) and r["std"] == pytest.approx(good.std())
    else:
        assert math.isnan(r["mean"]) and math.isnan(r["min"])


def test_saturation_counts_every_pixel(spark):
    r = report(spark, [1.0, NAN, 3.0], quality.Thresholds(saturation_dn=10), [9, 10, 11])
    assert r["saturated"] == 2 and r["flags"] == ["saturation"]
    assert "saturated" not in report(spark, [1.0, 2.0], counts=[99, 99]).asDict()


def test_verdict(spark):
    empty = spark.createDataFrame([], "band string, passed boolean")
    assert quality.verdict(empty).first()["passed"]
    two = spark.createDataFrame([("a", True), ("b", False)], "band string, passed boolean")
    assert not quality.verdict(two).first()["passed"]


def test_clock(spark):
    iso = spark.createDataFrame([("1970-01-01T00:00:00Z",), ("1970-01-01T00:00:01Z",), ("1970-01-01T00:00:01",), ("not-a-date",), (None,)], "s string")
    assert [r[0] for r in iso.select(timing.epoch_ms(F.col("s"))).collect()] == [0.0, 1000.0, 1000.0, None, None]
    samples = spark.createDataFrame([("s", 0, 1_000_000.0), ("s", 1, 1_000_500.0), ("s", 2, 1_001_000.0)], "scene string, ord int, imager_time double")
    scene = spark.createDataFrame([("s", 1_000_000.0, 1000.0, 1000.0, 0.0, 500.0)], "scene string, imager_us double, platform_ms double, start_ms double, offset_s double, line_period_us double")
    assert [r["sample_line"] for r in timing.sample_lines(samples, scene, ["scene"]).orderBy("ord").collect()] == [0.0, 1.0, 2.0]
    for gone in ("imager_us", "start_ms"):
        cut = scene.withColumn(gone, F.lit(None).cast("double"))
        assert {r["sample_line"] for r in timing.sample_lines(samples, cut, ["scene"]).collect()} == {None}


def test_optional_double(spark):
    df = spark.createDataFrame([(None,), ("2.5",), ("0",)], "x string")
    assert [r[0] for r in df.select(columns.optional_double(F.col("x"))).collect()] == [0.0, 2.5, 0.0]
    assert df.select(columns.optional_double(F.col("x"), 1.5)).first()[0] == 1.5
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("abc",)], "x string").select(columns.optional_double(F.col("x"))).collect()


def test_stretch_equals_numpy(spark):
    rng = np.random.default_rng(1)
    v = np.append(rng.normal(size=300), [NAN, INF])
    px = spark.createDataFrame([("R", i, 0, float(x)) for i, x in enumerate(v)], "band string, line int, col int, radiance double")
    lo, hi = np.percentile(v[np.isfinite(v)], [2, 98])
    found = preview.stretched(px, ["band"]).orderBy("line").select(columns.to_byte(F.col("level"))).collect()
    with np.errstate(invalid="ignore"):
        want = (np.clip(np.nan_to_num(np.clip((v - lo) / (hi - lo), 0, 1), nan=0.0), 0, 1) * 255).astype(np.uint8)
    assert [r[0] for r in found] == want.tolist()
    flat = px.withColumn("radiance", F.lit(4.0))
    assert {r["level"] for r in preview.stretched(flat, ["band"]).collect()} == {0.0}
    nothing = px.withColumn("radiance", F.lit(NAN))
    assert {r["level"] for r in preview.stretched(nothing, ["band"]).collect()} == {0.0}


def test_output_shape():
    assert preview.output_shape(30948, 4096, 2048) == (2048, 271)
    assert preview.output_shape(10, 5, 2048) == (10, 5)
    assert preview.output_shape(10_000, 1, 100) == (100, 1)


def test_rgb_stack_and_missing(spark):
    px = spark.createDataFrame([("R", 0, 0, 1.0), ("G", 0, 0, 0.5), ("B", 0, 0, NAN)], "band string, line int, col int, level double")
    assert tuple(preview.stack_rgb(px, []).first())[2:] == (255, 127, 0)
    assert preview.missing_bands(px.where("band <> 'G'")).first()["missing"] == ["G"]


def test_reflectance(spark):
    spectrum = spark.createDataFrame([(1, 2.0), (2, 4.0)], "wavelength int, irradiance double")
    response = spark.createDataFrame([("R", 1, 1.0), ("R", 2, 3.0), ("N", 1, 0.0)], "band string, wavelength int, response double")
    assert {r["band"]: r["esun"] for r in reflectance.solar_irradiance(spectrum, response, ["band"]).collect()} == {"R": 3500.0, "N": None}
    row = spark.range(1).select(
        reflectance.top_of_atmosphere(F.lit(100.0), F.lit(1500.0), F.lit(1.0), F.lit(60.0)).alias("toa"),
        reflectance.surface(F.lit(100.0), F.lit(0.01), F.lit(0.2), F.lit(0.1)).alias("surface"),
        reflectance.scene_mask(F.lit(0.5), F.lit(0.5), F.lit(0.5)).alias("mask"),
    ).first()
    assert row["toa"] == pytest.approx(math.pi * 100 / 750) and row["surface"] == pytest.approx(0.8 / 1.08) and row["mask"] == "cloud"


def test_destripe(spark):
    px = spark.createDataFrame([("R", i, c, float(i + 10 * c)) for i in range(3) for c in range(2)], "band string, line int, col int, radiance double")
    found = raw_lines.destripe(px, ["band"]).groupBy("col").agg(F.avg("radiance").alias("m")).collect()
    assert {r["m"] for r in found} == {6.0}


def test_geometry(spark):
    half = math.sqrt(0.5)
    arr = lambda *x: F.array(*map(F.lit, x))
    quarter, none = arr(0.0, 0.0, half, half), arr(0.0, 0.0, 0.0, 1.0)
    row = spark.range(1).select(
        geometry.rotate(quarter, arr(1.0, 0.0, 0.0)).alias("turned"),
        geometry.slerp(none, quarter, F.lit(0.5)).alias("eighth"),
        geometry.slerp(none, F.transform(quarter, lambda x: -x), F.lit(0.5)).alias("shorter"),
        geometry.slerp(none, none, F.lit(0.3)).alias("same"),
        geometry.hermite(arr(0.0), arr(1.0), arr(8.0), arr(12.0), F.lit(0.5), F.lit(2.0)).alias("cubic"),
        geometry.viewing_ray(F.lit(5), F.lit(0), F.lit(5), F.lit(1.0), F.lit(10.0), F.array(arr(1.0, 0.0, 0.0), arr(0.0, 1.0, 0.0), arr(0.0, 0.0, 1.0)), quarter).alias("ray"),
        geometry.line_time_us(F.lit(0), F.lit(10.0), F.lit(2.0), F.lit(4), F.lit(-1)).alias("backward"),
    ).first()
    assert row["turned"] == pytest.approx([0, 1, 0])
    assert row["eighth"] == pytest.approx([0, 0, math.sin(math.pi / 8), math.cos(math.pi / 8)]) == row["shorter"]
    assert row["same"] == [0, 0, 0, 1] and row["ray"] == pytest.approx([0, 0, 1]) and row["backward"] == 16.0
    assert row["cubic"] == pytest.approx([0.5 * 8 + 2 * (0.125 * 1 - 0.125 * 12)])  # the four weights at the middle


# ---- orders cut into ranges ---------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_interpolation_over_many_ranges_equals_arrays(spark, monkeypatch, seed):
    monkeypatch.setattr(interpolation, "SORTED", 4)
    monkeypatch.setattr(interpolation, "JOINED", 3)
    rng = random.Random(seed)
    samples = []
    for key, n in (("a", 1), ("b", 12), ("c", 40)):
        spread = [rng.choice([rng.uniform(-20, 70), float(rng.randint(-5, 60))]) for _ in range(n)]
        samples += [(key, i, float(x), rng.uniform(-9, 9)) for i, x in enumerate(spread)]
    samples += [("c", 40, samples[-1][2], 5.0), ("d", 0, 10.0, 1.0), ("d", 1, 900.0, 2.0)]  # a tie, and an empty stretch of many ranges
    lines = [(key, line) for key in "abcd" for line in range(0, 50, 1 if key != "d" else 7)]
    s, ln = spark.createDataFrame(samples, "k string, ord int, x double, y double"), spark.createDataFrame(lines, "k string, line int")
    want = ln.join(interpolation.sample_array(s, ["k"]), "k").select("k", "line", interpolation.by_array(F.col("line"), F.col("samples")).alias("t"))
    want = sorted(map(tuple, want.collect()))
    for form in (interpolation.by_window, interpolation.by_segments):
        assert sorted(tuple(r) for r in form(ln, s, ["k"]).select("k", "line", "t").collect()) == want


def test_places_and_brackets_over_many_ranges(spark):
    rows = [(k, o) for k in "ab" for o in random.Random(4).sample(range(-50, 90), 30 if k == "a" else 1)]
    placed = ordered.places(spark.createDataFrame(rows, "k string, o int"), ["k"], "o", count="n", span=7).collect()
    for k in "ab":
        own = sorted(r["o"] for r in placed if r["k"] == k)
        assert all((r["place"], r["n"]) == (own.index(r["o"]), len(own)) for r in placed if r["k"] == k)
    states = spark.createDataFrame([("a", float(t), [float(t)]) for t in (3, 4, 50)], "k string, t double, state array<double>")
    times = spark.createDataFrame([("a", float(t)) for t in (0, 3, 10, 49, 50, 99)], "k string, t double")
    for span in (2.0, 4096.0):
        found = {r["t"]: (r["t0"], r["t1"]) for r in geometry.bracket(times, states, ["k"], span=span).collect()}
        assert found == {0.0: (3.0, 3.0), 3.0: (3.0, 4.0), 10.0: (4.0, 50.0), 49.0: (4.0, 50.0), 50.0: (50.0, 50.0), 99.0: (50.0, 50.0)}


def test_attitudes_are_worked_out_once_a_row(spark):
    rng = np.random.default_rng(5)
    q = rng.normal(size=(2, 40, 4))
    q /= np.linalg.norm(q, axis=2, keepdims=True)
    rows = spark.createDataFrame([(i, a.tolist(), b.tolist(), float(u)) for i, (a, b, u) in enumerate(zip(*q, rng.random(40), strict=True))] + [(40, None, [0.0, 0.0, 0.0, 1.0], 0.5)], "i int, a array<double>, b array<double>, u double")
    eye = F.array(*[F.array(*[F.lit(float(i == j)) for j in range(3)]) for i in range(3)])
    turned = geometry.slerp(F.col("a"), F.col("b"), F.col("u"))
    ray = geometry.viewing_ray(F.col("i"), F.lit(1.0), F.lit(20.0), F.lit(0.01), F.lit(2.0), eye, F.transform("a", lambda x: F.cbrt(x * x * x)))
    found = rows.select("i", turned.alias("q"), ray.alias("ray"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ACOS") == 1 and plan.count("CBRT") == 1
    for r in sorted(found.collect())[:40]:
        a, b, u = q[0, r["i"]], q[1, r["i"]], rows.where(F.col("i") == r["i"]).first()["u"] if r["i"] < 3 else None
        assert np.linalg.norm(r["q"]) == pytest.approx(1) and np.linalg.norm(r["ray"]) == pytest.approx(1)
        if u is not None:
            b = b if a @ b >= 0 else -b
            angle = math.acos(a @ b)
            assert r["q"] == pytest.approx((a * math.sin((1 - u) * angle) + b * math.sin(u * angle)) / math.sin(angle))
    assert [r["q"] for r in found.collect() if r["i"] == 40] == [None]
