"""Regions and shadows against flood fill, sensor profiles against plain arithmetic, and parallel file assembly."""

import types

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.functions import profiles
from rasterloom.operators import regions
from rasterloom.sinks import tiff as sink
from rasterloom.sources import tiff


def flooded(mask, diagonal):
    """The first pixel (line, column) of each pixel's region."""
    out = {}
    steps = [(a, b) for a in (-1, 0, 1) for b in (-1, 0, 1) if (a, b) != (0, 0) and (diagonal or a == 0 or b == 0)]
    for i, j in zip(*np.nonzero(mask), strict=True):
        if (i, j) in out:
            continue
        queue = [(i, j)]
        out[i, j] = (i, j)
        while queue:
            y, x = queue.pop()
            for a, b in steps:
                p = (y + a, x + b)
                if 0 <= p[0] < mask.shape[0] and 0 <= p[1] < mask.shape[1] and mask[p] and p not in out:
                    out[p] = (i, j)
                    queue.append(p)
    return out


def snake(height, width):
    """One region that passes every edge of a strip several times."""
    mask = np.zeros((height, width), dtype=bool)
    mask[:, ::4] = True
    mask[0, 1::8] = mask[0, 2::8] = mask[0, 3::8] = True
    mask[-1, 5::8] = mask[-1, 6::8] = mask[-1, 7::8] = True
    return mask


MASKS = {"sparse": np.random.default_rng(0).random((50, 40)) < 0.35, "dense": np.random.default_rng(1).random((50, 40)) < 0.6, "snake": snake(37, 41), "full": np.ones((20, 600), dtype=bool), "empty": np.zeros((9, 9), dtype=bool)}


@pytest.mark.parametrize("diagonal", [False, True])
@pytest.mark.parametrize("strip", [1, 7])
def test_regions_equal_flood_fill(spark, diagonal, strip):
    rows = [(name, i, row.tolist()) for name, mask in MASKS.items() for i, row in enumerate(mask)]
    lines = spark.createDataFrame([*rows, ("empty", 9, None), ("empty", 10, []), ("empty", 11, [None, False])], "k string, line int, mask array<boolean>")
    found = regions.label(regions.runs(lines, ["k"]), ["k"], diagonal=diagonal, strip=strip).collect()
    got = {(r["k"], r["line"], c): (r["region"]["line"], r["region"]["start"]) for r in found for c in range(r["start"], r["stop"])}
    assert got == {(name, i, j): first for name, mask in MASKS.items() for (i, j), first in flooded(mask, diagonal).items()}


def test_sizes_and_small_regions(spark):
    mask = np.zeros((12, 9), dtype=bool)
    mask[2:9, 3:6] = True
    mask[0, 0] = mask[11, 8] = True
    lines = spark.createDataFrame([(1, i, row.tolist()) for i, row in enumerate(mask)], "k int, line int, mask array<boolean>")
    labelled = regions.label(regions.runs(lines, ["k"]), ["k"], strip=4)
    sizes = {r["pixels"]: r for r in regions.measure(labelled, ["k"]).collect()}
    assert sizes.keys() == {1, 21}
    assert tuple(sizes[21][c] for c in ("top", "bottom", "left", "right", "mid_line", "mid_col")) == (2, 8, 3, 5, 5.0, 4.0)
    assert regions.large(labelled, ["k"], 2).count() == 7
    assert regions.label(regions.runs(lines.where("false"), ["k"]), ["k"]).count() == 0


def test_shadows_fall_away_from_the_sun(spark):
    dy, dx = regions.shadow_step(F.lit(180.0), F.lit(45.0), F.lit(10.0))  # the sun in the south
    row = spark.range(1).select(dy.alias("dy"), dx.alias("dx")).first()
    assert row["dy"] == pytest.approx(-0.1) and row["dx"] == pytest.approx(0.0)
    runs = spark.createDataFrame([(1, 10, 3, 6), (1, 0, 0, 2), (1, 10, 7, 8)], "k int, line long, start int, stop int")
    thrown = regions.cast_shadows(runs, ["k"], (F.lit(-0.1), F.lit(0.05)), 10, 40, step=10, height=F.lit(12), width=F.lit(9))
    got = {(r["line"], c) for r in thrown.collect() for c in range(r["start"], r["stop"])}
    want = set()
    for line, start, stop in ((10, 3, 6), (0, 0, 2), (10, 7, 8)):
        for m in (10, 20, 30, 40):
            y, by = line + int(np.floor(-0.1 * m + 0.5)), int(np.floor(0.05 * m + 0.5))
            want |= {(y, c + by) for c in range(start, stop) if 0 <= y < 12 and 0 <= c + by < 9}
    assert got == want
    joined = sorted(tuple(r) for r in regions.united(spark.createDataFrame([(1, 0, 5, 7), (1, 0, 0, 2), (1, 0, 2, 3), (1, 0, 6, 9)], "k int, line long, start int, stop int"), ["k"]).collect())
    assert joined == [(1, 0, 0, 3), (1, 0, 5, 9)]
    with pytest.raises(ValueError, match="heights"):
        regions.cast_shadows(runs, ["k"], (dy, dx), 40, 10, step=10, height=F.lit(1), width=F.lit(1))


# ---- profiles -------------------------------------------------------------------------

SENSORS = [
    profiles.Profile("a", "linear_thermal", ("band", "tdi"), {"intercept": "thermal_intercept", "gradient": "thermal_gradient"}),
    profiles.Profile("b", "table", ("band",), {"counts": "x", "radiances": "y"}, fill=-5.0),
]


def test_sensors_with_different_models_in_one_table(spark):
    columns = [(0, "R", 4, 2.0, 100.0, [1.0, 2.0, 0.5], [10.0, 0.0, 4.0], [1.0, 0.0, 2.0]), (1, "R", 4, 9.0, None, [9.0] * 3, [9.0] * 3, [9.0] * 3)]
    cpf = spark.createDataFrame(columns, "ord int, band string, tdi int, absolute double, absolute_offset double, non_uniformity array<double>, thermal_intercept array<double>, thermal_gradient array<double>")
    entries = profiles.container(cpf).withColumn("sensor", F.lit("a"))
    assert {len(r["coefficients"]) for r in entries.collect()} == {5, 4}
    other = spark.createDataFrame([(0, "R", 8, {"x": [0.0, 100.0, 200.0], "y": [0.0, 1.0, 5.0]}, "b")], "ord int, band string, tdi int, coefficients map<string,array<double>>, sensor string")
    bands = spark.createDataFrame([("a", "R", 4), ("b", "R", 4), ("a", "X", 4)], "sensor string, band string, tdi int")
    table = profiles.profile_table(spark, SENSORS)
    found = profiles.look_up(bands, entries.unionByName(other), table)
    known = {(r["sensor"], r["band"]): r for r in found.collect()}
    assert known["a", "X"]["coefficients"] is None and known["a", "R"]["coefficients"]["absolute"] == [2.0] and known["b", "R"]["model"] == "table"
    lines = spark.createDataFrame([("a", 1, [200, 150, 120]), ("b", 1, [0, 150, 500]), ("a", 2, [300, 0, 130]), ("b", 2, [50, 100, 7])], "sensor string, line int, dn array<int>")
    whole = lines.join(found.where("band = 'R'"), "sensor").withColumn("t", F.col("line").cast("float")).withColumn("nodata", F.lit(0.0))
    got = {(r["sensor"], r["line"]): r["radiance"] for r in profiles.calibrate_lines(whole, ["sensor", "band"]).collect()}
    assert got["a", 1] == [478.0, 700.0, 214.0] and got["a", 2][0] == 676.0 and np.isnan(got["a", 2][1])
    assert got["b", 1] == [-5.0, 3.0, 5.0] and got["b", 2] == pytest.approx([0.5, 1.0, 0.07])


def test_profiles_are_checked(spark):
    with pytest.raises(KeyError, match="no such models"):
        profiles.profile_table(spark, [profiles.Profile("a", "magic")])
    bands = spark.createDataFrame([("z", "R")], "sensor string, band string")
    entries = spark.createDataFrame([], "ord int, band string, coefficients map<string,array<double>>, sensor string")
    with pytest.raises(Exception, match="no profile for sensor z"):
        profiles.look_up(bands, entries, profiles.profile_table(spark, SENSORS)).collect()
    none = spark.createDataFrame([("b", 1, [1], 0.0, None, "table", {"a": [1.0]}, {"counts": "x"}, 0.0)], "sensor string, line int, dn array<int>, t double, nodata double, model string, coefficients map<string,array<double>>, parameters map<string,string>, fill double")
    with pytest.raises(Exception, match="coefficients lack"):
        profiles.calibrate_lines(none, ["sensor"]).collect()


# ---- assembly of files ------------------------------------------------------------------


def test_a_band_is_written_by_many_tasks_as_by_one(spark, tmp_path):
    values = np.random.default_rng(0).normal(size=(1300, 1100)).astype(np.float32)
    lines = spark.createDataFrame([("R", i, *values.shape, r.tolist()) for i, r in enumerate(values)], "band string, line int, height int, width int, radiance array<float>")
    (path,) = [r["path"] for r in sink.write_tiff(lines, str(tmp_path / "out")).collect()]
    data = (tmp_path / "out" / "R.tif").read_bytes()
    assert sorted(x.name for x in (tmp_path / "out").iterdir()) == ["R.tif"]
    with open(path, "rb") as f:
        h = tiff.read_header(f)
        np.testing.assert_array_equal(tiff.read_lines(f, h, 0, h.height), values)
    # the same bytes, in order, by one task, and in disorder twice by two
    pieces = [types.SimpleNamespace(path=f"{tmp_path}/one.tif", at=a, data=data[a : a + 5000]) for a in range(0, len(data), 5000)]
    for job, put in (("x", "_in_order"), ("y", "_anywhere")):
        writer = sink.TileWriter(str(tmp_path), job)
        system, scratch = tiff.file_system(writer.scratch)
        system.create_dir(scratch)
        given = pieces if put == "_in_order" else [*pieces[::-2], *pieces[::2], *pieces[::-1]]
        if put == "_in_order":
            real, pyspark_task = sink.TaskContext, types.SimpleNamespace(partitionId=lambda: 0, taskAttemptId=lambda: 1)
            sink.TaskContext = types.SimpleNamespace(get=lambda: pyspark_task)
            try:
                with pytest.raises(ValueError, match="in order"):
                    getattr(writer, put)(iter(given[1:]), system, scratch)
                files = getattr(writer, put)(iter(given), system, scratch)
            finally:
                sink.TaskContext = real
        else:
            files = getattr(writer, put)(iter(given), system, scratch)
        other = sink.TileWriter(str(tmp_path), "other")
        other.abort([])  # another write's end leaves this one alone
        writer.commit([sink.Written(files), None])
        assert (tmp_path / "one.tif").read_bytes() == data
        assert not (tmp_path / f"_writing-{job}").exists()
