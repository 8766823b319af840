"""Rays on terrain, fits and warps against plain numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from rasterloom.operators import fit, terrain, warp

# ---- rays on terrain ----------------------------------------------------------------

GRID = terrain.Grid(45.0, 7.0, 0.02, cells=8)
NODES = 41


def ground_heights(seed=0):
    rng = np.random.default_rng(seed)
    x, y = np.meshgrid(np.arange(NODES), np.arange(NODES))
    return 900 + 700 * np.sin(x / 3.0) * np.cos(y / 4.0) + rng.uniform(0, 60, (NODES, NODES))


def surface(ground, lat, lon):
    u, v = (lat - GRID.south) / GRID.step, (lon - GRID.west) / GRID.step
    i, j = int(np.floor(u)), int(np.floor(v))
    if not (0 <= i < NODES - 1 and 0 <= j < NODES - 1):
        return np.nan
    a, b = u - i, v - j
    return (1 - a) * ((1 - b) * ground[i, j] + b * ground[i, j + 1]) + a * ((1 - b) * ground[i + 1, j] + b * ground[i + 1, j + 1])


def point(lat, lon, height):
    e2 = 1 - (terrain.POLAR / terrain.EQUATORIAL) ** 2
    p, q = np.radians(lat), np.radians(lon)
    n = terrain.EQUATORIAL / np.sqrt(1 - e2 * np.sin(p) ** 2)
    return np.array([(n + height) * np.cos(p) * np.cos(q), (n + height) * np.cos(p) * np.sin(q), (n * (1 - e2) + height) * np.sin(p)])


def marched(ground, origin, ray, start, step=5.0):
    """The first change of sign along the ray, then halved to a millionth of a metre."""
    gap = lambda t: (lambda g: g[2][0] - surface(ground, np.degrees(g[0][0]), np.degrees(g[1][0])))(terrain.geodetic(*(origin + t * ray)[:, None]))
    t = start
    while gap(t) > 0:
        t += step
    low, high = t - step, t
    while high - low > 1e-6:
        middle = (low + high) / 2
        low, high = (middle, high) if gap(middle) > 0 else (low, middle)
    return high


def test_rays_equal_marching(spark):
    ground = ground_heights()
    nodes = spark.createDataFrame([(i, j, float(ground[i, j])) for i in range(NODES) for j in range(NODES)], "row long, col long, height double")
    rng = np.random.default_rng(2)
    rays = []
    for k in range(60):
        at = point(45.4 + rng.uniform(-0.25, 0.25), 7.4 + rng.uniform(-0.25, 0.25), 0.0)
        origin = point(45.4 + rng.uniform(-2.5, 2.5), 7.4 + rng.uniform(-2.5, 2.5), 500_000.0)
        rays.append((k, origin.tolist(), ((at - origin) / np.linalg.norm(at - origin)).tolist(), "x"))
    up = point(45.4, 7.4, 1.0) / np.linalg.norm(point(45.4, 7.4, 1.0))
    far = point(50.0, 7.4, 0.0)
    origin = point(45.4, 7.4, 500_000.0)
    odd = [(100, origin.tolist(), up.tolist(), "away"), (101, origin.tolist(), ((far - origin) / np.linalg.norm(far - origin)).tolist(), "off"), (102, None, up.tolist(), "null"), (103, origin.tolist(), [1.0, None, 0.0], "null")]
    table = spark.createDataFrame(rays + odd, "k int, origin array<double>, ray array<double>, status_of string")
    found = {r["k"]: r for r in terrain.intersect(table, terrain.height_tiles(nodes, GRID), GRID, ["k"], top=2500.0).collect()}
    assert len(found) == len(rays) + 4
    for k, origin, ray, _ in rays:
        o, d, r = np.array(origin), np.array(ray), found[k]
        assert r["status"] == terrain.HIT
        assert abs(r["height"] - surface(ground, r["lat"], r["lon"])) < 1e-6
        assert abs(r["t"] - marched(ground, o, d, terrain.ellipsoid_distance(o[None], d[None], 2500.0)[0])) < 1e-3
    assert [found[k]["status"] for k in (100, 101, 102, 103)] == ["miss", "no terrain", "miss", "miss"]
    assert found[100]["lat"] is None


def test_rays_cross_tiles_and_slices(spark):
    """Grazing rays wander over many small tiles; slices of two rays give the same as one."""
    ground = ground_heights(1)
    grid = terrain.Grid(GRID.south, GRID.west, GRID.step, cells=2)
    nodes = spark.createDataFrame([(i, j, float(ground[i, j])) for i in range(NODES) for j in range(NODES)], "row long, col long, height double")
    rays = []
    for k in range(12):
        origin, at = point(45.1 + k / 40, 5.0, 60_000.0), point(45.1 + k / 40, 7.5, 500.0)
        rays.append((k, origin.tolist(), ((at - origin) / np.linalg.norm(at - origin)).tolist()))
    table = spark.createDataFrame(rays, "k int, origin array<double>, ray array<double>")
    tiles = terrain.height_tiles(nodes, grid)
    runs = [sorted(tuple(r) for r in terrain.intersect(table, tiles, grid, ["k"], top=2000.0, slice_rays=n).select("k", "status", "lat", "lon", "height").collect()) for n in (2, 1000)]
    assert runs[0] == runs[1]
    hits = [r for r in runs[0] if r[1] == "hit"]
    assert len(hits) > 5 and all(abs(r[4] - surface(ground, r[2], r[3])) < 1e-6 for r in hits)
    assert terrain.intersect(table.where("false"), tiles, grid, ["k"]).count() == 0
    assert {r["status"] for r in terrain.intersect(table, tiles.where("false"), grid, ["k"]).collect()} == {"no terrain"}


# ---- fits -----------------------------------------------------------------------------


def samples(rng, n):
    x, y = rng.uniform(-1, 1, n), rng.uniform(-1, 1, n)
    return x, y, 3 + 2 * x - y + 0.5 * x * x - 0.25 * x * y + 0.125 * y * y + rng.normal(0, 0.01, n)


def test_fit_equals_lstsq(spark):
    rng = np.random.default_rng(0)
    rows, want = [], {}
    for key in ("a", "b"):
        x, y, z = samples(rng, 400)
        rows += [(key, *map(float, r)) for r in zip(x, y, z, strict=True)]
        want[key] = np.linalg.lstsq(np.stack([np.ones_like(x), x, y, x * x, x * y, y * y], axis=1), z, rcond=None)[0]
    rows += [("a", None, 1.0, 2.0), ("b", float("nan"), 1.0, 2.0), ("c", 1.0, 1.0, 1.0)]
    table = spark.createDataFrame(rows, "k string, x double, y double, z double")
    terms = fit.monomials([F.col("x"), F.col("y")], 2)
    found = {r["k"]: r for r in fit.least_squares(table, ["k"], terms, F.col("z")).collect()}
    for key in ("a", "b"):
        assert np.allclose(found[key]["coefficients"], want[key], rtol=0, atol=1e-9) and found[key]["n"] == 400
    assert found["c"]["coefficients"] is None  # one row does not tell six terms apart
    assert fit.least_squares(table.where("false"), ["k"], terms, F.col("z")).count() == 0


def test_outliers_are_left_out(spark):
    rng = np.random.default_rng(1)
    x, y, z = samples(rng, 500)
    z[:20] += 50
    table = spark.createDataFrame([(1, *map(float, r)) for r in zip(x, y, z, strict=True)], "k int, x double, y double, z double")
    (found,) = fit.robust(table, ["k"], fit.monomials([F.col("x"), F.col("y")], 2), F.col("z")).collect()
    assert 460 <= found["used"] <= 480 and found["n"] == 500 and found["rms"] < 0.02
    assert np.allclose(found["coefficients"], [3, 2, -1, 0.5, -0.25, 0.125], atol=0.01)


def test_rational_model_is_recovered(spark):
    rng = np.random.default_rng(2)
    x, y = rng.uniform(-1, 1, 300), rng.uniform(-1, 1, 300)
    z = (1 + 2 * x - 3 * y) / (1 + 0.3 * x + 0.2 * y)
    table = spark.createDataFrame([(1, *map(float, r)) for r in zip(x, y, z, strict=True)], "k int, x double, y double, z double")
    (found,) = fit.rational(table, ["k"], fit.monomials([F.col("x"), F.col("y")], 1), [F.col("x"), F.col("y")], F.col("z")).collect()
    assert np.allclose(found["numerator"], [1, 2, -3], atol=1e-8) and np.allclose(found["denominator"], [0.3, 0.2], atol=1e-8)


# ---- warps ----------------------------------------------------------------------------


def warped(image, model, how):
    """The whole image at once."""
    line, col = np.mgrid[: model["out_height"], : model["out_width"]].astype(float)
    y, x = warp.places(model["to_line"], line, col), warp.places(model["to_col"], line, col)
    height, width = image.shape
    inside = (y >= 0) & (y <= height - 1) & (x >= 0) & (x <= width - 1)
    i, j = np.floor(np.where(inside, y, 0)).astype(int), np.floor(np.where(inside, x, 0)).astype(int)
    down, across = warp.kernel(how, np.where(inside, y, 0) - i), warp.kernel(how, np.where(inside, x, 0) - j)
    total = np.zeros(y.shape)
    for a in range(4):
        part = np.zeros(y.shape)
        for b in range(4):
            value = image[np.clip(i + a - 1, 0, height - 1), np.clip(j + b - 1, 0, width - 1)]
            part += np.where(across[b] != 0, across[b] * value, 0)
        total += np.where(down[a] != 0, down[a] * part, 0)
    return np.where(inside, total, np.nan).astype(np.float32)


MODELS = {
    "turn": dict(height=37, width=45, out_height=50, out_width=33, to_line=[-4.0, 0.6, 0.9], to_col=[12.0, 0.8, -0.55]),
    "bend": dict(height=37, width=45, out_height=20, out_width=64, to_line=[1.0, 0.1, 1.5, 0.001, -0.004, 0.01], to_col=[0.0, 0.7, 0.0, -0.001, 0.002]),
    "same": dict(height=37, width=45, out_height=37, out_width=45, to_line=[0.0, 0.0, 1.0], to_col=[0.0, 1.0]),
    "shrink": dict(height=37, width=45, out_height=3, out_width=3, to_line=[0.0, 0.0, 17.3], to_col=[0.5, 20.9]),
}


@pytest.mark.parametrize("how", [warp.BILINEAR, warp.CUBIC])
def test_warp_equals_the_whole_image(spark, how):
    rng = np.random.default_rng(5)
    image = rng.normal(100, 30, (37, 45)).astype(np.float32)
    image[10, 12] = np.nan
    lines = [(name, i, row.tolist(), 9) for name in MODELS for i, row in enumerate(image)]
    table = spark.createDataFrame(lines, "band string, line int, radiance array<float>, tile int")
    models = spark.createDataFrame([(n, *(m[c] for c in ("height", "width", "out_height", "out_width", "to_line", "to_col"))) for n, m in MODELS.items()], "band string, height int, width int, out_height int, out_width int, to_line array<double>, to_col array<double>")
    found = {(r["band"], r["line"]): r["values"] for r in warp.warp(table, models, ["band"], how=how, tile=8).collect()}
    for name, m in MODELS.items():
        got = np.array([found[name, i] for i in range(m["out_height"])], dtype=np.float32)
        np.testing.assert_array_equal(got, warped(image, m, how))
    if how == warp.BILINEAR:
        np.testing.assert_array_equal(np.array([found["same", i] for i in range(37)], dtype=np.float32), image)


def test_warp_without_lines(spark):
    table = spark.createDataFrame([], "band string, line int, radiance array<float>")
    models = spark.createDataFrame([("x", 3, 3, 2, 2, [0.0, 0.0, 1.0], [0.0, 1.0])], "band string, height int, width int, out_height int, out_width int, to_line array<double>, to_col array<double>")
    assert all(np.isnan(r["values"]).all() and len(r["values"]) == 2 for r in warp.warp(table, models, ["band"]).collect())
    with pytest.raises(ValueError, match="kernel"):
        warp.warp(table, models, ["band"], how="nearest")


def test_fits_leave_the_rows_of_a_key_where_they_are(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, float(x), 3 + 2 * float(x) + (50 if i % 30 == 0 else 0)) for k in "ab" for i, x in enumerate(rng.random(200))]
    table = spark.createDataFrame(rows, "k string, x double, y double").repartition(5)
    terms, plans, cut = fit.monomials([F.col("x")], 1), [], fit.workspace.cut

    def seen(frame):
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return cut(frame)

    monkeypatch.setattr(fit.workspace, "cut", seen)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = sorted(map(tuple, fit.robust(table, ["k"], terms, F.col("y")).collect()))
        fit.rational(table, ["k"], terms, [F.col("x")], F.col("y")).collect()
        assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)
        monkeypatch.setattr(fit, "BROADCAST", 1)  # as if the keys were many
        many = sorted(map(tuple, fit.robust(table, ["k"], terms, F.col("y")).collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert [r[0] for r in found] == ["a", "b"] and all(r[2] == 193 and r[3] == pytest.approx([3, 2]) for r in found)
    assert [r[:3] for r in many] == [r[:3] for r in found] and "SortMergeJoin" in "".join(plans)
