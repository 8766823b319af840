"""Where viewing rays meet the ground: an ellipsoid that bears terrain.

Heights are tiles of a regular grid in degrees. Rays and tiles meet by tile
key; in a task all rays of a tile step towards the ground together, and rays
that leave the tile are dealt anew to the tile they have come to. A ray ends in
one of the states below, never silently.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import workspace
from . import dealing

#: Semi-axes of the WGS 84 ellipsoid in metres.
EQUATORIAL, POLAR = 6_378_137.0, 6_356_752.314245179
OPEN, HIT, MISS, NO_TERRAIN, NOT_CONVERGED = "open", "hit", "miss", "no terrain", "not converged"


@dataclass(frozen=True)
class Grid:
    """Nodes at south + row * step, west + column * step (degrees); a tile has `cells` cells a side and the nodes on all its edges."""

    south: float
    west: float
    step: float
    cells: int = 64


def height_tiles(nodes: DataFrame, grid: Grid) -> DataFrame:
    """(ty, tx, place array, height array) from (row, col, height); a node on an edge goes to every tile it bounds, of repeated nodes the largest counts."""
    n = grid.cells
    row, col = F.col("row"), F.col("col")
    tiles = lambda x: F.array_distinct(F.array(F.floor(x / n), F.floor((x - 1) / n)))
    spread = nodes.where(row.isNotNull() & col.isNotNull() & F.col("height").isNotNull()).withColumn("ty", F.explode(tiles(row))).withColumn("tx", F.explode(tiles(col)))
    place = ((row - F.col("ty") * n) * (n + 1) + col - F.col("tx") * n).cast("int")
    single = spread.groupBy("ty", "tx", place.alias("place")).agg(F.max(F.col("height").cast("double")).alias("height"))
    return single.groupBy("ty", "tx").agg(F.sort_array(F.collect_list(F.struct("place", "height"))).alias("p")).select("ty", "tx", F.col("p.place").alias("place"), F.col("p.height").alias("heights"))


def geodetic(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Latitude and longitude in radians and height in metres, by Bowring's formula."""
    flat = np.hypot(x, y)
    e2, ep2 = 1 - (POLAR / EQUATORIAL) ** 2, (EQUATORIAL / POLAR) ** 2 - 1
    beta = np.arctan2(z * EQUATORIAL, flat * POLAR)
    lat = np.arctan2(z + ep2 * POLAR * np.sin(beta) ** 3, flat - e2 * EQUATORIAL * np.cos(beta) ** 3)
    height = flat * np.cos(lat) + z * np.sin(lat) - EQUATORIAL * np.sqrt(1 - e2 * np.sin(lat) ** 2)
    return lat, np.arctan2(y, x), height


def ecef(lat: Column, lon: Column, height: Column) -> Column:
    """Earth-centred coordinates of a point, angles in degrees."""
    e2 = 1 - (POLAR / EQUATORIAL) ** 2
    phi, lam = F.radians(lat), F.radians(lon)
    n = F.lit(EQUATORIAL) / F.sqrt(1 - F.lit(e2) * F.sin(phi) * F.sin(phi))
    return F.array((n + height) * F.cos(phi) * F.cos(lam), (n + height) * F.cos(phi) * F.sin(lam), (n * (1 - e2) + height) * F.sin(phi))


def ellipsoid_distance(origin: np.ndarray, ray: np.ndarray, height: float) -> np.ndarray:
    """Distance along each ray to the ellipsoid whose axes are longer by `height`; NaN where it is missed or behind."""
    scale = 1 / np.array([EQUATORIAL + height, EQUATORIAL + height, POLAR + height])
    o, d = origin * scale, ray * scale
    a, b, c = (d * d).sum(axis=1), (o * d).sum(axis=1), (o * o).sum(axis=1) - 1
    with np.errstate(invalid="ignore", divide="ignore"):
        t = (-b - np.sqrt(b * b - a * c)) / a
    return np.where(t >= 0, t, np.nan)


STATE = ("t", "above", "below", "gap_above", "gap_below", "steps", "lat", "lon", "height")


def _vectors(column) -> np.ndarray:
    return np.array([[np.nan] * 3 if v is None or len(v) != 3 else [np.nan if x is None else x for x in v] for v in column.to_pylist()], dtype=np.float64).reshape(-1, 3)


def _tile_of(grid: Grid, lat: np.ndarray, lon: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    side = grid.step * grid.cells
    return tuple(np.nan_to_num(np.floor((np.degrees(v) - at) / side), nan=-(2.0**40)).astype(np.int64) for v, at in ((lat, grid.south), (lon, grid.west)))


def _with_state(table, state: dict, names: list[str]) -> pa.Table:
    kinds = {"status": pa.string(), "ty": pa.int64(), "tx": pa.int64(), "steps": pa.int32()}
    kept = [c for c in names if c not in state]
    return pa.table([*(table.column(c) for c in kept), *(pa.array(v, kinds.get(c, pa.float64())) for c, v in state.items())], [*kept, *state])


def _start(grid: Grid, top: float, names: list[str]):
    def run(batches):
        for batch in batches:
            origin, ray = _vectors(batch.column("origin")), _vectors(batch.column("ray"))
            t = ellipsoid_distance(origin, ray, top)
            lat, lon, height = geodetic(*(origin + t[:, None] * ray).T)
            ty, tx = _tile_of(grid, lat, lon)
            none = np.full(len(t), np.nan)
            state = {"status": np.where(np.isnan(t), MISS, OPEN), "ty": ty, "tx": tx, "t": t, "above": none, "below": none, "gap_above": none, "gap_below": none, "steps": np.zeros(len(t), np.int32), "lat": lat, "lon": lon, "height": height}
            yield from _with_state(batch, state, names).to_batches()

    return run


def _step(grid: Grid, tolerance: float, most: int, names: list[str]):
    """Move all rays of a tile until each has ended or left it."""
    n = grid.cells + 1

    def run(rays: pa.Table, tile: pa.Table) -> pa.Table:
        get = lambda c: rays.column(c).to_numpy().copy()
        state = {c: get(c) for c in STATE}
        status = np.array([OPEN] * rays.num_rows, dtype=object)
        ty, tx = get("ty"), get("tx")
        home = (ty[0], tx[0]) if len(ty) else (0, 0)
        ground = np.full(n * n, np.nan)
        for place, heights in zip(tile.column("place").to_pylist(), tile.column("heights").to_pylist(), strict=True):
            ground[place] = heights
        origin, ray = _vectors(rays.column("origin")), _vectors(rays.column("ray"))
        live = np.arange(rays.num_rows)
        while len(live):
            t = state["t"][live]
            lat, lon, height = geodetic(*(origin[live] + t[:, None] * ray[live]).T)
            state["lat"][live], state["lon"][live], state["height"][live] = lat, lon, height
            ty[live], tx[live] = _tile_of(grid, lat, lon)
            here = (ty[live] == home[0]) & (tx[live] == home[1])
            live, t, lat, lon, height = (v[here] for v in (live, t, lat, lon, height))
            if not len(live):
                break
            u = (np.degrees(lat) - grid.south) / grid.step - home[0] * grid.cells
            v = (np.degrees(lon) - grid.west) / grid.step - home[1] * grid.cells
            i, j = np.clip(np.floor(u), 0, n - 2).astype(np.int64), np.clip(np.floor(v), 0, n - 2).astype(np.int64)
            a, b, at = u - i, v - j, i * n + j
            surface = (1 - a) * ((1 - b) * ground[at] + b * ground[at + 1]) + a * ((1 - b) * ground[at + n] + b * ground[at + n + 1])
            gap = height - surface
            up = np.stack([np.cos(lat) * np.cos(lon), np.cos(lat) * np.sin(lon), np.sin(lat)], axis=1)
            sinks = -(ray[live] * up).sum(axis=1)
            state["steps"][live] += 1
            no_ground, done, rising = np.isnan(gap), np.abs(gap) <= tolerance, (sinks <= 0) & (gap > 0)
            for which, name in ((rising, MISS), (no_ground, NO_TERRAIN), (done, HIT)):
                status[live[which]] = name
            on = ~(no_ground | done | rising)
            late = on & (state["steps"][live] >= most)
            status[live[late]] = NOT_CONVERGED
            on &= ~late
            live, t, gap, sinks = live[on], t[on], gap[on], sinks[on]
            over = gap > 0
            for side, mine in (("above", over), ("below", ~over)):
                state[side][live[mine]], state[f"gap_{side}"][live[mine]] = t[mine], gap[mine]
            lo, hi = state["above"][live], state["below"][live]
            with np.errstate(invalid="ignore", divide="ignore"):
                move = t + gap / sinks
                held = ~np.isnan(lo) & ~np.isnan(hi)
                inside = (move > np.minimum(lo, hi)) & (move < np.maximum(lo, hi))
                middle = (lo + hi) / 2
            state["t"][live] = np.where(held & ~inside, middle, np.where(np.isfinite(move), move, np.nan))
            lost = ~np.isfinite(state["t"][live])
            status[live[lost]] = MISS
            live = live[~lost]
        return _with_state(rays, {"status": status.tolist(), "ty": ty, "tx": tx, **state}, names)

    return run


def intersect(rays: DataFrame, tiles: DataFrame, grid: Grid, key: list[str], *, top: float = 9000.0, tolerance: float = 1e-7, most: int = 200, rounds: int = 64, slice_rays: int = 100_000) -> DataFrame:
    """Add `status`, `t` (metres along the ray), `lat`, `lon` (degrees), `height` and `steps` to rows (key, origin, ray, ...).

    `origin` and `ray` are Earth-centred; `ray` has unit length. A ray starts
    where it meets the surface at height `top`, no lower than any ground, and
    steps along by its gap to the ground below, held between the last point
    above and the last point under the ground. States: `hit` (the gap is at most
    `tolerance` metres), `miss` (the ray passes or leaves the Earth, or has no
    numbers), `no terrain` (it came to a place without heights), `not
    converged` (more than `most` steps or `rounds` changes of tile). Where
    ground hides other ground from a slanting ray, a step may pass over a ridge
    narrower than the step and end behind it. An empty table gives no rows.
    """
    names = [*rays.columns, "status", "ty", "tx", *STATE]
    kinds = {f.name: f.dataType.simpleString() for f in rays.schema} | {"status": "string", "ty": "bigint", "tx": "bigint", "steps": "int"}
    schema = ", ".join(f"`{c}` {kinds.get(c, 'double')}" for c in names)
    state = workspace.cut(rays.mapInArrow(_start(grid, top, names), schema))
    ended = [state.where(F.col("status") != OPEN)]
    open_ = state.where(F.col("status") == OPEN)
    for _ in range(rounds):
        if open_.isEmpty():
            break
        moved = workspace.cut(dealing.answer(open_, tiles, ["ty", "tx"], key, slice_rays, _step(grid, tolerance, most, names), schema))
        ended.append(moved.where(F.col("status") != OPEN))
        open_ = moved.where(F.col("status") == OPEN)
    else:
        ended.append(open_.withColumn("status", F.lit(NOT_CONVERGED)))
    found = reduce(DataFrame.unionByName, ended)
    hit = lambda c: F.when(F.col("status") == HIT, c)
    return found.select(*rays.columns, "status", hit(F.col("t")).alias("t"), hit(F.degrees("lat")).alias("lat"), hit(F.degrees("lon")).alias("lon"), hit(F.col("height")).alias("height"), "steps")
