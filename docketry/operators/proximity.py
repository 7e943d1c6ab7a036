"""Points near other points or inside regions, by adaptive cell coverage.

A region (a disc around a site, or a polygon with holes) is covered by quadtree cells: cells wholly inside are kept
coarse, cells crossed by the border are split down to a finest level. Points meet cells by an equi-join on (level, row,
column); an interior match is accepted at once and only boundary matches pay for the exact distance or containment test.
"""

from __future__ import annotations

import math

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_M = 6_371_008.8
#: Cell edge in degrees at level 0; each level halves it.
BASE_DEG = 0.004
#: Levels of the quadtree. Three give 111 m cells at the finest, whose border ring is thin against a 250 m disc.
LEVELS = 4
#: Coverage cells that may be broadcast (about 40 bytes each); a larger coverage is joined by shuffle.
BROADCAST_CELLS = 500_000

_COVER = "site_id long, site_lat double, site_lon double, level int, r long, c long, inside boolean"


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres."""
    a1, a2 = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * EARTH_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def _metres(lat1, lon1, lat2, lon2) -> float:
    a1, a2 = math.radians(lat1), math.radians(lat2)
    h = math.sin((a2 - a1) / 2) ** 2 + math.cos(a1) * math.cos(a2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * EARTH_M * math.asin(math.sqrt(min(1.0, h)))


def disc_cells(lat: float, lon: float, radius_m: float, levels: int = LEVELS, base: float = BASE_DEG) -> list[tuple[int, int, int, bool]]:
    """(level, row, column, inside) cells that together cover the disc and, where ``inside``, lie wholly within it."""
    out: list[tuple[int, int, int, bool]] = []

    def visit(level: int, r: int, c: int) -> None:
        edge = base / 2**level
        s, w = r * edge, c * edge
        n, e = s + edge, w + edge
        nearest = _metres(lat, lon, min(max(lat, s), n), min(max(lon, w), e))
        if nearest > radius_m * 1.001 + 0.5:  # slack: clamping a coordinate is not exactly the nearest point on a sphere
            return
        farthest = max(_metres(lat, lon, y, x) for y in (s, n) for x in (w, e))
        if farthest <= radius_m * 0.999 - 0.5:
            out.append((level, r, c, True))
        elif level == levels - 1:
            out.append((level, r, c, False))
        else:
            for dr in (0, 1):
                for dc in (0, 1):
                    visit(level + 1, 2 * r + dr, 2 * c + dc)

    dlat = math.degrees(radius_m / EARTH_M) + 1e-6
    dlon = dlat / max(0.01, math.cos(math.radians(min(89.0, abs(lat) + dlat))))
    for r in range(math.floor((lat - dlat) / base), math.floor((lat + dlat) / base) + 1):
        for c in range(math.floor((lon - dlon) / base), math.floor((lon + dlon) / base) + 1):
            visit(0, r, c)
    return out


def coverage(sites: DataFrame, radius_m: float, levels: int = LEVELS, base: float = BASE_DEG) -> DataFrame:
    """Coverage cells of every site; sites without a location have none. Built by Arrow batches on the executors."""

    def cover(batches):
        for pdf in batches:
            rows = [(s, a, o, *cell) for s, a, o in zip(pdf["site_id"], pdf["site_lat"], pdf["site_lon"]) for cell in disc_cells(a, o, radius_m, levels, base)]
            yield pd.DataFrame(rows, columns=["site_id", "site_lat", "site_lon", "level", "r", "c", "inside"])

    located = sites.select(F.col("site_id").cast("long"), F.col("lat").cast("double").alias("site_lat"), F.col("lon").cast("double").alias("site_lon"))
    return located.where(F.col("site_id").isNotNull() & F.col("site_lat").between(-90, 90) & F.col("site_lon").between(-180, 180)).distinct().mapInPandas(cover, _COVER)


def _in_cells(points: DataFrame, key: str, levels: int, base: float) -> DataFrame:
    """Located points, once for each level with the cell they lie in."""
    ladder = F.array(*[
        F.struct(F.lit(k).alias("level"), F.floor(F.col("lat") / (base / 2**k)).alias("r"), F.floor(F.col("lon") / (base / 2**k)).alias("c"))
        for k in range(levels)
    ])
    located = points.where(F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180))
    return located.select(key, "lat", "lon", F.explode(ladder).alias("x")).select(key, "lat", "lon", "x.level", "x.r", "x.c")


def near_sites(points: DataFrame, sites: DataFrame, radius_m: float = 250.0, key: str = "record_key", levels: int = LEVELS, base: float = BASE_DEG, cells: int | None = None) -> DataFrame:
    """(key, site_id) for every point at most ``radius_m`` from a site.

    ``points`` has ``key, lat, lon`` as doubles; points without a finite location match nothing. Repeated points give
    one row. ``cells`` is the number of coverage cells when the caller has counted them: up to ``BROADCAST_CELLS`` they
    are broadcast, above it (or when unknown) the join strategy is left to the planner.
    """
    cover = coverage(sites, radius_m, levels, base)
    if cells is not None and cells <= BROADCAST_CELLS:
        cover = F.broadcast(cover)
    met = _in_cells(points, key, levels, base).join(cover, ["level", "r", "c"])
    hit = met.where(F.col("inside") | (haversine_m(F.col("lat"), F.col("lon"), F.col("site_lat"), F.col("site_lon")) <= radius_m))
    return hit.select(key, "site_id").distinct()


def coverage_bound(sites: DataFrame, radius_m: float, levels: int = LEVELS, base: float = BASE_DEG) -> int:
    """Proven upper bound of the coverage's cells: number of sites times the finest cells of a square about the disc."""
    edge_m = math.radians(base / 2 ** (levels - 1)) * EARTH_M * 0.5  # half: meridians converge up to latitude 60
    return sites.count() * (math.ceil(2 * radius_m / edge_m) + 2) ** 2


def _edges(rings) -> list[tuple[float, float, float, float]]:
    """(lat, lon, lat, lon) of every side of the rings; rings of fewer than three corners bound nothing."""
    sides = []
    for ring in rings if rings is not None else ():
        corners = [(p["lat"], p["lon"]) for p in (ring if ring is not None else ()) if p is not None and p["lat"] is not None and p["lon"] is not None]
        if len(corners) >= 3:
            sides += [(*a, *b) for a, b in zip(corners, corners[1:] + corners[:1]) if a != b]
    return sides


def _holds(sides, lat: float, lon: float) -> bool:
    """Whether a ray from the point crosses an odd number of sides."""
    return sum((a > lat) != (c > lat) and lon < (d - b) * (lat - a) / (c - a) + b for a, b, c, d in sides) % 2 == 1


def _crosses(side, s: float, w: float, n: float, e: float) -> bool:
    """Whether a side touches a rectangle: its extent cut by each border in turn."""
    a, b, c, d = side
    low, high = 0.0, 1.0
    for start, move, least, most in ((a, c - a, s, n), (b, d - b, w, e)):
        if move == 0:
            if not least <= start <= most:
                return False
            continue
        x, y = sorted(((least - start) / move, (most - start) / move))
        low, high = max(low, x), min(high, y)
    return low <= high


def polygon_cells(sides, levels: int = LEVELS, base: float = BASE_DEG) -> list[tuple[int, int, int, bool]]:
    """(level, row, column, inside) cells that cover a polygon; a cell no side touches is inside or out as its middle is."""
    out: list[tuple[int, int, int, bool]] = []

    def visit(level: int, r: int, c: int, near) -> None:
        edge = base / 2**level
        s, w = r * edge, c * edge
        slack = edge * 1e-9  # a point on a cell's border may be counted to either cell
        touched = [x for x in near if _crosses(x, s - slack, w - slack, s + edge + slack, w + edge + slack)]
        if not touched:
            if _holds(sides, s + edge / 2, w + edge / 2):
                out.append((level, r, c, True))
        elif level == levels - 1:
            out.append((level, r, c, False))
        else:
            for dr in (0, 1):
                for dc in (0, 1):
                    visit(level + 1, 2 * r + dr, 2 * c + dc, touched)

    lats, lons = [y for a, _, c, _ in sides for y in (a, c)], [x for _, b, _, d in sides for x in (b, d)]
    for r in range(math.floor(min(lats) / base), math.floor(max(lats) / base) + 1) if sides else ():
        for c in range(math.floor(min(lons) / base), math.floor(max(lons) / base) + 1):
            visit(0, r, c, sides)
    return out


def in_regions(points: DataFrame, regions: DataFrame, key: str = "record_key", levels: int = LEVELS, base: float = BASE_DEG, cells: int | None = None) -> DataFrame:
    """(key, region_id) for every point inside a region.

    ``regions`` has ``region_id`` (long) and ``rings``, arrays of ``lat, lon`` corners; what an even number of rings
    enclose is a hole. A point on the border counts as the ray rule has it: the lower and left sides are in. Regions
    without three corners hold nothing, repeated points give one row, regions may overlap. Cells carry their region's
    sides only where the border crosses them. ``cells`` as for ``near_sites``.
    """

    schema = pa.schema([("region_id", pa.int64()), ("level", pa.int32()), ("r", pa.int64()), ("c", pa.int64()), ("inside", pa.bool_()), ("sides", pa.list_(pa.list_(pa.float64())))])

    def cover(batches):
        for batch in batches:
            for region, rings in zip(*(column.to_pylist() for column in batch.columns)):
                sides = _edges(rings)
                rows = [(region, level, r, c, inside, [] if inside else sides) for level, r, c, inside in polygon_cells(sides, levels, base)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), schema)], schema=schema)

    known = regions.select(F.col("region_id").cast("long"), "rings").where(F.col("region_id").isNotNull())
    covered = known.mapInArrow(cover, "region_id long, level int, r long, c long, inside boolean, sides array<array<double>>")
    if cells is not None and cells <= BROADCAST_CELLS:
        covered = F.broadcast(covered)
    met = _in_cells(points, key, levels, base).join(covered, ["level", "r", "c"])
    side = lambda x: [F.get(x, F.lit(k)) for k in range(4)]

    def crossed(x: Column) -> Column:
        a, b, c, d = side(x)
        return ((a > F.col("lat")) != (c > F.col("lat"))) & (F.col("lon") < (d - b) * (F.col("lat") - a) / F.nullif(c - a, F.lit(0.0)) + b)

    odd = F.size(F.filter("sides", lambda x: F.coalesce(crossed(x), F.lit(False)))) % 2 == 1
    return met.where(F.col("inside") | odd).select(key, "region_id").distinct()
