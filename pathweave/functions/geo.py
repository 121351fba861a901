"""Geographic column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Degrees of a grid cell and the radius of a curated-route match.
CELL, RADIUS = 0.002, 0.0015
EARTH_DIAMETER = 12_742_000.0


def tile_name(lat: Column, lon: Column) -> Column:
    """The raster tile by its south-west corner, N37E126."""
    y, x = F.floor(lat), F.floor(lon)
    return F.format_string("%s%02d%s%03d", F.when(lat >= 0, "N").otherwise("S"), F.abs(y), F.when(lon >= 0, "E").otherwise("W"), F.abs(x))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Metres."""
    a, b = F.radians(lat1), F.radians(lat2)
    half_lat, half_lon = (b - a) / 2, (F.radians(lon2) - F.radians(lon1)) / 2
    v = F.pow(F.sin(half_lat), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(half_lon), 2)
    return F.asin(F.sqrt(v)) * EARTH_DIAMETER


def cell(degrees: Column, size: float = CELL) -> Column:
    """The grid cell, truncated toward zero."""
    return (degrees / F.lit(size)).cast("bigint")


def squared_degrees(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """No correction for latitude."""
    return (lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2)


def slippy_tile(lat: Column, lon: Column, zoom: int) -> tuple[Column, Column]:
    """Web map tile numbers (ours)."""
    n = float(1 << zoom)
    y = (1 - F.log(F.tan(F.radians(lat)) + 1 / F.cos(F.radians(lat))) / F.lit(3.141592653589793)) / 2 * n
    return F.floor((lon + 180) / 360 * n), F.floor(y)


def quadrants(regions: DataFrame) -> DataFrame:
    """P20: each region's four quadrants SW, SE, NW, NE; mid-lines at six decimals."""
    mid = lambda a, b: F.round((F.col(a) + F.col(b)) / 2, 6)
    own = regions.withColumns({"x": mid("west", "east"), "y": mid("south", "north")})
    box = lambda name, w, s, e, n: F.struct(F.lit(name).alias("quadrant"), *[F.col(c).alias(a) for c, a in zip((w, s, e, n), ("q_west", "q_south", "q_east", "q_north"), strict=True)])
    four = F.array(box("SW", "west", "south", "x", "y"), box("SE", "x", "south", "east", "y"), box("NW", "west", "y", "x", "north"), box("NE", "x", "y", "east", "north"))
    return own.select("id", F.explode(four).alias("q")).select("id", "q.*")


def dem_catalogue(spark: SparkSession, lats: range = range(33, 39), lons: range = range(125, 131)) -> DataFrame:
    """The raster tiles of an area, (lat, lon, tile)."""
    y = spark.range(lats.start, lats.stop).withColumnRenamed("id", "lat")
    grid = y.select("lat", F.explode(F.sequence(F.lit(lons.start).cast("bigint"), F.lit(lons.stop - 1).cast("bigint"))).alias("lon"))
    return grid.select("lat", "lon", tile_name(F.col("lat"), F.col("lon")).alias("tile"))
