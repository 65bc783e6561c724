"""Grids: crops, masks, spatial quantiles, nearest cells, smoothing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forelight.functions.quantile import hazen_by_ranks, selected
from forelight.functions.scalars import shift_longitude

#: The basin's box (south, north, west, east) and how high low terrain reaches; fixed values.
BOX = (39.4, 41.1, -110.9, -108.5)
TERRAIN, MARGIN = 1850, 250
#: How a variable's cells become one value: quantile and conversion.
REPRESENTATIVE = {"solar": 0.9, "snow": 0.75, "wind": 0.5, "temp": 0.5}


def crop(df: DataFrame, box: tuple[float, float, float, float] = BOX) -> DataFrame:
    """Rows inside the box, longitudes from -180 to 180."""
    south, north, west, east = box
    return df.withColumn("lon", shift_longitude(F.col("lon"))).where(F.col("lat").between(south, north) & F.col("lon").between(west, east))


def low_terrain(elev: Column, threshold: float = TERRAIN, raw: bool = False) -> Column:
    return elev < (threshold if raw else threshold + MARGIN)


def masked(df: DataFrame, cells: DataFrame, on: list[str], threshold: float = TERRAIN) -> DataFrame:
    """Rows of low cells. The cell table is small against the grid; Catalyst broadcasts it if it is under its limit."""
    return df.join(cells.where(low_terrain(F.col("elev_m"), threshold)).select(*on), on)


def spatial_quantile(df: DataFrame, keys: list[str], value: str, q: float) -> DataFrame:
    """Hazen quantile over the cells of each key; masked cells are absent and missing ones skipped."""
    return hazen_by_ranks(df, keys, value, q).withColumnRenamed("n", "n_cells")


def representative(df: DataFrame, keys: list[str], rules: dict[str, float] = REPRESENTATIVE) -> DataFrame:
    """(keys and, per variable, its value and n_<variable>): the quantile that stands for each variable's cells, all in one scan.

    A variable with no cell that has a value is null and has 0 of them.
    """
    found = selected(df, keys, {v: (v, q) for v, q in rules.items()})
    one = lambda v, c: F.max(F.when(F.col("name") == v, F.col(c)))
    return found.groupBy(*keys).agg(*(x for v in rules for x in (one(v, "value").alias(v), one(v, "n").alias(f"n_{v}"))))


#: Coordinates of a grid, and points, that may meet each other.
MOST_COORDINATES = 10_000


def _few(df: DataFrame, what: str, most: int = MOST_COORDINATES) -> DataFrame:
    """df, whose rows are few enough for each to meet all rows of another; an error if they aren't."""
    if df.limit(most + 1).count() > most:
        raise ValueError(f"more than {most} {what}")
    return df


def nearest_cell(df: DataFrame, points: DataFrame) -> DataFrame:
    """Rows at the grid's latitude nearest to each point's, and the longitude nearest to its, each on its own.

    ``points``: point, q_lat, q_lon. Ties go to the smaller coordinate. The
    distinct coordinates of a grid are few, which is checked; only these meet the points.
    """
    points = _few(points, "points")
    lat = points.crossJoin(_few(df.select("lat").distinct(), "latitudes")).groupBy("point").agg(F.min(F.struct(F.abs(F.col("lat") - F.col("q_lat")).alias("d"), "lat")).alias("a"))
    lon = points.crossJoin(_few(df.select("lon").distinct(), "longitudes")).groupBy("point").agg(F.min(F.struct(F.abs(F.col("lon") - F.col("q_lon")).alias("d"), "lon")).alias("o"))
    at = lat.join(lon, "point").select("point", F.col("a.lat").alias("lat"), F.col("o.lon").alias("lon"))
    return df.join(at, ["lat", "lon"])


#: Lead hours of the two products; fixed values.
FINE_HOURS, COARSE_HOURS, COARSE_STEP = 240, 384, 6


def lead_hours(step: int = 3) -> list[tuple[int, str]]:
    """(fxx, product) of a whole forecast: the fine grid to 240 hours, then the coarse one, whose steps are six hours at least."""
    step, wide = max(step, 1), max(step, COARSE_STEP)
    return [(f, "atmos.25") for f in range(0, FINE_HOURS + 1, step)] + [(f, "atmos.5") for f in range(FINE_HOURS + wide, COARSE_HOURS + 1, wide)]


def point_series(df: DataFrame, runs: DataFrame, keys: list[str], lat: float, lon: float, hours: list[tuple[int, str]], value: str = "value") -> DataFrame:
    """(keys, fxx, product, valid_time, value): the value at the grid point nearest to a place, for every lead hour of every run.

    ``df``: keys with init, fxx, lat, lon and the value, of grids whose resolution may differ by lead hour;
    ``runs``: the keys that are expected. A lead hour that didn't come is null; one that is listed twice counts once, for the first product.
    """
    nearest = F.min_by(F.struct(value), F.struct(F.abs(F.col("lat") - lat), "lat", F.abs(F.col("lon") - lon), "lon"))
    at = df.groupBy(*keys, "fxx").agg(nearest[value].alias("value"))
    first = dict(reversed(hours))
    slices = F.explode(F.array(*(F.struct(F.lit(f).alias("fxx"), F.lit(p).alias("product")) for f, p in sorted(first.items())))).alias("s")
    wanted = runs.select(*keys).distinct().select(*keys, slices).select(*keys, "s.fxx", "s.product")
    return wanted.join(at, [*keys, "fxx"], "left").select(*keys, "fxx", "product", (F.col("init") + F.make_dt_interval(hours=F.col("fxx"))).alias("valid_time"), "value")


def smooth(df: DataFrame, keys: list[str], i: str, j: str, value: str) -> DataFrame:
    """(2 x + mean of the neighbours) / 3 over the up to eight neighbours in a grid of whole-number indices."""
    steps = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a in (-1, 0, 1) for b in (-1, 0, 1) if a or b))
    near = df.select(*keys, F.col(value).alias("_x"), i, j, F.explode(steps).alias("_s")).select(*keys, (F.col(i) + F.col("_s.a")).alias(i), (F.col(j) + F.col("_s.b")).alias(j), "_x")
    mean = near.groupBy(*keys, i, j).agg(F.avg("_x").alias("_mean"))
    return df.join(mean, [*keys, i, j], "left").withColumn("smoothed", F.when(F.col("_mean").isNull(), F.col(value)).otherwise((2 * F.col(value) + F.col("_mean")) / 3)).drop("_mean")


def field_stats(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Least, largest and missing values of a field."""
    return df.groupBy(*keys).agg(F.min(value).alias("low"), F.max(value).alias("high"), F.count_if(F.col(value).isNull()).alias("n_missing"))
