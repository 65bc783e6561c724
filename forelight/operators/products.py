"""Product documents: nested JSON, one per row, and back to rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forelight.functions.scalars import nan_to_null, round_value

CATEGORIES = ("background", "moderate", "elevated", "extreme")


def missing_dates(df: DataFrame, keys: list[str], day: str, values: list[str]) -> DataFrame:
    """Days on which none of the values is there, and how many days there are."""
    empty = F.coalesce(*map(F.col, values)).isNull()
    return df.groupBy(*keys).agg(F.array_sort(F.collect_list(F.when(empty, F.col(day).cast("string")))).alias("missing_dates"), F.count_if(empty).alias("num_missing"), F.count("*").alias("n_days"))


def _series(day: str, value: Column) -> Column:
    """Values in order of days; collected with their days, as collections have no order of their own."""
    return F.transform(F.array_sort(F.collect_list(F.struct(F.col(day).alias("d"), value.alias("v")))), lambda x: x["v"])


def product(df: DataFrame, keys: list[str], day: str, variables: dict[str, str], kind: str) -> DataFrame:
    """A document per key: dates, missing dates, and a rounded series for each variable.

    ``variables`` names each column's kind, which decides its decimal places.
    A document has as many values as a forecast has days.
    """
    dates = F.transform(F.array_sort(F.collect_list(F.col(day).cast("string"))), lambda x: x)
    empty = F.coalesce(*map(F.col, variables)).isNull()
    values = F.create_map(*(x for c, k in variables.items() for x in (F.lit(c), _series(day, round_value(nan_to_null(F.col(c).cast("double")), k).cast("double")))))
    return df.groupBy(*keys).agg(
        F.lit(kind).alias("kind"),
        dates.alias("forecast_dates"),
        F.array_sort(F.collect_list(F.when(empty, F.col(day).cast("string")))).alias("missing_dates"),
        values.alias("values"),
    )


def exceedance_document(probabilities: DataFrame, keys: list[str], day: str, thresholds: tuple[int, ...]) -> DataFrame:
    """A document per key: dates, and a series of probabilities by threshold name (30ppb)."""
    series = F.create_map(*(x for t in thresholds for x in (F.lit(f"{t}ppb"), _series(day, round_value(F.col(f"p_{t}ppb"), "probability")))))
    return probabilities.groupBy(*keys).agg(F.array_sort(F.collect_list(F.col(day).cast("string"))).alias("forecast_dates"), series.alias("exceedance"))


def as_json(documents: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, json): nulls are written, as readers count on every field."""
    rest = [c for c in documents.columns if c not in keys]
    return documents.select(*keys, F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}).alias("json"))


def from_json(rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of documents: keys, date, variable, value."""
    kind = "kind string, forecast_dates array<string>, missing_dates array<string>, values map<string, array<double>>"
    doc = rows.select(*keys, F.from_json("json", kind).alias("d"))
    series = doc.select(*keys, F.col("d.forecast_dates").alias("dates"), F.explode("d.values").alias("variable", "series"))
    each = series.select(*keys, "variable", F.explode(F.arrays_zip("dates", "series")).alias("x"))
    return each.select(*keys, "variable", F.col("x.dates").alias("date"), F.col("x.series").alias("value"))


def exceedance_json(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Documents with keys such as 30ppb to columns by threshold."""
    doc = rows.select(*keys, F.from_json("json", "exceedance map<string, array<double>>").alias("d"))
    each = doc.select(*keys, F.explode("d.exceedance").alias("name", "series"))
    return each.select(*keys, F.regexp_replace("name", "ppb$", "").cast("int").alias("threshold"), F.posexplode("series").alias("day", "p"))


def observation_json(rows: DataFrame, json: str = "json") -> DataFrame:
    """Station observations from a nested response: times and values zipped, those that are no numbers dropped."""
    kind = "STATION array<struct<STID: string, OBSERVATIONS: struct<date_time: array<string>, value: array<string>>>>"
    station = rows.select(F.explode(F.from_json(json, kind)["STATION"]).alias("s"))
    each = station.select(F.col("s.STID").alias("stid"), F.explode(F.arrays_zip("s.OBSERVATIONS.date_time", "s.OBSERVATIONS.value")).alias("o"))
    out = each.select("stid", F.try_to_timestamp(F.col("o.date_time")).alias("ts"), F.expr("try_cast(o.value as double)").alias("value"))
    return out.where("ts is not null and value is not null")


#: Units of the weather variables; fixed values.
WEATHER = {"snow": "mm", "mslp": "hPa", "wind": "m/s", "solar": "W/m²", "temp": "°C"}


def _units() -> Column:
    return F.create_map(*(F.lit(x) for pair in WEATHER.items() for x in pair))


def weather_members(series: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """(keys, json): the whole-resolution weather of each member; a variable that the table lacks is an empty series."""
    named = [v for v in WEATHER if v in series.columns]
    absent = [x for v in WEATHER if v not in named for x in (F.lit(v), F.array().cast("array<double>"))]
    values = F.create_map(*(x for v in named for x in (F.lit(v), _series(ts, round_value(nan_to_null(F.col(v).cast("double")), v).cast("double")))), *absent)
    times = F.array_sort(F.collect_list(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")))
    doc = series.groupBy(*keys).agg(F.lit("weather").alias("product_type"), F.count("*").alias("num_timesteps"), times.alias("forecast_dates"), values.alias("values"))
    return as_json(doc.withColumn("units", _units()), keys)


def weather_percentiles(series: DataFrame, keys: list[str], ts: str, member: str = "member", levels: tuple[int, ...] = (10, 50, 90)) -> DataFrame:
    """(keys, json): percentiles across members of each variable at each time, missing values skipped."""
    named = [v for v in WEATHER if v in series.columns]
    at = series.groupBy(*keys, ts).agg(*(F.percentile(nan_to_null(F.col(v).cast("double")), [p / 100 for p in levels]).alias(v) for v in named))
    per_time = {f"{v}_p{p}": _series(ts, round_value(F.get(F.col(v), F.lit(i)), v).cast("double")) for v in named for i, p in enumerate(levels)}
    values = F.create_map(*(x for n, c in per_time.items() for x in (F.lit(n), c)))
    doc = at.groupBy(*keys).agg(F.lit("weather_percentiles").alias("product_type"), F.count("*").alias("num_timesteps"), F.array_sort(F.collect_list(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))).alias("forecast_dates"), values.alias("values"))
    n = series.groupBy(*keys).agg(F.count_distinct(member).alias("num_members"))
    return as_json(doc.join(n, keys).withColumn("units", _units()), keys)


def weather_payload(rows: DataFrame, keys: list[str], json: str = "json") -> DataFrame:
    """(keys, snow, wind): the two series that clusters are described by; empty where a document has none."""
    doc = F.from_json(json, "values struct<snow: array<double>, wind: array<double>>")["values"]
    none = F.array().cast("array<double>")
    return rows.select(*keys, *(F.coalesce(doc[v], none).alias(v) for v in ("snow", "wind")))


def all_products(days: DataFrame, group: list[str], exceedances: DataFrame, clusters: DataFrame, series: DataFrame | None = None) -> DataFrame:
    """(group, product, member, json): everything that a run gives out.

    ``days``: group, member, local_date and daily values; ``exceedances``: group,
    local_date and probabilities; ``clusters``: group, json; ``series``: weather by
    valid_time, if it is to go out too. Documents of a run have no member.
    """
    at = [*group, "member"]
    heatmaps = as_json(product(days.select(*at, "local_date", *CATEGORIES), at, "local_date", dict.fromkeys(CATEGORIES, "possibility"), "possibility_heatmap"), at)
    named = days.select(*at, "local_date", *(F.col(f"ozone_{p}pc").alias(f"p{p}") for p in (10, 50, 90)))
    scenarios = as_json(product(named, at, "local_date", {f"p{p}": "ozone" for p in (10, 50, 90)}, "percentile_scenarios"), at)
    thresholds = tuple(int(c[2:-3]) for c in exceedances.columns if c.startswith("p_"))
    above = as_json(exceedance_document(exceedances, group, "local_date", thresholds), group)
    found = [(heatmaps, "possibility_heatmap"), (scenarios, "percentile_scenarios"), (above, "exceedance_probabilities"), (clusters, "clustering_summary")]
    if series is not None:
        found += [(weather_members(series, at, "valid_time"), "weather_members"), (weather_percentiles(series, group, "valid_time"), "weather_percentiles")]
    kind = days.schema["member"].dataType
    out = None
    for df, name in found:
        member = F.col("member") if "member" in df.columns else F.lit(None)
        rows = df.select(*group, F.lit(name).alias("product"), member.cast(kind).alias("member"), "json")
        out = rows if out is None else out.unionByName(rows)
    return out
