"""Rollups over complete calendars: area, zone and pixel; month and year.

A rollup is one aggregation with map-side partial sums; the calendar side of the join is small and fixed by years and
zones, so Spark broadcasts whichever side its statistics allow.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import SENSORS, Settings
from ..functions import scene as S
from ..functions.statistics import cv_pct, slope, summary, weighted_mean
from .quantiles import quantiles

VARIABLES = ("ndvi", "lst_c")


#: Values of a group that a task may hold to find their median.
HELD = 1_000_000


def scene_stats(pixels: DataFrame, by: Sequence[str], attributes: Sequence[str] = (), most: int | None = None, medians: bool = True) -> DataFrame:
    """Six statistics of each variable (five without ``medians``); a group without valid pixels has counts of 0 and nulls.

    ``attributes`` are the same in all of a group's pixels; they are no keys.  ``most`` is a number of pixels that no
    group exceeds: where a task can hold as many, one aggregation finds the median too; beyond it, or where nothing is
    known, medians come from :func:`quantiles`, which reads the pixels twice and gathers no group.
    """
    first = [F.first(c).alias(c) for c in attributes]
    if not medians:
        out = pixels.groupBy(*by).agg(*first, *[c for v in VARIABLES for c in summary(F.col(v), None, v)])
    elif most is not None and most <= HELD:
        out = pixels.groupBy(*by).agg(*first, *[c for v in VARIABLES for c in summary(F.col(v), F.median(v), v)])
    else:
        out = quantiles(pixels, by, VARIABLES, also=[*first, *[c for v in VARIABLES for c in summary(F.col(v), None, v)]])
        out = out.withColumnsRenamed({f"{v}_q0": f"{v}_mediana" for v in VARIABLES})
    names = [f"{v}_{x}" for v in VARIABLES for x in ("media", *["mediana"] * medians, "min", "max", "dp", "n")]
    return out.select(*by, *attributes, *names)


def complete_zones(stats: DataFrame, zones: DataFrame, zone: str = "zone_id", scene: str = "scene") -> DataFrame:
    """Every zone of the area in every scene: a zone without pixels has counts of 0 and nulls.

    A scene's first row brings the zones that it lacks, so the statistics are made once.  The zones of an area, a
    number each, are one row.
    """
    own = Window.partitionBy(scene)
    every = zones.agg(F.array_sort(F.collect_set(zone)).alias("__every"))
    out = stats.withColumns({"__seen": F.collect_set(zone).over(own), "__first": F.row_number().over(own.orderBy(zone)) == 1}).crossJoin(F.broadcast(every))
    lacks = F.when(F.col("__first"), F.array_except("__every", "__seen")).otherwise(F.array().cast(every.schema["__every"].dataType))
    out = out.withColumn("__zone", F.explode(F.concat(F.array(zone), lacks)))
    mine = F.col("__zone") == F.col(zone)
    values = {c: F.when(mine, F.col(c)) for c in stats.columns if c.startswith(tuple(f"{v}_" for v in VARIABLES))}
    values |= {f"{v}_n": F.when(mine, F.col(f"{v}_n")).otherwise(0) for v in VARIABLES}
    return out.withColumns(values).withColumn(zone, F.col("__zone")).select(*stats.columns)


def sensor_mix(df: DataFrame, by: Sequence[str], sensor: str = "sensor") -> DataFrame:
    """``L7x1, L8x2``: scenes of each sensor in a group."""
    counted = df.groupBy(*by, S.short_sensor(F.col(sensor)).alias("code")).agg(F.count("*").alias("k"))
    return _listed(counted, by)


def merge_mixes(df: DataFrame, by: Sequence[str], mix: str = "sensores_usados") -> DataFrame:
    """The sum of composition strings; what does not parse is left out."""
    part = df.select(*by, F.explode(F.split(mix, ",\\s*")).alias("p"))
    code, k = F.regexp_extract("p", r"^(.+)x(\d+)$", 1), F.regexp_extract("p", r"^(.+)x(\d+)$", 2).try_cast("long")
    parsed = part.select(*by, code.alias("code"), k.alias("k")).where("k is not null")
    return _listed(parsed.groupBy(*by, "code").agg(F.sum("k").alias("k")), by)


def _listed(counted: DataFrame, by: Sequence[str]) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct("code", F.format_string("%sx%d", "code", "k").alias("p"))))
    return counted.groupBy(*by).agg(F.array_join(F.transform(parts, lambda x: x["p"]), ", ").alias("sensores_usados"))


def merged_mix(mixes: Column) -> Column:
    """The sum of an array of composition strings; what does not parse is left out, null if nothing is left."""
    pattern = r"^(.+)x(\d+)$"
    pair = lambda p: F.struct(F.regexp_extract(p, pattern, 1).alias("code"), F.regexp_extract(p, pattern, 2).try_cast("long").alias("k"))
    parsed = F.filter(F.transform(F.split(F.array_join(mixes, ", "), ",\\s*"), pair), lambda x: x["k"].isNotNull())
    codes = F.array_sort(F.array_distinct(F.transform(parsed, lambda x: x["code"])))
    total = lambda c: F.aggregate(F.filter(parsed, lambda x: x["code"] == c), F.lit(0).cast("long"), lambda a, x: a + x["k"])
    text = F.array_join(F.transform(codes, lambda c: F.concat(c, F.lit("x"), total(c).cast("string"))), ", ")
    return F.nullif(text, F.lit(""))


#: Sensors by short name; they are few and fixed, so a group counts each in a column of its own.
SHORT = {name.replace("Landsat", "L"): name for name in sorted({s.name for s in SENSORS.values()})}


def _mix_of(prefix: str) -> Column:
    each = [F.when(F.col(prefix + code) > 0, F.format_string(f"{code}x%d", F.col(prefix + code))) for code in SHORT]
    return F.nullif(F.concat_ws(", ", *each), F.lit(""))


def months(spark: SparkSession, settings: Settings) -> DataFrame:
    years = spark.range(settings.year_start, settings.year_end + 1).select(F.col("id").cast("int").alias("ano"))
    return years.select("ano", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("mes"))


def _rolled(v: str) -> list[Column]:
    n = F.col(f"{v}_n")
    return [
        weighted_mean(F.col(f"{v}_media"), n).alias(f"{v}_media"),
        weighted_mean(F.col(f"{v}_mediana"), n).alias(f"{v}_mediana"),
        F.min(f"{v}_min").alias(f"{v}_min"),
        F.max(f"{v}_max").alias(f"{v}_max"),
        weighted_mean(F.col(f"{v}_dp"), n).alias(f"{v}_dp"),
        F.sum(n).alias(f"{v}_n"),
    ]


def monthly(stats: DataFrame, settings: Settings, zones: DataFrame | None = None, keys: Sequence[str] = (), scene: str = "scene") -> DataFrame:
    """Months of the calendar (times the zones), gaps as rows of nulls.

    Means, medians and deviations are weighted by valid pixels; cloud and sun by the scene's valid NDVI pixels.  Every
    zone is part of every scene of a month, with counts of 0 where it has no pixels: ``n_cenas`` and
    ``sensores_usados`` are the month's.  One aggregation: a scene is counted with its first zone, and the counts of a
    month's zones are added up over the small table of zones and months.
    """
    by = [*keys, "ano", "mes"]
    once = F.row_number().over(Window.partitionBy(scene).orderBy(*keys)) == 1 if keys else F.lit(True)
    sky = [weighted_mean(F.col(c), F.col("ndvi_n")).alias(f"{o}_med") for c, o in (("cloud_cover", "cloud_cover"), ("sun_elevation", "sun_elev")) if c in stats.columns]
    counts = {"n_cenas": F.count_if("__once")} | {f"__k{code}": F.count_if(F.col("__once") & (F.col("sensor") == name)) for code, name in SHORT.items()}
    rolled = stats.withColumn("__once", once).groupBy(*by).agg(*[c for v in VARIABLES for c in _rolled(v)], *sky, *[c.alias(n) for n, c in counts.items()])
    grid = months(stats.sparkSession, settings)
    if zones is not None:
        grid = zones.select(*keys).distinct().crossJoin(F.broadcast(grid))  # 12 rows a year
    out = grid.join(rolled, by, "left")
    if keys:
        month = Window.partitionBy("ano", "mes")
        out = out.withColumns({n: F.sum(n).over(month) for n in counts})
        out = out.withColumns({f"{v}_n": F.when(F.col("n_cenas") > 0, F.coalesce(f"{v}_n", F.lit(0))) for v in VARIABLES})
    out = out.withColumns({"sensores_usados": _mix_of("__k"), "data_ref": S.mid_month(F.col("ano"), F.col("mes"))}).drop(*[n for n in counts if n != "n_cenas"])
    return out.withColumn("mes_nome", S.month_name(F.col("data_ref")))


def annual(monthly_: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Years from months: means weighted by valid pixels, extremes of the months, and months that have data."""
    by = [*keys, "ano"]
    each = [
        c
        for v, short in (("ndvi", "ndvi"), ("lst_c", "lst"))
        for c in (
            weighted_mean(F.col(f"{v}_media"), F.col(f"{v}_n")).alias(f"{short}_media_anual"),
            F.min(f"{v}_min").alias(f"{short}_min_anual"),
            F.max(f"{v}_max").alias(f"{short}_max_anual"),
            F.coalesce(F.sum(f"{v}_n"), F.lit(0)).alias(f"{v}_n_total"),
        )
    ]
    mixes = F.collect_list("sensores_usados").alias("__mixes")  # twelve at most
    rolled = monthly_.groupBy(*by).agg(F.count("ndvi_media").alias("n_meses_com_dados"), *each, mixes)
    return rolled.withColumn("sensores_usados", merged_mix(F.col("__mixes"))).drop("__mixes")


def with_scene_weight(pixels: DataFrame, scene: str = "scene", stats: DataFrame | None = None) -> DataFrame:
    """Adds ``ndvi_n``, the scene's valid pixels, which weigh its part in a composite.

    Where the scenes' statistics are at hand they bring it, a row a scene; else it is counted beside the pixels.
    """
    if stats is not None:
        return pixels.join(stats.select(scene, "ndvi_n"), scene)
    return pixels.withColumn("ndvi_n", F.count("ndvi").over(Window.partitionBy(scene)))


def pixel_composite(pixels: DataFrame, by: Sequence[str], value: str, weight: str) -> DataFrame:
    """Per cell and period, the mean weighted over the scenes in which the cell is valid; empty cells drop out."""
    out = pixels.groupBy(*by).agg(weighted_mean(F.col(value), F.coalesce(weight, F.lit(1))).alias(value))
    return out.where(F.col(value).isNotNull())


def pixel_mean(pixels: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """The unweighted mean that maps show."""
    return pixels.groupBy(*by).agg(F.avg(value).alias(value)).where(F.col(value).isNotNull())


def good_months(months_: DataFrame, value: str, settings: Settings) -> DataFrame:
    """Months that have the value and are not on the list of low quality."""
    return months_.where(F.col(value).isNotNull() & ~S.low_quality(F.col("ano"), F.col("mes"), settings))


def long_run(zone_months: DataFrame, value: str, keys: Sequence[str], settings: Settings) -> DataFrame:
    """Per zone, over its good months: count, mean, median, deviation, extremes, range, variation and trend a year."""
    x = F.col(value)
    when = S.decimal_year(F.col("ano"), F.col("mes"))
    return good_months(zone_months, value, settings).groupBy(*keys).agg(
        F.count(x).alias("n_months"),
        F.avg(x).alias("mean"),
        F.median(x).alias("median"),
        F.stddev_samp(x).alias("sd"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        (F.max(x) - F.min(x)).alias("range"),
        cv_pct(x).alias("cv_pct"),
        slope(x, when, settings.trend_months).alias("trend"),
    )


def means_by(zone_months: DataFrame, value: str, by: Sequence[str], settings: Settings) -> DataFrame:
    """Climatology, annual means or the city's series over good months, by the grouping."""
    return good_months(zone_months, value, settings).groupBy(*by).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def with_long_run(zone_months: DataFrame, value: str, keys: Sequence[str], settings: Settings) -> DataFrame:
    """Each good month with its zone's mean and median, for plots of departures."""
    w = Window.partitionBy(*keys)
    return good_months(zone_months, value, settings).withColumns({"zone_mean": F.avg(value).over(w), "zone_median": F.median(value).over(w)})


def extreme_months(zone_months: DataFrame, value: str, zone: str, settings: Settings) -> DataFrame:
    """The months in which each zone was warmest and coolest, the earlier of equal ones."""
    at = F.struct(F.col(value), -F.unix_date("data_ref"))
    low = F.struct(F.col(value), F.unix_date("data_ref"))
    return good_months(zone_months, value, settings).groupBy(zone).agg(F.max_by("data_ref", at).alias("hottest_month"), F.min_by("data_ref", low).alias("coolest_month"))


def extremes(stats: DataFrame, k: int, measures: Sequence[str], key: str) -> DataFrame:
    """The ``k`` zones at either end of each measure, ties by key; the statistics are made once.

    The windows hold as many rows as there are zones.
    """
    long = stats.select(key, F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])).alias("m")).select(key, "m.*")
    by = Window.partitionBy("measure")
    ends = {"top": F.desc_nulls_last("value"), "bottom": F.asc_nulls_last("value")}
    placed = long.withColumns({f"__{end}": F.row_number().over(by.orderBy(order, key)) <= k for end, order in ends.items()})
    each = F.explode(F.filter(F.array(*[F.when(F.col(f"__{end}"), F.lit(end)) for end in ends]), lambda e: e.isNotNull()))
    return placed.select("measure", each.alias("end"), key, "value")


def area_mean(zone_years: DataFrame, value: str, by: Sequence[str] = ("ano",)) -> DataFrame:
    """The unweighted mean of zone values, as the annual chart shows it."""
    return zone_years.groupBy(*by).agg(F.avg(value).alias(value), F.count(value).alias("n_zones"))


def study_period(df: DataFrame, settings: Settings, year: str = "ano") -> Settings:
    """Settings with the first and last year of the data; an error without any year."""
    span = df.agg(F.min(year), F.max(year)).first()
    if span[0] is None:
        raise ValueError("no year in the table")
    return settings.with_values(year_start=int(span[0]), year_end=int(span[1]))
