"""Ranks of zones within months, and how they persist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Settings
from ..functions.statistics import average_rank, pearson
from .series import good_months


def monthly_ranks(zone_months: DataFrame, value: str, settings: Settings, zone: str = "zone_id") -> DataFrame:
    """Of good months: rank (coolest 1, ties at their mean), its place from 0 to 1, group, and distance from the
    unweighted city mean.

    The partition is a month: as many rows as zones.
    """
    rows = good_months(zone_months, value, settings).select(zone, "ano", "mes", F.col(value).alias("value"))
    month = Window.partitionBy("ano", "mes")
    rows = rows.withColumns({"rank": average_rank("value", ["ano", "mes"]), "n_zones": F.count("*").over(month), "city_mean": F.avg("value").over(month)})
    n = settings.top_n
    group = F.when(F.col("rank") <= n, "coolest").when(F.col("rank") > F.col("n_zones") - n, "warmest").otherwise("middle")
    place = F.try_divide(F.col("rank") - 1, (F.col("n_zones") - 1).cast("double"))
    return rows.withColumns({"rank_norm": place, "group": group, "delta": F.col("value") - F.col("city_mean")})


def persistence(ranked: DataFrame, zone: str = "zone_id") -> DataFrame:
    """Per zone: ranks, share of months among the warmest and coolest, distance from the city, tie to it."""
    share = lambda c: 100 * F.avg(F.when(c, 1.0).otherwise(0.0))
    out = ranked.groupBy(zone).agg(
        F.count("*").alias("n_months"),
        F.avg("rank").alias("mean_rank"),
        F.stddev_samp("rank").alias("sd_rank"),
        F.min("rank").alias("min_rank"),
        F.max("rank").alias("max_rank"),
        F.avg("rank_norm").alias("mean_rank_norm"),
        share(F.col("group") == "warmest").alias("pct_warmest"),
        share(F.col("group") == "coolest").alias("pct_coolest"),
        F.avg("delta").alias("mean_delta"),
        share(F.col("delta") > 0).alias("pct_above_city"),
        pearson(F.col("value"), F.col("city_mean"), 3).alias("corr_city"),
    )
    label = F.when(F.col("pct_warmest") >= 80, "persistently warm").when(F.col("pct_coolest") >= 80, "persistently cool").when(F.greatest("pct_warmest", "pct_coolest") >= 50, "frequently extreme").otherwise("variable")
    return out.withColumn("label", label)


def amplitude(ranked: DataFrame) -> DataFrame:
    """Spread between zones, by month, and the zones at its ends."""
    return ranked.groupBy("ano", "mes").agg(
        (F.max("value") - F.min("value")).alias("amplitude"),
        F.first("n_zones").alias("n_zones"),
    )


def structure(persistent: DataFrame) -> DataFrame:
    """Whether at least five zones are persistently warm, or cool."""
    out = persistent.agg(F.count_if(F.col("pct_warmest") >= 80).alias("n_warm"), F.count_if(F.col("pct_coolest") >= 80).alias("n_cool"))
    return out.withColumn("structural", (F.col("n_warm") >= 5) | (F.col("n_cool") >= 5))
