"""Surface temperature against a station's series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Settings
from ..functions import scene as S
from ..functions.statistics import pearson, with_ranks


def matched(months: DataFrame, station: DataFrame, settings: Settings, value: str = "lst_c_media", temperature: str = "temp") -> DataFrame:
    """Months of good quality in both series, with ``offset``: surface less air."""
    good = months.where(F.col(value).isNotNull() & ~S.low_quality(F.col("ano"), F.col("mes"), settings))
    joined = good.join(station.where(F.col(temperature).isNotNull()), ["ano", "mes"])
    return joined.withColumn("offset", F.col(value) - F.col(temperature))


def enough_months(pairs: DataFrame, least: int = 10) -> DataFrame:
    """The pairs, or an error where both series share too few months for a correlation of the whole area."""
    if (n := pairs.limit(least).count()) < least:
        raise ValueError(f"{n} months have both series, fewer than {least}: do they cover the same years?")
    return pairs


def correlation(pairs: DataFrame, by: Sequence[str] = (), value: str = "lst_c_media", temperature: str = "temp", least: int = 2) -> DataFrame:
    """Pearson, Spearman, and the line of ``value`` on ``temperature``, for groups of at least ``least`` months."""
    keyed = pairs if by else pairs.withColumn("__all", F.lit(1))
    keys = list(by) or ["__all"]
    enough = keyed.withColumn("__n", F.count("*").over(Window.partitionBy(*keys))).where(F.col("__n") >= least)
    ranked = with_ranks(enough, temperature, value, keys)
    x, y = F.col(temperature), F.col(value)
    out = ranked.groupBy(*keys).agg(
        F.count("*").alias("n_months"),
        pearson(x, y).alias("pearson"),
        pearson(F.col("rank_x"), F.col("rank_y")).alias("spearman"),
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.avg(y - x).alias("mean_offset"),
    )
    strength = F.when(F.abs("pearson") > 0.7, "strong").when(F.abs("pearson") > 0.4, "moderate").otherwise("weak")
    kind = F.when(F.col("slope") > 1.2, "amplified").when(F.col("slope") < 0.8, "damped").otherwise("proportional")
    out = out.withColumns({"strength": F.when(F.col("pearson").isNotNull(), strength), "response": F.when(F.col("slope").isNotNull(), kind)})
    return out if by else out.drop("__all")


def offset_summary(pairs: DataFrame) -> DataFrame:
    o = F.col("offset")
    return pairs.agg(F.avg(o).alias("mean"), F.median(o).alias("median"), F.stddev_samp(o).alias("sd"), F.min(o).alias("min"), F.max(o).alias("max"))
