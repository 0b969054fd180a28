"""Which months have data, for the area and for its zones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import scene as S
from .series import months


def calendar(city: DataFrame, settings: Settings) -> DataFrame:
    """A row a month: what it has, its status and symbol; ``city`` is ``ano, mes, ndvi_media, lst_c_media``."""
    grid = months(city.sparkSession, settings)
    out = grid.join(city.select("ano", "mes", "ndvi_media", "lst_c_media"), ["ano", "mes"], "left")
    n, t = F.col("ndvi_media").isNotNull(), F.col("lst_c_media").isNotNull()
    status = F.when(n & t, "NDVI + LST").when(n, "NDVI only").when(t, "LST only").otherwise("No data")
    flagged = S.low_quality(F.col("ano"), F.col("mes"), settings)
    out = out.withColumns({"has_ndvi": n, "has_lst": t, "flagged": flagged, "status": F.when(flagged & (n | t), "Flagged: low quality").otherwise(status)})
    symbol = F.when(F.col("status") == "NDVI + LST", "O").when(F.col("status") == "NDVI only", "n").when(F.col("status") == "LST only", "l").when(F.col("status") == "No data", ".").otherwise("!")
    return out.withColumns({"symbol": symbol, "season": S.season(F.col("mes"), settings)})


def zone_coverage(zone_months: DataFrame, settings: Settings, zone: str = "zone_id") -> DataFrame:
    """Share of all zones with data, by month; months without any scene count 0."""
    total = zone_months.agg(F.count_distinct(zone).alias("n_zones_total"))
    counted = zone_months.groupBy("ano", "mes").agg(F.count("ndvi_media").alias("n_zones_ndvi"), F.count("lst_c_media").alias("n_zones_lst"))
    out = months(zone_months.sparkSession, settings).join(counted, ["ano", "mes"], "left").crossJoin(F.broadcast(total))  # one row
    n = {c: F.coalesce(c, F.lit(0)) for c in ("n_zones_ndvi", "n_zones_lst")}
    share = lambda c: F.round(F.coalesce(F.try_divide(100.0 * n[c], F.nullif(F.col("n_zones_total"), F.lit(0))), F.lit(0.0)), 1)
    return out.withColumns(n | {"pct_ndvi": share("n_zones_ndvi"), "pct_lst": share("n_zones_lst")})


def by_year(calendar_: DataFrame) -> DataFrame:
    """Complete, partial and empty months, flagged ones, and seasons that have data."""
    any_ = F.col("has_ndvi") | F.col("has_lst")
    return calendar_.groupBy("ano").agg(
        F.count_if(F.col("has_ndvi") & F.col("has_lst")).alias("n_complete"),
        F.count_if(F.col("has_ndvi") != F.col("has_lst")).alias("n_partial"),
        F.count_if(~any_).alias("n_empty"),
        F.count_if(F.col("status") == "Flagged: low quality").alias("n_flagged"),
        F.count_distinct(F.when(any_, F.col("season"))).alias("n_seasons"),
    )


def overall(calendar_: DataFrame) -> DataFrame:
    any_ = F.col("has_ndvi") | F.col("has_lst")
    out = calendar_.agg(F.count("*").alias("n_months"), F.count_if(any_).alias("n_any"), F.count_if(F.col("status") == "Flagged: low quality").alias("n_flagged"))
    return out.withColumn("pct_any", F.round(F.try_divide(100.0 * F.col("n_any"), F.nullif(F.col("n_months"), F.lit(0))), 1))


def wide(calendar_: DataFrame, value: str = "symbol") -> DataFrame:
    """Years by months."""
    out = calendar_.groupBy("ano").pivot("mes", list(range(1, 13))).agg(F.first(value))
    return out.withColumnsRenamed({str(m): f"m{m:02d}" for m in range(1, 13)})


def long(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.unpivot(keys, columns, "variable", "value")
