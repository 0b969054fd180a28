"""Quality control of scenes: one conditional aggregation over pixels feeds every rule and the anomaly report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import QA_NAMES, Settings
from ..functions import pixels as P
from ..functions import scene as S


def with_products(pixels: DataFrame, settings: Settings, factors: dict[str, Column] | None = None) -> DataFrame:
    """Adds ``clear``, raw and bounded NDVI and surface temperature.

    ``factors`` are the scene's own ``sr_scale, sr_offset, st_scale, st_offset``; those not given are the collection's.
    """
    own = factors or {}
    sr = {k: own[f"sr_{k}"] for k in ("scale", "offset") if f"sr_{k}" in own}
    st = {k: own[f"st_{k}"] for k in ("scale", "offset") if f"st_{k}" in own}
    clear = P.is_clear(F.col("qa"), settings)
    red, nir = (P.masked(P.reflectance(F.col(f"dn_{b}"), **sr), clear) for b in ("red", "nir"))
    out = pixels.withColumns({"clear": clear, "sr_red": red, "sr_nir": nir, "dn_clear": P.masked(F.col("dn_st"), clear)})
    return out.withColumns(
        {
            "ndvi_raw": P.ndvi_raw(F.col("sr_red"), F.col("sr_nir")),
            "ndvi": P.ndvi(F.col("sr_red"), F.col("sr_nir"), settings),
            "below_sentinel": F.col("dn_clear") < P.sentinel_dn(settings, **st),
            "lst_raw": P.celsius(F.col("dn_clear"), **st),
            "lst_c": P.lst(F.col("dn_clear"), settings, **st),
        }
    )


def bit_breakdown(pixels: DataFrame, settings: Settings, qa: str = "qa") -> DataFrame:
    """Per quality bit: pixels that carry it, their percentage, and whether it is masked."""
    counts = pixels.agg(F.count(qa).alias("total"), *[F.coalesce(F.sum(P.bit(F.col(qa), b)), F.lit(0)).alias(f"b{b}") for b in range(8)])
    rows = F.explode(F.array(*[F.struct(F.lit(b).alias("bit"), F.lit(QA_NAMES[b]).alias("meaning"), F.col(f"b{b}").alias("n"), F.lit(b in settings.qa_bits).alias("masked")) for b in range(8)]))
    out = counts.select("total", rows.alias("r")).select("r.*", "total")
    return out.withColumn("pct", F.try_divide(100.0 * F.col("n"), F.nullif(F.col("total"), F.lit(0)))).drop("total")


def scene_measures(products: DataFrame, by: Sequence[str], settings: Settings, in_area: Column | None = None, in_box: Column | None = None) -> DataFrame:
    """Everything that rules and report need of a scene, in one pass; ``n_area`` counts the cells of the area's box."""
    area = F.lit(True) if in_area is None else in_area
    box = area if in_box is None else in_box
    beyond = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    kept_dn = ~F.coalesce(F.col("below_sentinel"), F.lit(False))
    return products.groupBy(*by).agg(
        F.count("*").alias("n_total_cena"),
        F.count_if("clear").alias("n_clear"),
        F.count_if(box).alias("n_area"),
        F.count(F.when(area, F.col("ndvi"))).alias("ndvi_n"),
        F.count(F.when(area, F.col("lst_c"))).alias("lst_n"),
        F.min("ndvi_raw").alias("ndvi_raw_min"),
        F.max("ndvi_raw").alias("ndvi_raw_max"),
        beyond(~F.col("ndvi_raw").between(settings.ndvi_min, settings.ndvi_max)).alias("ndvi_n_desc"),
        F.min("lst_raw").alias("lst_raw_min"),
        F.max("lst_raw").alias("lst_raw_max"),
        beyond(kept_dn & (F.col("lst_raw") < settings.lst_min)).alias("lst_n_abaixo"),
        beyond(F.col("lst_raw") > settings.lst_max).alias("lst_n_acima"),
        beyond(F.col("below_sentinel")).alias("lst_n_desc_dn"),
        beyond(P.at_bound(F.col("lst_c"), settings)).alias("n_at_bound"),
    )


def cascade(measures: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``pct_valido`` and ``reject``: the first rule that a scene fails, in the order of the run; null if it passes.

    ``n_scene`` counts the cells of whole scenes, where the other measures are those of a box.  A scene without valid
    temperatures passes the ratio rule; ``no_lst`` tells of it.
    """
    whole = "n_scene" if "n_scene" in measures.columns else "n_total_cena"
    valid = F.round(F.try_divide(100.0 * F.col("n_clear"), F.nullif(F.col(whole), F.lit(0))), 2)
    why = F.when(~F.coalesce(F.col("complete"), F.lit(False)), "incomplete") if "complete" in measures.columns else F.when(F.lit(False), "")
    if "overlap" in measures.columns and settings.min_overlap > 0:
        why = why.when(~(F.col("overlap") > settings.min_overlap), "overlap")
    area = F.try_divide(100.0 * F.col("ndvi_n"), F.nullif(F.col("n_area"), F.lit(0)))
    why = (
        why.when(F.col("pct_valido") < 100 * settings.min_scene_valid, "scene valid fraction")
        .when(F.coalesce(area, F.lit(0.0)) < 100 * settings.min_area_valid, "area valid fraction")
        .when((F.col("lst_n") > 0) & (F.col("ndvi_n") / F.greatest(F.col("lst_n"), F.lit(1)) > settings.max_ratio), "ndvi to lst ratio")
        .when(F.try_divide(F.col("n_at_bound").cast("double"), F.nullif(F.col("lst_n"), F.lit(0))) > settings.max_at_bound, "saturated thermal")
    )
    return measures.withColumn("pct_valido", valid).withColumns({"reject": why, "no_lst": F.col("lst_n") == 0})


def anomalies(measures: DataFrame, settings: Settings) -> DataFrame:
    """The anomaly report: percentages, flags and type of each scene, from ranges before any bound applies."""
    total = F.nullif(F.col("n_total_cena"), F.lit(0))
    out = measures.withColumn("lst_n_desc", F.col("lst_n_abaixo") + F.col("lst_n_acima"))
    share = lambda c: F.try_divide(100.0 * F.col(c), total)
    out = out.withColumns(
        {"pct_ndvi_desc": share("ndvi_n_desc"), "pct_lst_desc": share("lst_n_desc"), "pct_lst_abaixo": share("lst_n_abaixo"), "pct_lst_acima": share("lst_n_acima"), "pct_dn_desc": share("lst_n_desc_dn")}
    )
    yes = lambda c: F.coalesce(c, F.lit(False))
    kind = (
        F.when((F.col("lst_n_desc_dn") > 0) & (F.col("lst_n_desc") > 0), "sentinel DN + LST clamp")
        .when(F.col("lst_n_desc_dn") > 0, "sentinel DN (border/SLC-off)")
        .when((F.col("lst_n_abaixo") > 0) & (F.col("lst_n_acima") > 0), "LST both cold and hot")
        .when(F.col("lst_n_abaixo") > 0, "LST below minimum")
        .when(F.col("lst_n_acima") > 0, "LST above maximum")
        .when(F.col("ndvi_n_desc") > 0, "NDVI outside [-1,1]")
        .otherwise("no anomaly")
    )
    return out.withColumns(
        {
            "flag_lst_cold": yes(F.col("lst_raw_min") < settings.lst_min),
            "flag_lst_hot": yes(F.col("lst_raw_max") > settings.lst_max),
            "flag_ndvi_anom": yes((F.col("ndvi_raw_min") < settings.ndvi_min)) | yes(F.col("ndvi_raw_max") > settings.ndvi_max),
            "flag_critical": yes(F.col("pct_lst_desc") > settings.critical_pct) | yes(F.col("pct_dn_desc") > settings.critical_pct),
            "anomaly_type": kind,
        }
    )


def anomaly_summary(report: DataFrame, by: str) -> DataFrame:
    """Scenes, flags, extremes and mean percentages by sensor or year."""
    return report.groupBy(by).agg(
        F.count("*").alias("n_cenas"),
        F.count_if("flag_lst_cold").alias("n_lst_cold"),
        F.count_if("flag_lst_hot").alias("n_lst_hot"),
        F.count_if("flag_ndvi_anom").alias("n_ndvi_anom"),
        F.count_if("flag_critical").alias("n_critical"),
        F.min("lst_raw_min").alias("lst_abs_min"),
        F.max("lst_raw_max").alias("lst_abs_max"),
        F.avg("pct_lst_desc").alias("pct_lst_desc_med"),
        F.sum("lst_n_desc").alias("lst_n_desc_total"),
    )


def critical(report: DataFrame) -> DataFrame:
    return report.where("flag_critical")


def advisory(report: DataFrame) -> DataFrame:
    """Whether more than half of the scenes touch a temperature bound, which then is probably wrong."""
    counts = report.agg(F.count("*").alias("n"), F.count_if("flag_lst_cold").alias("n_cold"), F.count_if("flag_lst_hot").alias("n_hot"))
    return counts.withColumn("check_bounds", F.greatest("n_cold", "n_hot") > F.col("n") * 0.5)


def diagnose(products: DataFrame, settings: Settings) -> DataFrame:
    """One scene's thermal numbers: range, fill, numbers beyond the bounds, verdict."""
    filled = F.col("dn_st") != 0
    out = products.agg(
        F.count("*").alias("n"),
        F.count_if(~filled).alias("n_fill"),
        F.min(F.when(filled, F.col("dn_st"))).alias("dn_min"),
        F.max(F.when(filled, F.col("dn_st"))).alias("dn_max"),
        F.count_if(filled & F.coalesce(F.col("below_sentinel"), F.lit(False))).alias("n_below"),
        F.count_if(filled & F.coalesce(F.col("lst_raw") > settings.lst_max, F.lit(False))).alias("n_above"),
        F.count("ndvi").alias("ndvi_n"),
        F.avg("ndvi").alias("ndvi_mean"),
        F.count("lst_c").alias("lst_n"),
        F.avg("lst_c").alias("lst_mean"),
    )
    verdict = F.when(F.col("lst_n") == 0, "no valid temperature").when(F.col("n_below") > 0, "sentinel numbers present").when(F.col("n_above") > 0, "numbers above the bound").otherwise("in range")
    return out.withColumn("verdict", verdict)


def month_named(report: DataFrame) -> DataFrame:
    return report.withColumn("mes_nome", S.month_name(F.col("data_aq")))
