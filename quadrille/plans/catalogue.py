"""All queries over the driver's tables, and the SQL that another engine checks them with.

``QUERIES`` give values as they are.  ``compared`` and ``compared_sql`` bring a query's doubles, and those of its SQL,
to six digits for a comparison by equality.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scene as S
from ..functions.statistics import HAIR, on_grid
from ..operators import agreement as G
from ..operators import climate as K
from ..operators import coverage as V
from ..operators import figures as U
from ..operators import inventory as I
from ..operators import pairwise as W
from ..operators import quality as Q
from ..operators import ranking as N
from ..operators import raster as X
from ..operators import series as R
from ..operators import spatial as P
from ..sources import metadata as M
from ..sources.sinks import parked
from . import proxies as D
from .proxies import SETTINGS, SQL, SQL_MONTHLY, SQL_STATS, annual_sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
#: Doubles of a query that are sums or means; the others come from one and the same arithmetic on both sides.
FLOATS: dict[str, list[str]] = {}


def query(sql: str | None, floats: str = "") -> Callable[[Query], Query]:
    """Register a function under its name, with its SQL and the names of its summed doubles."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__], FLOATS[f.__name__] = f, floats.split()
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def compared(name: str) -> Query:
    return (lambda spark, sf: on_grid(QUERIES[name](spark, sf))) if FLOATS[name] else QUERIES[name]


def compared_sql(name: str) -> str:
    replace = ", ".join(f"round({c} + {HAIR}, 6) + 0e0 AS {c}" for c in FLOATS[name])
    return f"SELECT * REPLACE ({replace}) FROM ({ORACLES[name]})" if replace else ORACLES[name]


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


SIX_FLOATS = " ".join(f"{v}_{x}" for v in ("ndvi", "lst_c") for x in ("media", "mediana", "min", "max", "dp"))

# --- inventory and metadata -------------------------------------------------------------------------------------------


@query(_with(SQL, "SELECT scene, scene_id, sensor_prefix, sensor, acq_date, ano AS year, mes AS month, pathrow, tier, CASE WHEN sensor_prefix IN ('LC08', 'LC09') THEN 'SR_B4' ELSE 'SR_B3' END AS tag_red, CASE WHEN sensor_prefix IN ('LC08', 'LC09') THEN 'ST_B10' ELSE 'ST_B6' END AS tag_thermal FROM scenes"))
def scene_inventory(spark: SparkSession, sf: str) -> DataFrame:
    columns = "scene scene_id sensor_prefix sensor acq_date year month pathrow tier tag_red tag_thermal"
    return D.scenes(spark, sf).select(*columns.split())


@query(_with(SQL, """SELECT CASE WHEN NOT regexp_matches(scene_id, '^(LC08|LC09|LE07|LT05|LT04)_L2SP_') THEN 'name' WHEN acq_date IS NULL THEN 'date'
  WHEN year(acq_date) NOT BETWEEN 1997 AND 2000 THEN 'period' WHEN month(acq_date) NOT IN (1, 2, 3, 10, 11, 12) THEN 'month'
  WHEN tier NOT IN ('T1', 'RT') THEN 'tier' ELSE 'kept' END AS outcome, count(*) AS n FROM decoded GROUP BY ALL"""))
def scene_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    settings = SETTINGS.with_values(year_start=1997, year_end=2000, months=(1, 2, 3, 10, 11, 12))
    return I.audit(I.decode(D.scene_names(spark, sf)), settings).groupBy("outcome").agg(F.count("*").alias("n"))


MTL = r"""'GROUP = LEVEL1_RADIOMETRIC_RESCALING\n    REFLECTANCE_MULT_BAND_4 = 9.9999E-05\n  END_GROUP = LEVEL1_RADIOMETRIC_RESCALING\n  GROUP = IMAGE_ATTRIBUTES\n    CLOUD_COVER = ' || {cloud} || '\n  END_GROUP = IMAGE_ATTRIBUTES\n' ||
  CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE '  GROUP = LEVEL2_SURFACE_REFLECTANCE_PARAMETERS\n    REFLECTANCE_MULT_BAND_4 = ' || {scale} || '\n  END_GROUP = LEVEL2_SURFACE_REFLECTANCE_PARAMETERS\n' END"""
_MTL_SPARK = MTL.format(cloud="cast(o_orderkey % 100 AS string)", scale="CASE WHEN o_orderkey % 3 = 0 THEN '3.0e-05' ELSE '2.75e-05' END")
_MTL_DUCK = MTL.replace("'GROUP", "E'GROUP").replace("|| '\\n", "|| E'\\n").replace("THEN '' ELSE '  GROUP", "THEN '' ELSE E'  GROUP").format(cloud="(o_orderkey % 100)::VARCHAR", scale="CASE WHEN o_orderkey % 3 = 0 THEN '3.0e-05' ELSE '2.75e-05' END")


@query(f"""WITH t AS (SELECT o_orderkey AS scene, {_MTL_DUCK} AS mtl FROM orders),
s AS (SELECT scene, try_cast(nullif(regexp_extract(regexp_extract(mtl, '(?ms)^\\s*GROUP\\s*=\\s*LEVEL2_SURFACE_REFLECTANCE_PARAMETERS\\s*$(.*?)^\\s*END_GROUP', 1), '(?m)^\\s*REFLECTANCE_MULT_BAND_4\\s*=\\s*(.*?)\\s*$', 1), '') AS DOUBLE) AS v,
  try_cast(regexp_extract(mtl, 'CLOUD_COVER = (\\d+)', 1) AS DOUBLE) AS cloud_cover FROM t)
SELECT scene, coalesce(v, 2.75e-5) AS sr_scale, abs(coalesce(v, 2.75e-5) - 2.75e-5) > 1e-8 AS sr_scale_differs, 3.41802e-3 AS st_scale, cloud_cover FROM s""", "sr_scale st_scale cloud_cover")
def mtl_text_parse(spark: SparkSession, sf: str) -> DataFrame:
    texts = D.table(spark, sf, "orders").select(F.col("o_orderkey").alias("scene"), F.expr(_MTL_SPARK).alias("mtl_text"))
    return M.factors(texts, mtl_json=None).select("scene", "sr_scale", "sr_scale_differs", "st_scale", "cloud_cover")


@query("""SELECT event_id, coalesce(CASE WHEN event_id % 4 > 0 THEN (json_extract(props, '$.k')::DOUBLE) / 1e6 END, 2.75e-5) AS sr_scale, event_id % 4 > 1 AS has_sun,
  CASE WHEN event_id % 4 > 1 THEN json_extract(props, '$.k')::DOUBLE END AS sun_elevation FROM events""", "sr_scale sun_elevation")
def mtl_json_parse(spark: SparkSession, sf: str) -> DataFrame:
    e = D.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    refl = F.concat(F.lit('"LEVEL2_SURFACE_REFLECTANCE_PARAMETERS": {"REFLECTANCE_MULT_BAND_3": "'), (k.cast("double") / 1e6).cast("string"), F.lit('"}'))
    sun = F.concat(F.lit(', "IMAGE_ATTRIBUTES": {"SUN_ELEVATION": '), k, F.lit("}"))
    inner = F.concat(refl, F.when(F.col("event_id") % 4 > 1, sun).otherwise(""))
    text = F.when(F.col("event_id") % 4 == 0, F.lit(None)).when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"LANDSAT_METADATA_FILE": {'), inner, F.lit("}}"))).otherwise(F.concat(F.lit("{"), inner, F.lit("}")))
    out = M.factors(e.select("event_id", text.alias("mtl_json")), mtl_text=None)
    return out.select("event_id", "sr_scale", F.col("sun_elevation").isNotNull().alias("has_sun"), "sun_elevation")


# --- pixels -----------------------------------------------------------------------------------------------------------

_NAMES = "['fill', 'dilated cloud', 'cirrus', 'cloud', 'cloud shadow', 'snow', 'clear', 'water']"


@query(_with(SQL, f"SELECT b::INT AS bit, {_NAMES}[b + 1] AS meaning, sum((qa >> b::INT) & 1)::BIGINT AS n, b IN (0, 1, 3, 4, 5, 7) AS masked, 100e0 * sum((qa >> b::INT) & 1) / count(*) AS pct FROM pixels, range(8) r(b) GROUP BY b"), "pct")
def qa_bit_breakdown(spark: SparkSession, sf: str) -> DataFrame:
    return Q.bit_breakdown(D.pixels(spark, sf), SETTINGS)


@query(_with(SQL, "SELECT scene, count(*) AS n, count_if((qa & 187) = 0) AS n_clear, 100e0 * count_if((qa & 187) = 0) / count(*) AS pct, 100e0 * count_if((qa & 187) = 0) / count(*) < 10 AS rejected FROM pixels GROUP BY scene"), "pct")
def qa_scene_valid_fraction(spark: SparkSession, sf: str) -> DataFrame:
    from ..functions.pixels import is_clear

    out = D.pixels(spark, sf).groupBy("scene").agg(F.count("*").alias("n"), F.count_if(is_clear(F.col("qa"), SETTINGS)).alias("n_clear"))
    out = out.withColumn("pct", 100.0 * F.col("n_clear") / F.col("n"))
    return out.withColumn("rejected", F.col("pct") < 100 * SETTINGS.min_scene_valid)


@query(_with(SQL, "SELECT scene, cell, line, sr_red, sr_nir FROM products"))
def calibrate_reflectance(spark: SparkSession, sf: str) -> DataFrame:
    return D.products(spark, sf).select("scene", "cell", "line", "sr_red", "sr_nir")


@query(_with(SQL, "SELECT scene, cell, line, ndvi FROM products"), "ndvi")
def ndvi_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return D.products(spark, sf).select("scene", "cell", "line", "ndvi")


@query(_with(SQL, "SELECT scene, cell, line, below_sentinel, lst_raw, lst_c FROM products"), "lst_raw lst_c")
def lst_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return D.products(spark, sf).select("scene", "cell", "line", "below_sentinel", "lst_raw", "lst_c")


# --- statistics and rollups -------------------------------------------------------------------------------------------


@query(_with(SQL_STATS, "SELECT * FROM scene_stats"), SIX_FLOATS + " cloud_cover sun_elevation")
def scene_stats(spark: SparkSession, sf: str) -> DataFrame:
    return D.scene_stats(spark, sf)


@query(_with(SQL_STATS, "SELECT * FROM zone_scene_stats"), SIX_FLOATS + " cloud_cover sun_elevation")
def zone_scene_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.complete_zones(D.zone_scene_stats(spark, sf), D.zones(spark, sf))


SKY = " cloud_cover_med sun_elev_med"


@query(_with(SQL_MONTHLY, "SELECT * FROM monthly"), SIX_FLOATS + SKY)
def area_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return D.monthly(spark, sf)


ANNUAL = "ndvi_media_anual ndvi_min_anual ndvi_max_anual lst_media_anual lst_min_anual lst_max_anual"


@query(_with(SQL_MONTHLY, annual_sql("monthly", "ano")), ANNUAL)
def area_annual(spark: SparkSession, sf: str) -> DataFrame:
    return R.annual(D.monthly(spark, sf))


@query(_with(SQL_MONTHLY, "SELECT * FROM zone_monthly"), SIX_FLOATS + SKY)
def zone_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return D.zone_monthly(spark, sf)


@query(_with(SQL_MONTHLY, annual_sql("zone_monthly", "zone_id, ano")), ANNUAL)
def zone_annual(spark: SparkSession, sf: str) -> DataFrame:
    return R.annual(D.zone_monthly(spark, sf), ("zone_id",))


def _composite(by: str, v: str) -> str:
    return _with(SQL_STATS, f"""SELECT {by}, sum({v} * ndvi_n) / sum(CASE WHEN {v} IS NOT NULL THEN ndvi_n END) AS {v}
  FROM (SELECT * FROM products JOIN (SELECT scene, ndvi_n FROM scene_stats WHERE ndvi_n > 0) USING (scene)) GROUP BY {by} HAVING count({v}) > 0""")


def _weighted_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_scene_weight(D.products(spark, sf))


@query(_composite("ano, mes, cell", "ndvi"), "ndvi")
def pixel_composite_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return R.pixel_composite(_weighted_pixels(spark, sf), ["ano", "mes", "cell"], "ndvi", "ndvi_n")


@query(_composite("ano, cell", "lst_c"), "lst_c")
def pixel_composite_annual(spark: SparkSession, sf: str) -> DataFrame:
    return R.pixel_composite(_weighted_pixels(spark, sf), ["ano", "cell"], "lst_c", "ndvi_n")


@query(_with(SQL, "SELECT ano, cell, format('{:04d}', ano) AS periodo, avg(ndvi) AS ndvi FROM products GROUP BY ALL HAVING count(ndvi) > 0"), "ndvi")
def pixel_mean_display(spark: SparkSession, sf: str) -> DataFrame:
    out = R.pixel_mean(D.products(spark, sf), ["ano", "cell"], "ndvi")
    return out.withColumn("periodo", S.period(F.col("ano")))


@query(_with(SQL, """SELECT 'month' AS grain, ano, mes, string_agg(code || 'x' || k, ', ' ORDER BY code) AS sensores_usados
  FROM (SELECT ano, mes, replace(sensor, 'Landsat', 'L') AS code, count(*) AS k FROM scenes GROUP BY ALL) GROUP BY ALL
  UNION ALL SELECT 'year', ano, NULL, string_agg(code || 'x' || k, ', ' ORDER BY code)
  FROM (SELECT ano, replace(sensor, 'Landsat', 'L') AS code, count(*) AS k FROM scenes GROUP BY ALL) GROUP BY ALL"""))
def sensor_mix_strings(spark: SparkSession, sf: str) -> DataFrame:
    s = D.scenes(spark, sf).withColumnsRenamed({"year": "ano", "month": "mes"})
    by_month = R.sensor_mix(s, ["ano", "mes"])
    by_year = R.merge_mixes(by_month, ["ano"]).select(F.lit("year").alias("grain"), "ano", F.lit(None).cast("int").alias("mes"), "sensores_usados")
    return by_month.select(F.lit("month").alias("grain"), "ano", "mes", "sensores_usados").unionByName(by_year)


# --- quality ----------------------------------------------------------------------------------------------------------

MEASURES = SQL + """, measures AS (
  SELECT scene, sensor, acq_date AS data_aq, ano, count(*) AS n_total_cena, count(CASE WHEN clear THEN 1 END) AS n_clear, count(CASE WHEN zone_id <> 24 THEN 1 END) AS n_area,
    count(CASE WHEN zone_id <> 24 THEN ndvi END) AS ndvi_n, count(CASE WHEN zone_id <> 24 THEN lst_c END) AS lst_n,
    min(ndvi_raw) AS ndvi_raw_min, max(ndvi_raw) AS ndvi_raw_max, count(CASE WHEN ndvi_raw NOT BETWEEN -1 AND 1 THEN 1 END) AS ndvi_n_desc,
    min(lst_raw) AS lst_raw_min, max(lst_raw) AS lst_raw_max, count(CASE WHEN NOT below_sentinel AND lst_raw < -20 THEN 1 END) AS lst_n_abaixo,
    count(CASE WHEN lst_raw > 75 THEN 1 END) AS lst_n_acima, count(CASE WHEN below_sentinel THEN 1 END) AS lst_n_desc_dn, count(CASE WHEN abs(lst_c + 20) < 0.05 OR abs(lst_c - 75) < 0.05 THEN 1 END) AS n_at_bound
  FROM products GROUP BY ALL),
report AS (
  SELECT *, lst_n_abaixo + lst_n_acima AS lst_n_desc, 100e0 * ndvi_n_desc / n_total_cena AS pct_ndvi_desc, 100e0 * (lst_n_abaixo + lst_n_acima) / n_total_cena AS pct_lst_desc,
    100e0 * lst_n_abaixo / n_total_cena AS pct_lst_abaixo, 100e0 * lst_n_acima / n_total_cena AS pct_lst_acima, 100e0 * lst_n_desc_dn / n_total_cena AS pct_dn_desc,
    coalesce(lst_raw_min < -20, false) AS flag_lst_cold, coalesce(lst_raw_max > 75, false) AS flag_lst_hot,
    coalesce(ndvi_raw_min < -1 OR ndvi_raw_max > 1, false) AS flag_ndvi_anom,
    100e0 * (lst_n_abaixo + lst_n_acima) / n_total_cena > 5 OR 100e0 * lst_n_desc_dn / n_total_cena > 5 AS flag_critical,
    CASE WHEN lst_n_desc_dn > 0 AND lst_n_abaixo + lst_n_acima > 0 THEN 'sentinel DN + LST clamp' WHEN lst_n_desc_dn > 0 THEN 'sentinel DN (border/SLC-off)'
      WHEN lst_n_abaixo > 0 AND lst_n_acima > 0 THEN 'LST both cold and hot' WHEN lst_n_abaixo > 0 THEN 'LST below minimum' WHEN lst_n_acima > 0 THEN 'LST above maximum'
      WHEN ndvi_n_desc > 0 THEN 'NDVI outside [-1,1]' ELSE 'no anomaly' END AS anomaly_type
  FROM measures)
"""
RAW = "ndvi_raw_min ndvi_raw_max lst_raw_min lst_raw_max"
PCT = RAW + " pct_ndvi_desc pct_lst_desc pct_lst_abaixo pct_lst_acima pct_dn_desc"


def _measures(spark: SparkSession, sf: str) -> DataFrame:
    p = D.products(spark, sf).withColumn("data_aq", F.col("acq_date"))
    return Q.scene_measures(p, ["scene", "sensor", "data_aq", "ano"], SETTINGS, F.col("zone_id") != 24)


def _report(spark: SparkSession, sf: str) -> DataFrame:
    return Q.anomalies(_measures(spark, sf), SETTINGS)


@query(_with(MEASURES, """SELECT * EXCLUDE (data_aq), round(100e0 * n_clear / n_total_cena, 2) AS pct_valido, CASE
    WHEN round(100e0 * n_clear / n_total_cena, 2) < 10 THEN 'scene valid fraction' WHEN coalesce(100e0 * ndvi_n / nullif(n_area, 0), 0) < 10 THEN 'area valid fraction'
    WHEN lst_n > 0 AND ndvi_n / greatest(lst_n, 1) > 5 THEN 'ndvi to lst ratio' WHEN n_at_bound / nullif(lst_n, 0) > 0.01 THEN 'saturated thermal' END AS reject, lst_n = 0 AS no_lst FROM measures"""), RAW + " pct_valido")
def scene_qc_cascade(spark: SparkSession, sf: str) -> DataFrame:
    return Q.cascade(_measures(spark, sf), SETTINGS).drop("data_aq")


@query(_with(MEASURES, "SELECT * FROM report"), PCT)
def anomaly_per_scene(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf)


_SUMMARY = "count(*) AS n_cenas, count_if(flag_lst_cold) AS n_lst_cold, count_if(flag_lst_hot) AS n_lst_hot, count_if(flag_ndvi_anom) AS n_ndvi_anom, count_if(flag_critical) AS n_critical, min(lst_raw_min) AS lst_abs_min, max(lst_raw_max) AS lst_abs_max, avg(pct_lst_desc) AS pct_lst_desc_med, sum(lst_n_desc)::BIGINT AS lst_n_desc_total"


@query(_with(MEASURES, f"SELECT sensor, {_SUMMARY} FROM report GROUP BY sensor"), "lst_abs_min lst_abs_max pct_lst_desc_med")
def anomaly_by_sensor(spark: SparkSession, sf: str) -> DataFrame:
    return Q.anomaly_summary(_report(spark, sf), "sensor")


@query(_with(MEASURES, f"SELECT ano, {_SUMMARY} FROM report GROUP BY ano"), "lst_abs_min lst_abs_max pct_lst_desc_med")
def anomaly_by_year(spark: SparkSession, sf: str) -> DataFrame:
    return Q.anomaly_summary(_report(spark, sf), "ano")


@query(_with(MEASURES, "SELECT scene, sensor, data_aq, strftime(data_aq, '%B') AS mes_nome, pct_lst_desc, anomaly_type FROM report WHERE flag_critical"), "pct_lst_desc")
def critical_scenes(spark: SparkSession, sf: str) -> DataFrame:
    return Q.month_named(Q.critical(_report(spark, sf))).select("scene", "sensor", "data_aq", "mes_nome", "pct_lst_desc", "anomaly_type")


@query(_with(MEASURES, "SELECT count(*) AS n, count_if(flag_lst_cold) AS n_cold, count_if(flag_lst_hot) AS n_hot, greatest(count_if(flag_lst_cold), count_if(flag_lst_hot)) > count(*) * 0.5 AS check_bounds FROM report"))
def anomaly_advisory(spark: SparkSession, sf: str) -> DataFrame:
    return Q.advisory(_report(spark, sf))


@query(_with(SQL, """SELECT *, CASE WHEN lst_n = 0 THEN 'no valid temperature' WHEN n_below > 0 THEN 'sentinel numbers present' WHEN n_above > 0 THEN 'numbers above the bound' ELSE 'in range' END AS verdict
  FROM (SELECT count(*) AS n, count_if(dn_st = 0) AS n_fill, min(nullif(dn_st, 0)) AS dn_min, max(nullif(dn_st, 0)) AS dn_max, count(CASE WHEN dn_st <> 0 AND below_sentinel THEN 1 END) AS n_below,
    count(CASE WHEN dn_st <> 0 AND lst_raw > 75 THEN 1 END) AS n_above, count(ndvi) AS ndvi_n, avg(ndvi) AS ndvi_mean, count(lst_c) AS lst_n, avg(lst_c) AS lst_mean FROM products WHERE sensor = 'Landsat8')"""), "ndvi_mean lst_mean")
def scene_diagnosis(spark: SparkSession, sf: str) -> DataFrame:
    return Q.diagnose(D.products(spark, sf).where("sensor = 'Landsat8'"), SETTINGS)


# --- coverage ---------------------------------------------------------------------------------------------------------

COVERAGE = SQL_STATS + """,
city AS (SELECT ano, mes, sum(ndvi_media * ndvi_n) / nullif(sum(CASE WHEN ndvi_media IS NOT NULL THEN ndvi_n END), 0) AS ndvi_media,
  sum(lst_c_media * lst_c_n) / nullif(sum(CASE WHEN lst_c_media IS NOT NULL THEN lst_c_n END), 0) AS lst_c_media FROM scene_stats GROUP BY ALL),
calendar AS (
  SELECT *, ndvi_media IS NOT NULL AS has_ndvi, lst_c_media IS NOT NULL AS has_lst, (ano = 1996 AND mes = 3) OR (ano = 1999 AND mes = 7) AS flagged,
    CASE WHEN ((ano = 1996 AND mes = 3) OR (ano = 1999 AND mes = 7)) AND (ndvi_media IS NOT NULL OR lst_c_media IS NOT NULL) THEN 'Flagged: low quality'
      WHEN ndvi_media IS NOT NULL AND lst_c_media IS NOT NULL THEN 'NDVI + LST' WHEN ndvi_media IS NOT NULL THEN 'NDVI only' WHEN lst_c_media IS NOT NULL THEN 'LST only' ELSE 'No data' END AS status,
    ['Summer', 'Summer', 'Autumn', 'Autumn', 'Autumn', 'Winter', 'Winter', 'Winter', 'Spring', 'Spring', 'Spring', 'Summer'][mes] AS season
  FROM (""" + D.MONTHS + """) LEFT JOIN city USING (ano, mes)),
symbols AS (SELECT *, CASE status WHEN 'NDVI + LST' THEN 'O' WHEN 'NDVI only' THEN 'n' WHEN 'LST only' THEN 'l' WHEN 'No data' THEN '.' ELSE '!' END AS symbol FROM calendar)
"""


def _calendar(spark: SparkSession, sf: str) -> DataFrame:
    """Of the area's months, whose means are weighted by valid pixels."""
    return V.calendar(D.monthly(spark, sf).select("ano", "mes", "ndvi_media", "lst_c_media"), SETTINGS)


@query(_with(COVERAGE, "SELECT * FROM symbols"), "ndvi_media lst_c_media")
def coverage_calendar(spark: SparkSession, sf: str) -> DataFrame:
    return _calendar(spark, sf)


@query(_with(SQL_MONTHLY, f"""SELECT ano, mes, coalesce(a, 0) AS n_zones_ndvi, coalesce(b, 0) AS n_zones_lst, (SELECT count(DISTINCT zone_id) FROM zone_monthly) AS n_zones_total,
  round(coalesce(100e0 * a / 25, 0), 1) AS pct_ndvi, round(coalesce(100e0 * b / 25, 0), 1) AS pct_lst
  FROM ({D.MONTHS}) LEFT JOIN (SELECT ano, mes, count(ndvi_media) AS a, count(lst_c_media) AS b FROM zone_monthly GROUP BY ALL) USING (ano, mes)"""))
def coverage_zones(spark: SparkSession, sf: str) -> DataFrame:
    return V.zone_coverage(D.zone_monthly(spark, sf), SETTINGS)


@query(_with(COVERAGE, """SELECT ano, count_if(has_ndvi AND has_lst) AS n_complete, count_if(has_ndvi <> has_lst) AS n_partial, count_if(NOT has_ndvi AND NOT has_lst) AS n_empty,
  count_if(status = 'Flagged: low quality') AS n_flagged, count(DISTINCT CASE WHEN has_ndvi OR has_lst THEN season END) AS n_seasons FROM symbols GROUP BY ano"""))
def coverage_annual(spark: SparkSession, sf: str) -> DataFrame:
    return V.by_year(_calendar(spark, sf))


@query(_with(COVERAGE, "SELECT count(*) AS n_months, count_if(has_ndvi OR has_lst) AS n_any, count_if(status = 'Flagged: low quality') AS n_flagged, round(100e0 * count_if(has_ndvi OR has_lst) / count(*), 1) AS pct_any FROM symbols"))
def coverage_overall(spark: SparkSession, sf: str) -> DataFrame:
    return V.overall(_calendar(spark, sf))


@query(_with(COVERAGE, "SELECT ano, " + ", ".join(f"max(CASE WHEN mes = {m} THEN symbol END) AS m{m:02d}" for m in range(1, 13)) + " FROM symbols GROUP BY ano"))
def coverage_wide(spark: SparkSession, sf: str) -> DataFrame:
    return V.wide(_calendar(spark, sf))


# --- zone series ------------------------------------------------------------------------------------------------------


@query(_with(SQL_MONTHLY, """SELECT zone_id, count(v) AS n_months, avg(v) AS mean, median(v) AS median, stddev_samp(v) AS sd, min(v) AS min, max(v) AS max, max(v) - min(v) AS range,
  100 * stddev_samp(v) / avg(v) AS cv_pct, CASE WHEN count(v) >= 24 THEN regr_slope(v, ano + (mes - 1) / 12e0) END AS trend
  FROM (SELECT *, lst_c_media AS v FROM good_months WHERE lst_c_media IS NOT NULL) GROUP BY zone_id"""), "mean median sd min max range cv_pct trend")
def zone_longrun_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.long_run(D.zone_monthly(spark, sf), "lst_c_media", ["zone_id"], SETTINGS)


@query(_with(SQL_MONTHLY, """SELECT zone_id, count(v) AS n_months, avg(v) AS mean, median(v) AS median, stddev_samp(v) AS sd, min(v) AS min, max(v) AS max, max(v) - min(v) AS range,
  CASE WHEN count(v) >= 24 THEN regr_slope(v, ano + (mes - 1) / 12e0) END AS trend
  FROM (SELECT *, ndvi_media AS v FROM good_months WHERE ndvi_media IS NOT NULL) GROUP BY zone_id"""), "mean median sd min max range trend")
def zone_longrun_ndvi(spark: SparkSession, sf: str) -> DataFrame:
    """No coefficient of variation: NDVI comes near zero."""
    return R.long_run(D.zone_monthly(spark, sf), "ndvi_media", ["zone_id"], SETTINGS).drop("cv_pct")


@query(_with(SQL_MONTHLY, f"SELECT ano, avg(lst_media_anual) AS lst_media_anual, count(lst_media_anual) AS n_zones FROM ({annual_sql('zone_monthly', 'zone_id, ano')}) GROUP BY ano"), "lst_media_anual")
def zone_annual_area_mean(spark: SparkSession, sf: str) -> DataFrame:
    return R.area_mean(R.annual(D.zone_monthly(spark, sf), ("zone_id",)), "lst_media_anual")


@query(_with(SQL, "SELECT min(ano) AS year_start, max(ano) AS year_end FROM scenes"))
def study_period(spark: SparkSession, sf: str) -> DataFrame:
    span = R.study_period(D.scenes(spark, sf), SETTINGS, "year")
    return spark.createDataFrame([(span.year_start, span.year_end)], "year_start int, year_end int")


def _means(by: str) -> str:
    return _with(SQL_MONTHLY, f"SELECT {by}, avg(lst_c_media) AS mean, count(lst_c_media) AS n FROM good_months WHERE lst_c_media IS NOT NULL GROUP BY {by}")


@query(_means("zone_id, mes"), "mean")
def zone_climatology(spark: SparkSession, sf: str) -> DataFrame:
    return R.means_by(D.zone_monthly(spark, sf), "lst_c_media", ["zone_id", "mes"], SETTINGS)


@query(_means("zone_id, ano"), "mean")
def zone_annual_means(spark: SparkSession, sf: str) -> DataFrame:
    return R.means_by(D.zone_monthly(spark, sf), "lst_c_media", ["zone_id", "ano"], SETTINGS)


@query(_means("data_ref"), "mean")
def city_mean_series(spark: SparkSession, sf: str) -> DataFrame:
    return R.means_by(D.zone_monthly(spark, sf), "lst_c_media", ["data_ref"], SETTINGS)


@query(_with(SQL_MONTHLY, "SELECT zone_id, ano, mes, lst_c_media, avg(lst_c_media) OVER w AS zone_mean, median(lst_c_media) OVER w AS zone_median FROM good_months WHERE lst_c_media IS NOT NULL WINDOW w AS (PARTITION BY zone_id)"), "lst_c_media zone_mean zone_median")
def zone_departures(spark: SparkSession, sf: str) -> DataFrame:
    return R.with_long_run(D.zone_monthly(spark, sf).select("zone_id", "ano", "mes", "lst_c_media"), "lst_c_media", ["zone_id"], SETTINGS)


@query(_with(SQL_MONTHLY + ", stats AS (SELECT zone_id, avg(lst_c_media) AS mean, stddev_samp(lst_c_media) AS sd FROM good_months WHERE lst_c_media IS NOT NULL GROUP BY zone_id)", """
  SELECT measure, "end", zone_id, value FROM (
    SELECT 'mean' AS measure, 'top' AS "end", zone_id, mean AS value, row_number() OVER (ORDER BY mean DESC NULLS LAST, zone_id) AS n FROM stats UNION ALL
    SELECT 'mean', 'bottom', zone_id, mean, row_number() OVER (ORDER BY mean NULLS LAST, zone_id) FROM stats UNION ALL
    SELECT 'sd', 'top', zone_id, sd, row_number() OVER (ORDER BY sd DESC NULLS LAST, zone_id) FROM stats UNION ALL
    SELECT 'sd', 'bottom', zone_id, sd, row_number() OVER (ORDER BY sd NULLS LAST, zone_id) FROM stats) WHERE n <= 5"""), "value")
def zone_extremes_topk(spark: SparkSession, sf: str) -> DataFrame:
    return R.extremes(R.long_run(D.zone_monthly(spark, sf), "lst_c_media", ["zone_id"], SETTINGS), 5, ["mean", "sd"], "zone_id")


@query(_with(SQL_MONTHLY, "SELECT zone_id, arg_max(data_ref, lst_c_media) AS hottest_month, arg_min(data_ref, lst_c_media) AS coolest_month FROM good_months WHERE lst_c_media IS NOT NULL GROUP BY zone_id"))
def zone_extreme_months(spark: SparkSession, sf: str) -> DataFrame:
    return R.extreme_months(D.zone_monthly(spark, sf), "lst_c_media", "zone_id", SETTINGS)


# --- climate ----------------------------------------------------------------------------------------------------------

CLIMATE = SQL_MONTHLY + """, station AS (SELECT year(o_orderdate)::INT AS ano, month(o_orderdate)::INT AS mes, 15 + 10 * avg((o_custkey % 100)::DOUBLE) / 50e0 AS temp FROM orders GROUP BY ALL),
good AS (SELECT 0 AS g, zone_id, ano, mes, lst_c_media AS y, temp AS x FROM zone_monthly JOIN station USING (ano, mes) WHERE lst_c_media IS NOT NULL AND NOT ((ano = 1996 AND mes = 3) OR (ano = 1999 AND mes = 7))),
whole AS (SELECT 0 AS g, ano, mes, lst_c_media AS y, temp AS x FROM monthly JOIN station USING (ano, mes) WHERE lst_c_media IS NOT NULL AND NOT ((ano = 1996 AND mes = 3) OR (ano = 1999 AND mes = 7)))
"""


def _fit(source: str, by: str, least: int) -> str:
    rank = lambda c: f"rank() OVER (PARTITION BY {by} ORDER BY {c}) + (count(*) OVER (PARTITION BY {by}, {c}) - 1) / 2e0"
    return f"""SELECT *, CASE WHEN pearson IS NOT NULL THEN CASE WHEN abs(pearson) > 0.7 THEN 'strong' WHEN abs(pearson) > 0.4 THEN 'moderate' ELSE 'weak' END END AS strength,
    CASE WHEN slope > 1.2 THEN 'amplified' WHEN slope < 0.8 THEN 'damped' WHEN slope IS NOT NULL THEN 'proportional' END AS response
  FROM (SELECT {by}, count(*) AS n_months, corr(y, x) AS pearson, corr(ry, rx) AS spearman, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, regr_r2(y, x) AS r2, avg(y - x) AS mean_offset
    FROM (SELECT *, {rank('x')} AS rx, {rank('y')} AS ry FROM {source}) GROUP BY {by} HAVING count(*) >= {least})"""


FIT = "pearson spearman slope intercept r2 mean_offset"


@query(_with(CLIMATE, f"SELECT * EXCLUDE (g) FROM ({_fit('whole', 'g', 2)})"), FIT)
def climate_correlation(spark: SparkSession, sf: str) -> DataFrame:
    return K.correlation(K.enough_months(K.matched(D.monthly(spark, sf), D.station(spark, sf), SETTINGS)))


@query(_with(CLIMATE, _fit("good", "zone_id", 12)), FIT)
def climate_by_zone(spark: SparkSession, sf: str) -> DataFrame:
    return K.correlation(K.matched(D.zone_monthly(spark, sf), D.station(spark, sf), SETTINGS), ["zone_id"], least=SETTINGS.zone_months)


@query(_with(CLIMATE, "SELECT avg(y - x) AS mean, median(y - x) AS median, stddev_samp(y - x) AS sd, min(y - x) AS min, max(y - x) AS max FROM whole"), "mean median sd min max")
def surface_air_offset(spark: SparkSession, sf: str) -> DataFrame:
    return K.offset_summary(K.matched(D.monthly(spark, sf), D.station(spark, sf), SETTINGS))


# --- ranking ----------------------------------------------------------------------------------------------------------

RANKS = SQL_MONTHLY + """, placed AS (
  SELECT zone_id, ano, mes, lst_c_media AS value, rank() OVER (PARTITION BY ano, mes ORDER BY lst_c_media) + (count(*) OVER (PARTITION BY ano, mes, lst_c_media) - 1) / 2e0 AS rank,
    count(*) OVER (PARTITION BY ano, mes) AS n_zones, avg(lst_c_media) OVER (PARTITION BY ano, mes) AS city_mean FROM good_months WHERE lst_c_media IS NOT NULL),
ranked AS (
  SELECT *, (rank - 1) / nullif(n_zones - 1, 0)::DOUBLE AS rank_norm, CASE WHEN rank <= 5 THEN 'coolest' WHEN rank > n_zones - 5 THEN 'warmest' ELSE 'middle' END AS "group", value - city_mean AS delta FROM placed),
persistent AS (
  SELECT zone_id, count(*) AS n_months, avg(rank) AS mean_rank, stddev_samp(rank) AS sd_rank, min(rank) AS min_rank, max(rank) AS max_rank, avg(rank_norm) AS mean_rank_norm,
    100 * avg(("group" = 'warmest')::INT) AS pct_warmest, 100 * avg(("group" = 'coolest')::INT) AS pct_coolest, avg(delta) AS mean_delta, 100 * avg((delta > 0)::INT) AS pct_above_city,
    CASE WHEN count(*) >= 3 THEN corr(value, city_mean) END AS corr_city FROM ranked GROUP BY zone_id)
"""


def _ranks(spark: SparkSession, sf: str) -> DataFrame:
    return N.monthly_ranks(D.zone_monthly(spark, sf), "lst_c_media", SETTINGS)


@query(_with(RANKS, "SELECT * FROM ranked"), "value rank city_mean rank_norm delta")
def zone_rank_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return _ranks(spark, sf)


@query(_with(RANKS, """SELECT *, CASE WHEN pct_warmest >= 80 THEN 'persistently warm' WHEN pct_coolest >= 80 THEN 'persistently cool' WHEN greatest(pct_warmest, pct_coolest) >= 50 THEN 'frequently extreme' ELSE 'variable' END AS label FROM persistent"""),
       "mean_rank sd_rank min_rank max_rank mean_rank_norm pct_warmest pct_coolest mean_delta pct_above_city corr_city")
def zone_persistence(spark: SparkSession, sf: str) -> DataFrame:
    return N.persistence(_ranks(spark, sf))


@query(_with(RANKS, "SELECT ano, mes, max(value) - min(value) AS amplitude, any_value(n_zones) AS n_zones FROM ranked GROUP BY ano, mes"), "amplitude")
def spatial_amplitude(spark: SparkSession, sf: str) -> DataFrame:
    return N.amplitude(_ranks(spark, sf))


@query(_with(RANKS, "SELECT count_if(pct_warmest >= 80) AS n_warm, count_if(pct_coolest >= 80) AS n_cool, count_if(pct_warmest >= 80) >= 5 OR count_if(pct_coolest >= 80) >= 5 AS structural FROM persistent"))
def zone_structure(spark: SparkSession, sf: str) -> DataFrame:
    return N.structure(N.persistence(_ranks(spark, sf)))


# --- agreement of sensors ---------------------------------------------------------------------------------------------

PAIRS = SQL + f""", halves AS (SELECT * REPLACE (sensor || '_' || d AS scene, d AS acq_date) FROM (SELECT *, make_date(ano, mes, CASE WHEN day(acq_date) <= 15 THEN 1 ELSE 16 END) AS d FROM products)),
campaign AS (SELECT zone_id, scene, sensor, acq_date, ano, mes, {D.SIX} FROM halves GROUP BY ALL),
long AS (
  SELECT scene, sensor, acq_date, ano, mes, zone_id, 'ndvi' AS variable, ndvi_media AS value, ndvi_media - sum(ndvi_media * ndvi_n) OVER (PARTITION BY scene) / sum(CASE WHEN ndvi_media IS NOT NULL THEN ndvi_n END) OVER (PARTITION BY scene) AS anomaly FROM campaign UNION ALL
  SELECT scene, sensor, acq_date, ano, mes, zone_id, 'lst_c', lst_c_media, lst_c_media - sum(lst_c_media * lst_c_n) OVER (PARTITION BY scene) / sum(CASE WHEN lst_c_media IS NOT NULL THEN lst_c_n END) OVER (PARTITION BY scene) FROM campaign),
seen AS (SELECT * FROM long WHERE value IS NOT NULL),
pairs AS (
  SELECT *, date_diff('day', date_a, date_b) AS gap_days, replace(least(sensor_a, sensor_b), 'Landsat', 'L') || ' vs ' || replace(greatest(sensor_a, sensor_b), 'Landsat', 'L') AS pair,
    CASE WHEN sensor_a = sensor_b THEN 'Same instrument' ELSE 'Between instruments' END AS comparison, value_b - value_a AS diff_abs, (value_a + value_b) / 2 AS mean_ab,
    CASE WHEN abs((value_a + value_b) / 2) > CASE WHEN variable = 'ndvi' THEN 0.1 ELSE 1e-6 END THEN 100 * (value_b - value_a) / ((value_a + value_b) / 2) END AS diff_pct, anomaly_b - anomaly_a AS diff_anom
  FROM (SELECT a.ano, a.mes, a.zone_id, a.variable, a.scene AS scene_a, b.scene AS scene_b, a.sensor AS sensor_a, b.sensor AS sensor_b, a.acq_date AS date_a, b.acq_date AS date_b, a.value AS value_a, b.value AS value_b, a.anomaly AS anomaly_a, b.anomaly AS anomaly_b
    FROM seen a JOIN seen b ON a.ano = b.ano AND a.mes = b.mes AND a.zone_id = b.zone_id AND a.variable = b.variable AND (a.acq_date, a.scene) < (b.acq_date, b.scene)))
"""


def _long(spark: SparkSession, sf: str) -> DataFrame:
    return G.zone_anomalies(D.campaign(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return G.scene_pairs(_long(spark, sf))


@query(_with(SQL_STATS, """SELECT *, CASE WHEN n_sensors > 1 THEN 'Between instruments' ELSE 'Same instrument' END AS kind FROM (
  SELECT ano, mes, count(*) AS n_scenes, count(DISTINCT sensor) AS n_sensors, string_agg(DISTINCT sensor, ', ' ORDER BY sensor) AS sensors, string_agg(acq_date::VARCHAR, ', ' ORDER BY acq_date) AS dates,
    date_diff('day', min(acq_date), max(acq_date))::INT AS span_days FROM scene_stats WHERE ndvi_media IS NOT NULL OR lst_c_media IS NOT NULL GROUP BY ALL) WHERE n_scenes >= 2"""))
def sensor_month_inventory(spark: SparkSession, sf: str) -> DataFrame:
    return G.shared_months(D.scene_stats(spark, sf))


@query(_with(PAIRS, "SELECT * REPLACE (gap_days::INT AS gap_days) FROM pairs"), "value_a value_b anomaly_a anomaly_b diff_abs mean_ab diff_pct diff_anom")
def scene_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf)


DENSITY = """, s AS (SELECT variable, comparison, count(*) AS k, stddev_samp(diff_abs) AS sd, quantile_cont(diff_abs, 0.75) - quantile_cont(diff_abs, 0.25) AS iqr FROM pairs GROUP BY ALL),
r AS (SELECT variable, min(diff_abs) AS lo, (max(diff_abs) - min(diff_abs)) / 511 AS step FROM pairs GROUP BY variable),
b AS (SELECT *, 0.9 * coalesce(nullif(least(sd, iqr / 1.34), 0), nullif(sd, 0), 1) * pow(k, -0.2) AS bw FROM s),
a AS (SELECT variable, comparison, (diff_abs - lo) / step AS pos FROM pairs JOIN r USING (variable)),
w AS (SELECT variable, comparison, j, sum(w) AS w FROM (SELECT variable, comparison, least(floor(pos), 511)::INT AS j, 1 - (pos - least(floor(pos), 511)) AS w FROM a
  UNION ALL SELECT variable, comparison, least(floor(pos)::INT + 1, 511), pos - least(floor(pos), 511) FROM a) GROUP BY ALL)"""


@query(_with(PAIRS + DENSITY, """SELECT variable, comparison, i::INT AS i, lo + i * step AS x, sum(w * exp(-pow((j - i) * step / bw, 2) / 2)) / any_value(k * bw * sqrt(2 * pi())) AS density
  FROM w JOIN b USING (variable, comparison) JOIN r USING (variable), range(0, 512) g(i) GROUP BY variable, comparison, i, lo, step"""), "x density")
def pair_density(spark: SparkSession, sf: str) -> DataFrame:
    """How differences within pairs are spread, over the range of each variable."""
    return U.density(parked(_pairs(spark, sf).select("variable", "comparison", "diff_abs")), "diff_abs", KIND, ["variable"])


def _pair_summary(by: str) -> str:
    return f"""SELECT *, 100 * (1 - mad_anom / mad) AS reduction FROM (SELECT {by}, count(*) AS n, count(DISTINCT ano * 100 + mes) AS n_months, median(gap_days)::DOUBLE AS median_gap, avg(diff_abs) AS mean_diff,
  avg(abs(diff_abs)) AS mad, stddev_samp(diff_abs) AS sd_diff, quantile_cont(abs(diff_abs), 0.95) AS p95, avg(abs(diff_pct)) AS mad_pct, avg(abs(diff_anom)) AS mad_anom FROM pairs GROUP BY ALL)"""


KIND = ["variable", "comparison"]
SUMMARY = "median_gap mean_diff mad sd_diff p95 mad_pct mad_anom reduction"


#: The same of real scenes: every order is one.
SCENE_PAIRS = PAIRS.replace("FROM halves GROUP BY ALL", "FROM products GROUP BY ALL")


@query(_with(SCENE_PAIRS, _pair_summary("variable, comparison").replace("SELECT *,", "SELECT * EXCLUDE (mad_pct),", 1)), SUMMARY.replace("mad_pct ", ""))
def scene_pair_summary(spark: SparkSession, sf: str) -> DataFrame:
    """All pairs of orders of a month and zone, without a row for any."""
    return W.summary(G.zone_anomalies(D.zone_scene_stats(spark, sf)))


@query(_with(PAIRS, _pair_summary("variable, comparison")), SUMMARY)
def pair_summary(spark: SparkSession, sf: str) -> DataFrame:
    return G.pair_summary(_pairs(spark, sf), KIND)


@query(_with(PAIRS, _pair_summary("variable, pair, comparison")), SUMMARY)
def pair_by_label(spark: SparkSession, sf: str) -> DataFrame:
    return G.pair_summary(_pairs(spark, sf), ["variable", "pair", "comparison"])


def _place(c: str) -> str:
    by = "variable, scene_a, scene_b"
    return f"rank() OVER (PARTITION BY {by} ORDER BY {c}) + (count(*) OVER (PARTITION BY {by}, {c}) - 1) / 2e0 AS r_{c}"


def _measures_sql(c: str, end: str) -> str:
    a, b = f"{c}_a", f"{c}_b"
    return f"""corr({a}, {b}) AS pearson{end}, corr(r_{a}, r_{b}) AS spearman{end}, 2 * covar_samp({a}, {b}) / (var_samp({a}) + var_samp({b}) + pow(avg({a}) - avg({b}), 2)) AS ccc{end},
    sign(covar_samp({a}, {b})) * stddev_samp({b}) / stddev_samp({a}) AS sma{end}"""


METRICS = PAIRS + f""", ranked AS (SELECT *, {', '.join(_place(c) for c in ('value_a', 'value_b', 'anomaly_a', 'anomaly_b'))} FROM pairs),
metrics AS (
  SELECT variable, comparison, pair, ano, mes, scene_a, scene_b, count(*) AS n_zones, any_value(gap_days)::INT AS gap_days, {_measures_sql('value', '')}, {_measures_sql('anomaly', '_anom')},
    avg(value_a) AS mean_a, avg(value_b) AS mean_b, avg(diff_abs) AS mean_diff, avg(diff_anom) AS mean_diff_anom, avg(abs(diff_abs)) AS mad FROM ranked GROUP BY ALL HAVING count(*) >= 10)
"""
EIGHT = [f"{c}{end}" for end in ("", "_anom") for c in G.MEASURES]


@query(_with(METRICS, "SELECT * FROM metrics"), " ".join(EIGHT) + " mean_a mean_b mean_diff mean_diff_anom mad")
def pair_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return G.pair_metrics(_pairs(spark, sf), SETTINGS)


_QUARTILES = ", ".join(f"median({c}) AS {c}_median, quantile_cont({c}, 0.25) AS {c}_q25, quantile_cont({c}, 0.75) AS {c}_q75" for c in EIGHT)
CONCORD = f"SELECT variable, comparison, count(*) AS n_pairs, median(n_zones)::DOUBLE AS zones_median, {_QUARTILES} FROM metrics GROUP BY ALL"


@query(_with(METRICS, CONCORD), " ".join(f"{c}_{q}" for c in EIGHT for q in ("median", "q25", "q75")))
def pair_concordance(spark: SparkSession, sf: str) -> DataFrame:
    return G.concordance_summary(G.pair_metrics(_pairs(spark, sf), SETTINGS))


RELIABLE = """SELECT *, CASE WHEN attenuation_pct > 25 THEN 'strong' WHEN attenuation_pct > 10 THEN 'moderate' WHEN attenuation_pct IS NOT NULL THEN 'slight' END AS verdict
  FROM (SELECT *, sqrt(var_true) / sd_err AS snr, sqrt(var_true_anom) / sd_err_anom AS snr_anom, var_true / pow(sd_signal, 2) AS lambda_abs, var_true_anom / pow(sd_signal_anom, 2) AS lambda_anom, 100 * (1 - var_true_anom / pow(sd_signal_anom, 2)) AS attenuation_pct
    FROM (SELECT *, greatest(pow(sd_signal, 2) - pow(sd_err, 2), 0) AS var_true, greatest(pow(sd_signal_anom, 2) - pow(sd_err_anom, 2), 0) AS var_true_anom
      FROM (SELECT variable, comparison, count(*) AS n, stddev_samp(diff_abs) / sqrt(2e0) AS sd_err, stddev_samp(diff_anom) / sqrt(2e0) AS sd_err_anom FROM pairs GROUP BY ALL)
      LEFT JOIN (SELECT variable, stddev_samp(value) AS sd_signal, stddev_samp(anomaly) AS sd_signal_anom FROM seen GROUP BY variable) USING (variable)))"""


@query(_with(PAIRS, RELIABLE), "sd_err sd_err_anom sd_signal sd_signal_anom var_true var_true_anom snr snr_anom lambda_abs lambda_anom attenuation_pct")
def pair_reliability(spark: SparkSession, sf: str) -> DataFrame:
    return G.reliability(_long(spark, sf), _pairs(spark, sf))


LIMITS = f"SELECT variable, comparison, n, mean_diff AS bias, mean_diff - 1.96e0 * sd_diff AS lower, mean_diff + 1.96e0 * sd_diff AS upper, p95 FROM ({_pair_summary('variable, comparison')})"


@query(_with(PAIRS, LIMITS), "bias lower upper p95")
def limits_of_agreement(spark: SparkSession, sf: str) -> DataFrame:
    return G.limits(G.pair_summary(_pairs(spark, sf), KIND))


GAPS = """SELECT variable, comparison, count(*) AS n, min(gap) AS min_gap, max(gap) AS max_gap, median(gap) AS median_gap, CASE WHEN count(*) > 5 AND stddev_samp(gap) > 0 THEN regr_slope(d, gap) END AS slope, CASE WHEN stddev_samp(rx) > 0 AND stddev_samp(ry) > 0 THEN corr(rx, ry) END AS spearman
  FROM (SELECT *, rank() OVER (PARTITION BY variable, comparison ORDER BY gap) + (count(*) OVER (PARTITION BY variable, comparison, gap) - 1) / 2e0 AS rx, rank() OVER (PARTITION BY variable, comparison ORDER BY d) + (count(*) OVER (PARTITION BY variable, comparison, d) - 1) / 2e0 AS ry
    FROM (SELECT variable, comparison, gap_days::DOUBLE AS gap, abs(diff_abs) AS d FROM pairs)) GROUP BY variable, comparison"""


@query(_with(PAIRS, GAPS), "min_gap max_gap median_gap slope spearman")
def gap_dependence(spark: SparkSession, sf: str) -> DataFrame:
    return G.gap_dependence(_pairs(spark, sf))


@query(_with(METRICS, f"""SELECT * FROM ({LIMITS}) LEFT JOIN (SELECT * EXCLUDE (n) FROM ({GAPS})) g USING (variable, comparison)
  LEFT JOIN (SELECT variable, comparison, sd_signal_anom, sd_err_anom, snr_anom, lambda_anom, attenuation_pct FROM ({RELIABLE})) USING (variable, comparison)
  LEFT JOIN (SELECT variable, comparison, n_pairs, spearman_anom_median, ccc_anom_median, sma_anom_median, spearman_median, ccc_median FROM ({CONCORD})) USING (variable, comparison)"""),
       "bias lower upper p95 min_gap max_gap median_gap slope spearman sd_signal_anom sd_err_anom snr_anom lambda_anom attenuation_pct spearman_anom_median ccc_anom_median sma_anom_median spearman_median ccc_median")
def sensor_validation(spark: SparkSession, sf: str) -> DataFrame:
    """The table of zones and campaigns is written once; limits, gaps, reliability and concordance all read it."""
    long = parked(_long(spark, sf))
    pairs = G.scene_pairs(long)
    concord = G.concordance_summary(G.pair_metrics(pairs, SETTINGS))
    return G.validation(G.pair_summary(pairs, KIND), G.gap_dependence(pairs), G.reliability(long, pairs), concord)


@query(_with(METRICS, f"""SELECT variable, reduction, reduction > 50 AS anomalies_help, same.mad < 0.8 * b.mad AS instrument_effect, rho, CASE WHEN rho > 0.8 THEN 'strong' WHEN rho > 0.5 THEN 'moderate' WHEN rho IS NOT NULL THEN 'weak' END AS rank_agreement,
  sma, CASE WHEN abs(sma - 1) < 0.15 THEN 'same scale' WHEN sma IS NOT NULL THEN 'other scale' END AS scale
  FROM (SELECT * FROM ({_pair_summary('variable, comparison')}) WHERE comparison LIKE 'Between%') b LEFT JOIN (SELECT variable, mad FROM ({_pair_summary('variable, comparison')}) WHERE comparison LIKE 'Same%') same USING (variable)
  LEFT JOIN (SELECT variable, median(spearman_anom) AS rho, median(sma_anom) AS sma FROM metrics WHERE comparison LIKE 'Between%' GROUP BY variable) USING (variable)"""), "reduction rho sma")
def sensor_interpretation(spark: SparkSession, sf: str) -> DataFrame:
    pairs = G.scene_pairs(parked(_long(spark, sf)))
    return G.interpretation(G.pair_summary(pairs, KIND), G.concordance_summary(G.pair_metrics(pairs, SETTINGS)))


DIRECTIONAL = """SELECT *, bias / nullif(se, 0) AS t FROM (SELECT *, sd / sqrt(n_pairs::DOUBLE) AS se FROM (SELECT variable, direction, count(*) AS n_pairs, avg(m) AS bias, stddev_samp(m) AS sd, avg(m_anom) AS bias_anom FROM (
  SELECT variable, direction, scene_a, scene_b, avg(CASE WHEN older_a THEN diff_abs ELSE -diff_abs END) AS m, avg(CASE WHEN older_a THEN diff_anom ELSE -diff_anom END) AS m_anom
  FROM (SELECT *, replace(CASE WHEN older_a THEN sensor_b || ' - ' || sensor_a ELSE sensor_a || ' - ' || sensor_b END, 'Landsat', 'L') AS direction FROM (SELECT *, right(sensor_a, 1) <= right(sensor_b, 1) AS older_a FROM pairs WHERE comparison = 'Between instruments')) GROUP BY ALL) GROUP BY ALL))"""


@query(_with(PAIRS, DIRECTIONAL), "bias sd bias_anom se t")
def directional_bias(spark: SparkSession, sf: str) -> DataFrame:
    return G.directional(_pairs(spark, sf))


def _inside(t: str, n: str) -> str:
    """The share of Student's distribution within ``t``, for ``n`` whole degrees of freedom, as a finite series."""
    angle = f"atan(abs({t}) / sqrt({n}))"
    product = lambda a, b: f"coalesce(list_product(list_transform(range(1, j + 1), lambda i: {a}::DOUBLE / ({b}))), 1)"
    total = lambda last, of, power: f"coalesce(list_sum(list_transform(range(0, {last} + 1), lambda j: {of} * pow(cos({angle}), {power}))), 0)"
    even = f"sin({angle}) * {total(f'(({n} - 2) // 2)', product('(2 * i - 1)', '2 * i'), '2 * j')}"
    odd = f"2 / pi() * ({angle} + CASE WHEN {n} > 1 THEN sin({angle}) * {total(f'greatest(({n} - 3) // 2, 0)', product('(2 * i)', '2 * i + 1'), '2 * j + 1')} ELSE 0 END)"
    return f"CASE WHEN {n} % 2 = 0 THEN {even} ELSE {odd} END"


#: The quantile is found by halving; a hundred times leaves nothing of a double.
INTERVALS = f"""SELECT d.*, p_value, bias - half * se AS ci_low, bias + half * se AS ci_high FROM directional d LEFT JOIN (
  SELECT variable, direction, 1 - {_inside("t", "df")} AS p_value FROM (SELECT *, n_pairs - 1 AS df FROM directional WHERE n_pairs > 1 AND t IS NOT NULL)) USING (variable, direction)
  LEFT JOIN (SELECT variable, direction, low AS half FROM halving WHERE step = 100) USING (variable, direction)"""
HALVING = f""", directional AS ({DIRECTIONAL}),
halving AS (SELECT variable, direction, n_pairs - 1 AS df, 0e0 AS low, 1e3 AS high, 0 AS step FROM directional WHERE n_pairs > 1 AND t IS NOT NULL
  UNION ALL SELECT variable, direction, df, CASE WHEN {_inside("((low + high) / 2)", "df")} < 0.95 THEN (low + high) / 2 ELSE low END,
    CASE WHEN {_inside("((low + high) / 2)", "df")} < 0.95 THEN high ELSE (low + high) / 2 END, step + 1 FROM halving WHERE step < 100)"""


@query("WITH RECURSIVE " + PAIRS + HALVING + "\n" + INTERVALS, "bias sd bias_anom se t p_value ci_low ci_high")
def directional_bias_intervals(spark: SparkSession, sf: str) -> DataFrame:
    return G.with_p_values(G.directional(_pairs(spark, sf)))


# --- space ------------------------------------------------------------------------------------------------------------

GRID = P.Grid(0.0, 100.0, 1.0, 100, 100)


def _rectangles(spark: SparkSession, sf: str, hole: bool = False) -> DataFrame:
    """A rectangle for each nation; neighbours overlap by a cell.  With ``hole``, 6 x 6 of it are left out."""
    k = F.col("n_nationkey")
    x, y = (k % 5 * 20).cast("double"), (F.floor(k / 5) * 20).cast("double")
    rings = P.rectangle(x, y, x + 21, y + 19.25)
    rings = F.concat(rings, P.rectangle(x + 5, y + 5, x + 11, y + 11)) if hole else rings
    return D.table(spark, sf, "nation").select(k.alias("zone_id"), rings.alias("rings"))


_RECT = "SELECT n_nationkey AS zone_id, (n_nationkey % 5 * 20)::DOUBLE AS x0, (n_nationkey // 5 * 20)::DOUBLE AS y0, (n_nationkey % 5 * 20)::DOUBLE + 21 AS x1, (n_nationkey // 5 * 20)::DOUBLE + 19.25 AS y1 FROM nation"
#: The union in pieces of 1 x 0.25, of which every rectangle and hole is made.
_PIECES = f"""WITH z AS ({_RECT}), q AS (SELECT i + 0.5 AS x, j * 0.25 + 0.125 AS y FROM range(0, 130) a(i), range(0, 480) b(j)
  WHERE EXISTS (SELECT 1 FROM z WHERE i + 0.5 BETWEEN x0 AND x1 AND j * 0.25 + 0.125 BETWEEN y0 AND y1 AND NOT (i + 0.5 BETWEEN x0 + 5 AND x0 + 11 AND j * 0.25 + 0.125 BETWEEN y0 + 5 AND y0 + 11)))"""


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    return D.table(spark, sf, "lineitem").select((F.col("l_suppkey") * 7 % 100).cast("int").alias("row"), (F.col("l_partkey") % 100).cast("int").alias("col"), "l_quantity")


_CELLS = "SELECT (l_suppkey * 7 % 100)::INT AS row, (l_partkey % 100)::INT AS col, l_quantity FROM lineitem"
_HIT = "col + 0.5 >= x0 AND col + 0.5 < x1 AND 100 - (row + 0.5) >= y0 AND 100 - (row + 0.5) < y1"


@query(f"WITH z AS ({_RECT}), c AS ({_CELLS})\nSELECT zone_id, count(*) AS n, sum(l_quantity)::DOUBLE AS quantity FROM c JOIN z ON {_HIT} GROUP BY zone_id", "quantity")
def zone_pixel_join(spark: SparkSession, sf: str) -> DataFrame:
    hits = P.in_zones(_cells(spark, sf), P.spans(_rectangles(spark, sf), GRID))
    return hits.groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(f"WITH z AS ({_RECT}), c AS ({_CELLS})\nSELECT row, count(*) AS n FROM c WHERE EXISTS (SELECT 1 FROM z WHERE {_HIT}) GROUP BY row")
def zone_pixel_mask(spark: SparkSession, sf: str) -> DataFrame:
    return P.clip(_cells(spark, sf), P.spans(_rectangles(spark, sf), GRID)).groupBy("row").agg(F.count("*").alias("n"))


#: A square on its corner for each nation; a cell is touched where its nearest point lies within.
_DIAMOND = "SELECT n_nationkey AS zone_id, n_nationkey % 5 * 20 + 10.3 AS x, n_nationkey // 5 * 20 + 9.7 AS y, 6.25 + n_nationkey % 7 AS r FROM nation"


def _diamonds(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("n_nationkey")
    x, y, r = k % 5 * 20 + F.lit(10.3), F.floor(k / 5) * 20 + F.lit(9.7), 6.25 + k % 7
    corners = [F.struct((x + a * r).alias("x"), (y + b * r).alias("y")) for a, b in ((1, 0), (0, 1), (-1, 0), (0, -1))]
    return D.table(spark, sf, "nation").select(k.alias("zone_id"), F.array(F.array(*corners)).alias("rings"))


@query(f"""WITH z AS ({_DIAMOND}), c AS ({_CELLS})
SELECT zone_id, count(*) AS n, sum(l_quantity) AS quantity FROM c JOIN z ON abs(greatest(c.col, least(z.x, c.col + 1)) - z.x) + abs(greatest(99 - c.row, least(z.y, 100 - c.row)) - z.y) < z.r GROUP BY zone_id""")
def zone_touched_join(spark: SparkSession, sf: str) -> DataFrame:
    """Cells that a polygon meets at all, not only those whose centre it holds."""
    hits = P.in_zones(_cells(spark, sf), P.spans(_diamonds(spark, sf), GRID, touched=True))
    return hits.groupBy("zone_id").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("quantity"))


@query(f"SELECT zone_id, x0 + 16 AS x, y0 + 8 AS y FROM ({_RECT})")
def label_points(spark: SparkSession, sf: str) -> DataFrame:
    """A point inside each rectangle, beside its hole."""
    return P.label_points(_rectangles(spark, sf, hole=True))


@query(f"""{_PIECES}, s AS (SELECT c_custkey, c_custkey % 90 AS xmin, c_custkey % 70 AS ymin, c_custkey % 90 + 25 AS xmax, c_custkey % 70 + 30 AS ymax FROM customer),
  b AS (SELECT xmin, ymin, xmax, ymax, count(q.x) / (SELECT count(*) FROM q)::DOUBLE AS overlap FROM (SELECT DISTINCT xmin, ymin, xmax, ymax FROM s) LEFT JOIN q ON x BETWEEN xmin AND xmax AND y BETWEEN ymin AND ymax GROUP BY ALL)
  SELECT c_custkey, overlap, overlap > 0.1 AS enough FROM s JOIN b USING (xmin, ymin, xmax, ymax)""", "overlap")
def footprint_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """Shares of an area with holes and overlaps, and the filter of the run."""
    k = F.col("c_custkey")
    box = {"xmin": k % 90, "ymin": k % 70, "xmax": k % 90 + 25, "ymax": k % 70 + 30}
    scenes = D.table(spark, sf, "customer").select(k, *[c.cast("double").alias(n) for n, c in box.items()])
    out = P.footprint_overlap(scenes, _rectangles(spark, sf, hole=True))
    return out.select("c_custkey", "overlap", (F.col("overlap") > SETTINGS.min_overlap).alias("enough"))


@query(f"{_PIECES} SELECT count(*) * 0.25e0 AS area FROM q", "area")
def dissolved_area(spark: SparkSession, sf: str) -> DataFrame:
    t = P.dissolve(_rectangles(spark, sf, hole=True))
    width = lambda e: F.col(f"right{e}") - F.col(f"left{e}")
    return t.agg(F.sum((F.col("y1") - F.col("y0")) * (width(0) + width(1)) / 2).alias("area"))


@query(f"WITH z AS ({_RECT})\nSELECT zone_id, (x1 - x0) * (y1 - y0) - 36 AS area FROM z", "area")
def polygon_area(spark: SparkSession, sf: str) -> DataFrame:
    return P.areas(_rectangles(spark, sf, hole=True))


@query(f"WITH z AS ({_RECT}), s AS (SELECT s_nationkey AS zone_id, count(*) AS n FROM supplier WHERE s_acctbal > 5000 GROUP BY ALL)\nSELECT z.zone_id, n FROM z LEFT JOIN s USING (zone_id)")
def choropleth_join(spark: SparkSession, sf: str) -> DataFrame:
    """Zones of a map with a value each, or none."""
    values = D.table(spark, sf, "supplier").where("s_acctbal > 5000").groupBy(F.col("s_nationkey").alias("zone_id")).agg(F.count("*").alias("n"))
    return P.with_values(_rectangles(spark, sf), values, "zone_id").select("zone_id", "n")


@query(f"WITH z AS ({_RECT})\nSELECT zone_id, 0 AS ring, v::INT AS vertex, CASE WHEN v IN (0, 3) THEN x0 ELSE x1 END AS x, CASE WHEN v IN (0, 1) THEN y0 ELSE y1 END AS y FROM z, range(4) r(v)", "x y")
def polygon_vertices(spark: SparkSession, sf: str) -> DataFrame:
    return P.vertices(_rectangles(spark, sf))


def _tiles(spark: SparkSession, sf: str, value: str) -> DataFrame:
    """Every part is a cell: 10,000 keys fill a tile of 100 x 100 cells, which is a scene."""
    k = F.col("p_partkey")
    at = {"scene": F.floor(k / 10000), "row": F.floor(k % 10000 / 100), "col": k % 100}
    return D.table(spark, sf, "part").select(*[c.cast("int").alias(n) for n, c in at.items()], F.col(value).cast("double").alias("value"))


_TILES = "SELECT (p_partkey // 10000)::INT AS scene, (p_partkey % 10000 // 100)::INT AS row, (p_partkey % 100)::INT AS col, {}::DOUBLE AS value FROM part"


@query(f"WITH v AS ({_TILES.format('p_retailprice')})\nSELECT scene, (row // 2)::INT AS row, (col // 2)::INT AS col, avg(value) AS value FROM v GROUP BY ALL", "value")
def raster_bilinear(spark: SparkSession, sf: str) -> DataFrame:
    """Half the resolution: a target's centre lies between four cells of equal weight."""
    return X.resample(_tiles(spark, sf, "p_retailprice"), P.Grid(0.0, 100.0, 1.0, 100, 100), P.Grid(0.0, 100.0, 2.0, 50, 50))


@query(f"WITH v AS ({_TILES.format('p_size')})\nSELECT scene, row * 2 + i::INT AS row, col * 2 + j::INT AS col, value FROM v, range(2) a(i), range(2) b(j)", "value")
def raster_nearest(spark: SparkSession, sf: str) -> DataFrame:
    return X.resample(_tiles(spark, sf, "p_size"), P.Grid(0.0, 100.0, 1.0, 100, 100), P.Grid(0.0, 100.0, 0.5, 200, 200), "nearest")


# --- figures ----------------------------------------------------------------------------------------------------------


@query(_with(SQL_MONTHLY, "SELECT ano, mes, variable, value FROM (SELECT ano, mes, 'ndvi_media' AS variable, ndvi_media AS value FROM monthly UNION ALL SELECT ano, mes, 'lst_c_media', lst_c_media FROM monthly)"), "value")
def unpivot_series(spark: SparkSession, sf: str) -> DataFrame:
    return U.panels(D.monthly(spark, sf), ["ano", "mes"], ["ndvi_media", "lst_c_media"])


@query(_with(CLIMATE, """SELECT b::INT AS bin, lo + b * (hi - lo) / 28 AS low, lo + (b + 1) * (hi - lo) / 28 AS high, coalesce(n, 0) AS n FROM (SELECT min(y - x) AS lo, max(y - x) AS hi FROM whole), range(28) r(b)
  LEFT JOIN (SELECT least(floor((y - x - lo) * 28 / (hi - lo)), 27)::INT AS b, count(*) AS n FROM whole, (SELECT min(y - x) AS lo, max(y - x) AS hi FROM whole) GROUP BY ALL) USING (b)"""), "low high")
def histogram_offset(spark: SparkSession, sf: str) -> DataFrame:
    return U.histogram(K.matched(D.monthly(spark, sf), D.station(spark, sf), SETTINGS), "offset")


@query(_with(SQL, """SELECT floor((a - greatest(0.15e0 * (b - a), 0.1e0)) / 0.1e0) * 0.1e0 AS low, ceil((b + greatest(0.15e0 * (b - a), 0.1e0)) / 0.1e0) * 0.1e0 AS high
  FROM (SELECT quantile_cont(lst_c, 0.02) AS a, quantile_cont(lst_c, 0.98) AS b FROM products)"""), "low high")
def auto_limits(spark: SparkSession, sf: str) -> DataFrame:
    return U.color_limits(D.products(spark, sf), "lst_c")


@query(_with(SQL_MONTHLY, "SELECT zone_id, count(v) AS n, min(v) AS low, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50, quantile_cont(v, 0.75) AS q75, max(v) AS high FROM (SELECT zone_id, ndvi_media AS v FROM zone_monthly WHERE ndvi_media IS NOT NULL) GROUP BY zone_id"), "low q25 q50 q75 high")
def box_summaries(spark: SparkSession, sf: str) -> DataFrame:
    return U.boxes(D.zone_monthly(spark, sf), "ndvi_media", ["zone_id"])
