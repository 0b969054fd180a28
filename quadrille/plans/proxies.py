"""The engine's domain as a deterministic projection of the star-schema tables.

An order is a scene, a line item a pixel, the supplier's nation the pixel's zone.  Band numbers and quality words are
integer arithmetic on keys, so another engine's SQL gets the same values.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import inventory as I
from ..operators import quality as Q
from ..operators import series as R

SETTINGS = Settings(year_start=1995, year_end=2001, tiers=("T1", "RT"), low_quality=((1996, 3, "haze"), (1999, 7, "stripes")), top_n=5)

SCENE_ID = """concat_ws('_',
  CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'LC08' WHEN '2' THEN 'LC09' WHEN '3' THEN 'LE07' WHEN '4' THEN 'LT05' ELSE 'XX04' END,
  'L2SP', lpad(cast(o_custkey % 233 AS string), 3, '0') || lpad(cast(o_custkey % 97 AS string), 3, '0'),
  CASE WHEN o_orderkey % 101 = 0 THEN '20011399' ELSE date_format(o_orderdate, 'yyyyMMdd') END, '20200101', '02',
  CASE o_orderstatus WHEN 'F' THEN 'T1' WHEN 'O' THEN 'T2' ELSE 'RT' END)"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def scene_names(spark: SparkSession, sf: str) -> DataFrame:
    """``scene, scene_id`` and the attributes that metadata would give."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("scene"),
        F.expr(SCENE_ID).alias("scene_id"),
        (F.col("o_orderkey") * 7 % 101).cast("double").alias("cloud_cover"),
        (30 + F.col("o_orderkey") * 13 % 50).cast("double").alias("sun_elevation"),
        F.lit(0.00341802).alias("st_scale"),
        (149.0 + (F.col("o_orderkey") % 3) * 0.5).alias("st_offset"),
    )


def scenes(spark: SparkSession, sf: str, settings: Settings = SETTINGS) -> DataFrame:
    return I.inventory(scene_names(spark, sf), settings)


def pixels(spark: SparkSession, sf: str) -> DataFrame:
    """``scene, cell, line, zone_id, qa, dn_red, dn_nir, dn_st``."""
    k, p, s, n = (F.col(c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    flag = lambda c, bit: F.when(c, 1 << bit).otherwise(0)
    qa = 64 + flag(p % 23 == 0, 0) + flag(p % 19 == 0, 1) + flag(p % 7 == 0, 3) + flag(s % 11 == 0, 4) + flag(p % 13 == 0, 5) + flag(s % 17 == 0, 7)
    suppliers = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("zone_id"))
    return (
        table(spark, sf, "lineitem")
        .select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
        .join(suppliers, "l_suppkey")
        .select(
            k.alias("scene"),
            p.alias("cell"),
            n.alias("line"),
            "zone_id",
            qa.cast("int").alias("qa"),
            F.when(p % 29 == 0, 0).otherwise(7273 + (p * 31 + s * 17) % 20000).alias("dn_red"),
            (7273 + (p * 13 + n * 1999 + k * 7) % 37000).alias("dn_nir"),
            F.when(k % 53 == 0, 400).when(p % 31 == 0, 64000).otherwise(30000 + (p * 101 + k * 37) % 24000).alias("dn_st"),
        )
    )


#: Pixels that a task sorts and groups by scene.
PIXELS = 400_000


def by_scene(spark: SparkSession, sf: str, pixels: DataFrame) -> DataFrame:
    """``pixels`` dealt by scene over as many tasks as they fill, so that no task's memory grows with the table.

    The session's own number of partitions stays where it is enough; the count reads no column.
    """
    parts = math.ceil(table(spark, sf, "lineitem").count() / PIXELS)
    return pixels.repartition(parts, "scene") if parts > int(spark.conf.get("spark.sql.shuffle.partitions")) else pixels


def products(spark: SparkSession, sf: str) -> DataFrame:
    """Pixels of the inventory's scenes with calibrated values.

    The pixel table is many times the scene table and both are keyed by scene, so this is one shuffle join unless
    the inventory is small enough for Spark to broadcast.
    """
    info = scenes(spark, sf).select("scene", "scene_id", "sensor", "acq_date", F.col("year").alias("ano"), F.col("month").alias("mes"), "cloud_cover", "sun_elevation", "st_scale", "st_offset")
    return Q.with_products(by_scene(spark, sf, pixels(spark, sf)).join(info, "scene"), SETTINGS, {c: F.col(c) for c in ("st_scale", "st_offset")})


#: An order has at most seven lines in this schema, whatever its scale; so has a scene made of one.
LINES = 7
SCENE = ("sensor", "acq_date", "ano", "mes", "cloud_cover", "sun_elevation")


def scene_stats(spark: SparkSession, sf: str) -> DataFrame:
    return R.scene_stats(products(spark, sf), ["scene"], SCENE, LINES)


def zone_scene_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Zones that have pixels in a scene; :func:`series.complete_zones` adds the others."""
    return R.scene_stats(products(spark, sf), ["scene", "zone_id"], SCENE, LINES)


def zones(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").select(F.col("n_nationkey").alias("zone_id"), F.col("n_name").alias("zone_name"))


def monthly(spark: SparkSession, sf: str) -> DataFrame:
    return R.monthly(scene_stats(spark, sf), SETTINGS)


def zone_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return R.monthly(zone_scene_stats(spark, sf), SETTINGS, zones(spark, sf), ("zone_id",))


def station(spark: SparkSession, sf: str) -> DataFrame:
    """A monthly temperature series of all orders."""
    temp = 15 + 10 * F.avg((F.col("o_custkey") % 100).cast("double")) / 50.0
    return table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("ano"), F.month("o_orderdate").alias("mes")).agg(temp.alias("temp"))


def campaign(spark: SparkSession, sf: str) -> DataFrame:
    """Zone statistics of campaigns: a sensor's half month is one scene, so a month has ten scenes at any scale.

    What pairs are made of needs no medians, so groups of any size are one aggregation.
    """
    p = products(spark, sf).withColumn("half", F.when(F.dayofmonth("acq_date") <= 15, 1).otherwise(16))
    p = p.withColumn("acq_date", F.make_date("ano", "mes", "half"))
    p = p.withColumn("scene", F.concat_ws("_", "sensor", F.col("acq_date").cast("string")))
    return R.scene_stats(p, ["scene", "zone_id"], SCENE[:4], medians=False)


#: The same projection as common table expressions of another engine.
SQL = r"""
named AS (
  SELECT o_orderkey AS scene, concat_ws('_',
    CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'LC08' WHEN '2' THEN 'LC09' WHEN '3' THEN 'LE07' WHEN '4' THEN 'LT05' ELSE 'XX04' END,
    'L2SP', lpad((o_custkey % 233)::VARCHAR, 3, '0') || lpad((o_custkey % 97)::VARCHAR, 3, '0'),
    CASE WHEN o_orderkey % 101 = 0 THEN '20011399' ELSE strftime(o_orderdate, '%Y%m%d') END, '20200101', '02',
    CASE o_orderstatus WHEN 'F' THEN 'T1' WHEN 'O' THEN 'T2' ELSE 'RT' END) AS scene_id,
    (o_orderkey * 7 % 101)::DOUBLE AS cloud_cover, (30 + o_orderkey * 13 % 50)::DOUBLE AS sun_elevation,
    3.41802e-3 AS st_scale, 149e0 + (o_orderkey % 3) * 0.5e0 AS st_offset
  FROM orders),
decoded AS (
  SELECT *, split_part(scene_id, '_', 1) AS sensor_prefix, split_part(scene_id, '_', 3) AS pathrow,
    try_strptime(split_part(scene_id, '_', 4), '%Y%m%d')::DATE AS acq_date, split_part(scene_id, '_', 7) AS tier,
    CASE split_part(scene_id, '_', 1) WHEN 'LC08' THEN 'Landsat8' WHEN 'LC09' THEN 'Landsat9' WHEN 'LE07' THEN 'Landsat7' WHEN 'LT05' THEN 'Landsat5' END AS sensor
  FROM named),
scenes AS (
  SELECT *, year(acq_date)::INT AS ano, month(acq_date)::INT AS mes FROM decoded
  WHERE regexp_matches(scene_id, '^(LC08|LC09|LE07|LT05|LT04)_L2SP_') AND year(acq_date) BETWEEN 1995 AND 2001 AND tier IN ('T1', 'RT')),
pixels AS (
  SELECT l_orderkey AS scene, l_partkey AS cell, l_linenumber AS line, s_nationkey AS zone_id,
    (64 + CASE WHEN l_partkey % 23 = 0 THEN 1 ELSE 0 END + CASE WHEN l_partkey % 19 = 0 THEN 2 ELSE 0 END
     + CASE WHEN l_partkey % 7 = 0 THEN 8 ELSE 0 END + CASE WHEN l_suppkey % 11 = 0 THEN 16 ELSE 0 END
     + CASE WHEN l_partkey % 13 = 0 THEN 32 ELSE 0 END + CASE WHEN l_suppkey % 17 = 0 THEN 128 ELSE 0 END)::INT AS qa,
    CASE WHEN l_partkey % 29 = 0 THEN 0 ELSE 7273 + (l_partkey * 31 + l_suppkey * 17) % 20000 END AS dn_red,
    7273 + (l_partkey * 13 + l_linenumber * 1999 + l_orderkey * 7) % 37000 AS dn_nir,
    CASE WHEN l_orderkey % 53 = 0 THEN 400 WHEN l_partkey % 31 = 0 THEN 64000 ELSE 30000 + (l_partkey * 101 + l_orderkey * 37) % 24000 END AS dn_st
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
lit AS (
  SELECT p.*, s.* EXCLUDE (scene), (qa & 187) = 0 AS clear,
    CASE WHEN (qa & 187) = 0 AND dn_red <> 0 THEN dn_red * 2.75e-5 + (-2e-1) END AS r0,
    CASE WHEN (qa & 187) = 0 AND dn_nir <> 0 THEN dn_nir * 2.75e-5 + (-2e-1) END AS n0,
    CASE WHEN (qa & 187) = 0 THEN dn_st END AS dn_clear
  FROM pixels p JOIN scenes s USING (scene)),
bounded AS (
  SELECT *, CASE WHEN r0 BETWEEN 0 AND 1 THEN r0 END AS sr_red, CASE WHEN n0 BETWEEN 0 AND 1 THEN n0 END AS sr_nir,
    dn_clear < (-20e0 + 273.15e0 - st_offset) / st_scale AS below_sentinel, dn_clear * st_scale + st_offset - 273.15e0 AS lst_raw
  FROM lit),
products AS (
  SELECT *, CASE WHEN ndvi_raw BETWEEN -1 AND 1 THEN ndvi_raw END AS ndvi,
    CASE WHEN NOT below_sentinel AND lst_raw BETWEEN -20 AND 75 THEN lst_raw END AS lst_c
  FROM (SELECT *, CASE WHEN sr_nir + sr_red <> 0 THEN (sr_nir - sr_red) / (sr_nir + sr_red) END AS ndvi_raw FROM bounded))
"""

SIX = ", ".join(
    f"avg({v}) AS {v}_media, median({v}) AS {v}_mediana, min({v}) AS {v}_min, max({v}) AS {v}_max, stddev_samp({v}) AS {v}_dp, count({v}) AS {v}_n" for v in ("ndvi", "lst_c")
)
KEYS = "scene, sensor, acq_date, ano, mes, cloud_cover, sun_elevation"
#: Every zone is part of every scene that has pixels, with counts of 0 where it has none itself.
SQL_STATS = SQL + f""", scene_stats AS (SELECT {KEYS}, {SIX} FROM products GROUP BY ALL),
zone_scene_stats AS (
  SELECT zone_id, s.*, r.* EXCLUDE (scene, zone_id) REPLACE (coalesce(r.ndvi_n, 0) AS ndvi_n, coalesce(r.lst_c_n, 0) AS lst_c_n)
  FROM (SELECT n_nationkey AS zone_id FROM nation) z CROSS JOIN (SELECT {KEYS} FROM scene_stats) s
  LEFT JOIN (SELECT scene, zone_id, {SIX} FROM products GROUP BY ALL) r USING (scene, zone_id))"""


def _mix(source: str, keys: str) -> str:
    return f"SELECT {keys}, sum(k)::BIGINT AS n_cenas, string_agg(code || 'x' || k, ', ' ORDER BY code) AS sensores_usados FROM (SELECT {keys}, replace(sensor, 'Landsat', 'L') AS code, count(*) AS k FROM {source} GROUP BY ALL) GROUP BY ALL"


def _rolled(source: str, keys: str) -> str:
    parts = []
    for v in ("ndvi", "lst_c"):
        mean = lambda x, v=v: f"sum(CASE WHEN {v}_n > 0 THEN {v}_{x} * {v}_n END) / sum(CASE WHEN {v}_n > 0 AND {v}_{x} IS NOT NULL THEN {v}_n END)"
        parts.append(f"{mean('media')} AS {v}_media, {mean('mediana')} AS {v}_mediana, min({v}_min) AS {v}_min, max({v}_max) AS {v}_max, {mean('dp')} AS {v}_dp, sum({v}_n)::BIGINT AS {v}_n")
    sky = "sum(CASE WHEN ndvi_n > 0 THEN cloud_cover * ndvi_n END) / sum(CASE WHEN ndvi_n > 0 THEN ndvi_n END) AS cloud_cover_med, sum(CASE WHEN ndvi_n > 0 THEN sun_elevation * ndvi_n END) / sum(CASE WHEN ndvi_n > 0 THEN ndvi_n END) AS sun_elev_med"
    return f"SELECT {keys}, {', '.join(parts)}, {sky} FROM {source} GROUP BY ALL"


MONTHS = "SELECT y::INT AS ano, m::INT AS mes FROM range(1995, 2002) a(y), range(1, 13) b(m)"
DATED = "make_date(ano, mes, 15) AS data_ref, strftime(make_date(ano, mes, 15), '%B') AS mes_nome"
SQL_MONTHLY = SQL_STATS + f""",
monthly AS (SELECT *, {DATED} FROM ({MONTHS}) LEFT JOIN ({_rolled('scene_stats', 'ano, mes')}) USING (ano, mes) LEFT JOIN ({_mix('scene_stats', 'ano, mes')}) USING (ano, mes)),
zone_monthly AS (SELECT *, {DATED} FROM (SELECT n_nationkey AS zone_id, g.* FROM nation, ({MONTHS}) g)
  LEFT JOIN ({_rolled('zone_scene_stats', 'zone_id, ano, mes')}) USING (zone_id, ano, mes) LEFT JOIN ({_mix('zone_scene_stats', 'zone_id, ano, mes')}) USING (zone_id, ano, mes)),
good_months AS (SELECT * FROM zone_monthly WHERE NOT ((ano = 1996 AND mes = 3) OR (ano = 1999 AND mes = 7)))
"""


def annual_sql(source: str, keys: str) -> str:
    parts = [
        f"sum(CASE WHEN {v}_n > 0 THEN {v}_media * {v}_n END) / sum(CASE WHEN {v}_n > 0 AND {v}_media IS NOT NULL THEN {v}_n END) AS {s}_media_anual, min({v}_min) AS {s}_min_anual, max({v}_max) AS {s}_max_anual, coalesce(sum({v}_n), 0)::BIGINT AS {v}_n_total"
        for v, s in (("ndvi", "ndvi"), ("lst_c", "lst"))
    ]
    part = f"SELECT {keys}, unnest(string_split(sensores_usados, ', ')) AS p FROM {source}"
    mix = f"SELECT {keys}, string_agg(code || 'x' || k, ', ' ORDER BY code) AS sensores_usados FROM (SELECT {keys}, split_part(p, 'x', 1) AS code, sum(split_part(p, 'x', 2)::BIGINT)::BIGINT AS k FROM ({part}) GROUP BY ALL) GROUP BY ALL"
    return f"SELECT * FROM (SELECT {keys}, count(ndvi_media) AS n_meses_com_dados, {', '.join(parts)} FROM {source} GROUP BY ALL) LEFT JOIN ({mix}) USING ({keys})"
