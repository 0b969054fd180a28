"""The diagnostics over a finished run's tables: coverage, climate, zone series, ranks and agreement of sensors.

Inputs are found by the columns they have; outputs are CSV tables, and LaTeX for the agreement of sensors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..operators import agreement as G
from ..operators import climate as K
from ..operators import coverage as V
from ..operators import ranking as N
from ..operators import series as R
from ..sources import files, sinks

#: The run's own column names for the names that tables are brought to.
OWN = {"year": "ano", "month": "mes", "ndvi_mean": "ndvi_media", "lst_mean": "lst_c_media"}


def _dated(df: DataFrame) -> DataFrame:
    out = df.withColumnsRenamed(OWN)
    return out.withColumns({"ano": F.col("ano").cast("int"), "mes": F.col("mes").cast("int")}).withColumn("data_ref", F.make_date("ano", "mes", F.lit(15)))


def tables(spark: SparkSession, results: str, settings: Settings, climate: DataFrame | None = None, zone_scenes: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables by the path they are written to; those of the climate and of sensors only where their input is given."""
    city, zones = _dated(files.load_city(spark, results)), _dated(files.load_zones(spark, results))
    settings = R.study_period(zones, settings)
    calendar = V.calendar(city, settings)
    out = {"coverage/by_month": calendar, "coverage/by_zone": V.zone_coverage(zones, settings), "coverage/by_year": V.by_year(calendar)}
    if climate is not None:
        pairs = K.enough_months(K.matched(city, climate, settings))
        out["climate/correlation_city"] = K.correlation(pairs)
        out["climate/correlation_by_zone"] = K.correlation(K.matched(zones, climate, settings), ["zone_id", "zone_name"], least=settings.zone_months)
    for v, name in (("lst_c_media", "lst"), ("ndvi_media", "ndvi")):
        key = ["zone_id", "zone_name"]
        stats = R.long_run(zones, v, key, settings)
        out[f"{name}/statistics_by_zone"] = stats if name == "lst" else stats.drop("cv_pct")
        out[f"{name}/climatology_by_zone"] = R.means_by(zones, v, ["zone_name", "mes"], settings)
        out[f"{name}/annual_means_by_zone"] = R.means_by(zones, v, ["zone_name", "ano"], settings)
    ranked = N.monthly_ranks(zones, "lst_c_media", settings, "zone_name")
    out |= {"ranking/by_month": ranked, "ranking/persistence": N.persistence(ranked, "zone_name"), "ranking/amplitude": N.amplitude(ranked)}
    if zone_scenes is not None:
        out |= {f"sensors/{name}": df for name, df in sensors(zone_scenes, settings).items()}
    return out


def sensors(zone_scenes: DataFrame, settings: Settings) -> dict[str, DataFrame]:
    """The tables of agreement from zone statistics ``scene, sensor, acq_date, ano, mes, zone_id, ndvi_*, lst_c_*``."""
    long = G.zone_anomalies(zone_scenes)
    pairs = G.scene_pairs(long)
    scenes = zone_scenes.groupBy("scene", "sensor", "acq_date", "ano", "mes").agg(F.avg("ndvi_media").alias("ndvi_media"), F.avg("lst_c_media").alias("lst_c_media"))
    summary, metrics = G.pair_summary(pairs, ["variable", "comparison"]), G.pair_metrics(pairs, settings)
    concord, gaps, reliable = G.concordance_summary(metrics), G.gap_dependence(pairs), G.reliability(long, pairs)
    return {
        "shared_months": G.shared_months(scenes),
        "pairs": pairs,
        "summary": summary,
        "by_pair": G.pair_summary(pairs, ["variable", "pair", "comparison"]),
        "per_scene_pair": metrics,
        "concordance": concord,
        "reliability": reliable,
        "directional_bias": G.with_p_values(G.directional(pairs)),
        "validation": G.validation(summary, gaps, reliable, concord),
    }


#: Tables that also come as LaTeX, with their captions.
LATEX = {"summary": "Agreement of sensors", "concordance": "Concordance within pairs of scenes", "reliability": "Reliability of the anomaly", "directional_bias": "Newer less older instrument"}


#: Tables in the order of their measure, largest first; all others in that of their keys.
BY_MEASURE = {
    "climate/correlation_by_zone": ["pearson"],
    "lst/statistics_by_zone": ["mean"],
    "ndvi/statistics_by_zone": ["mean"],
    "ranking/persistence": ["mean_rank"],
    "sensors/directional_bias": ["variable", "n_pairs"],
    "sensors/by_pair": ["variable", "n"],
}


def order_of(name: str, df: DataFrame) -> list:
    """How a table is sorted when it is written; keys break ties of measures."""
    keys = [c for c in ("variable", "comparison", "pair", "direction", "zone_id", "zone_name", "ano", "mes", "scene_a", "scene_b") if c in df.columns]
    first = [F.col(c) if c == "variable" else F.col(c).desc_nulls_last() for c in BY_MEASURE.get(name, [])]
    return [*first, *keys]


def write(spark: SparkSession, results: str, out: str, settings: Settings, climate: DataFrame | None = None, zone_scenes: DataFrame | None = None) -> list[str]:
    """Write the set below ``out``; returns the names of its tables."""
    made = tables(spark, results, settings, climate, zone_scenes)
    for name, df in made.items():
        sinks.write_csv(df, f"{out}/{name}", order=order_of(name, df))
    if zone_scenes is not None:
        texts = {n: sinks.latex(made[f"sensors/{n}"].orderBy("variable"), caption, f"tab:{n}") for n, caption in LATEX.items()}
        for n, text in texts.items():
            sinks.write_lines(spark, text.splitlines(), f"{out}/sensors/latex_{n}")
        sinks.write_lines(spark, [line for text in texts.values() for line in [*text.splitlines(), ""]], f"{out}/sensors/latex_all")
    return list(made)
