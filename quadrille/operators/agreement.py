"""Agreement of sensors: scenes of one month, paired zone by zone."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import Settings
from ..functions import scene as S
from ..functions.statistics import average_rank, concordance, major_axis_slope, pearson, t_quantile, t_two_sided, with_ranks
from .series import VARIABLES

#: Smallest absolute mean against which a difference is given as a percentage.
LEAST_MEAN = {"ndvi": 0.1, "lst_c": 1e-6}


def shared_months(scenes: DataFrame) -> DataFrame:
    """Months with two or more usable scenes: ``ano, mes`` with scenes, sensors, dates, span and kind."""
    usable = scenes.where(F.col("ndvi_media").isNotNull() | F.col("lst_c_media").isNotNull())
    out = usable.groupBy("ano", "mes").agg(
        F.count("*").alias("n_scenes"),
        F.count_distinct("sensor").alias("n_sensors"),
        F.array_join(F.array_sort(F.collect_set("sensor")), ", ").alias("sensors"),
        F.array_join(F.transform(F.array_sort(F.collect_list("acq_date")), lambda d: d.cast("string")), ", ").alias("dates"),
        F.date_diff(F.max("acq_date"), F.min("acq_date")).alias("span_days"),
    )
    return out.where("n_scenes >= 2").withColumn("kind", F.when(F.col("n_sensors") > 1, "Between instruments").otherwise("Same instrument"))


def zone_anomalies(zone_scenes: DataFrame) -> DataFrame:
    """Long table ``..., variable, value, anomaly``: the anomaly is from the scene's mean weighted by pixels."""
    w = Window.partitionBy("scene")
    rows = []
    for v in VARIABLES:
        x, n = F.col(f"{v}_media"), F.col(f"{v}_n")
        city = F.try_divide(F.sum(x * n).over(w), F.sum(F.when(x.isNotNull(), n)).over(w).cast("double"))
        rows.append(F.struct(F.lit(v).alias("variable"), x.alias("value"), (x - city).alias("anomaly")))
    named = zone_scenes.withColumns({f"__{v}": r for v, r in zip(VARIABLES, rows, strict=True)})
    each = F.explode(F.array(*[F.col(f"__{v}") for v in VARIABLES])).alias("r")
    return named.select("scene", "sensor", "acq_date", "ano", "mes", "zone_id", each).select("scene", "sensor", "acq_date", "ano", "mes", "zone_id", "r.*").where("value is not null")


def scene_pairs(long: DataFrame) -> DataFrame:
    """Unordered pairs of scenes of one month, zone and variable, the earlier (then the smaller name) first.

    The scenes of a month and zone, which are few, are gathered in one array and paired there, so what makes them runs
    once; the pairs of a month are those of its scenes, never of its pixels.
    """
    key = ["ano", "mes", "zone_id", "variable"]
    scenes = F.array_sort(F.collect_list(F.struct("acq_date", "scene", "sensor", "value", "anomaly")))
    grouped = long.groupBy(*key).agg(scenes.alias("s")).where(F.size("s") > 1)
    later = lambda a, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda b: F.struct(a.alias("a"), b.alias("b")))
    pairs = grouped.select(*key, F.explode(F.flatten(F.transform("s", later))).alias("p"))
    names = {"scene": "scene", "sensor": "sensor", "acq_date": "date", "value": "value", "anomaly": "anomaly"}
    pairs = pairs.select(*key, *[F.col(f"p.{s}.{c}").alias(f"{n}_{s}") for c, n in names.items() for s in "ab"])
    mean, diff = (F.col("value_a") + F.col("value_b")) / 2, F.col("value_b") - F.col("value_a")
    least = F.when(F.col("variable") == "ndvi", LEAST_MEAN["ndvi"]).otherwise(LEAST_MEAN["lst_c"])
    return pairs.withColumns(
        {
            "gap_days": F.date_diff("date_b", "date_a"),
            "pair": S.pair_label(F.col("sensor_a"), F.col("sensor_b")),
            "comparison": F.when(F.col("sensor_a") == F.col("sensor_b"), "Same instrument").otherwise("Between instruments"),
            "diff_abs": diff,
            "mean_ab": mean,
            "diff_pct": F.when(F.abs(mean) > least, 100 * diff / mean),
            "diff_anom": F.col("anomaly_b") - F.col("anomaly_a"),
        }
    )


def pair_summary(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Counts, gap, bias and mean absolute differences; ``reduction`` is what anomalies save."""
    d = F.abs("diff_abs")
    out = pairs.groupBy(*by).agg(
        F.count("*").alias("n"),
        F.count_distinct(F.struct("ano", "mes")).alias("n_months"),
        F.median("gap_days").alias("median_gap"),
        F.avg("diff_abs").alias("mean_diff"),
        F.avg(d).alias("mad"),
        F.stddev_samp("diff_abs").alias("sd_diff"),
        F.percentile(d, 0.95).alias("p95"),
        F.avg(F.abs("diff_pct")).alias("mad_pct"),
        F.avg(F.abs("diff_anom")).alias("mad_anom"),
    )
    return out.withColumn("reduction", 100 * (1 - F.try_divide(F.col("mad_anom"), F.col("mad"))))


PAIR = ["variable", "comparison", "pair", "ano", "mes", "scene_a", "scene_b"]
#: Measures of a pair of scenes, each of the values and of their anomalies.
MEASURES = ("pearson", "spearman", "ccc", "sma")


def pair_metrics(pairs: DataFrame, settings: Settings) -> DataFrame:
    """Per pair of scenes, over zones: correlations, concordance and axis slope of values and of anomalies, and means."""
    ranked = pairs.withColumns({f"__r{c}": average_rank(c, PAIR) for c in ("value_a", "value_b", "anomaly_a", "anomaly_b")})
    each = []
    for end, column in (("", "value"), ("_anom", "anomaly")):
        a, b = F.col(f"{column}_a"), F.col(f"{column}_b")
        each += [
            pearson(a, b, 3).alias(f"pearson{end}"),
            pearson(F.col(f"__r{column}_a"), F.col(f"__r{column}_b"), 3).alias(f"spearman{end}"),
            concordance(a, b).alias(f"ccc{end}"),
            major_axis_slope(a, b).alias(f"sma{end}"),
        ]
    means = [F.avg("value_a").alias("mean_a"), F.avg("value_b").alias("mean_b"), F.avg("diff_abs").alias("mean_diff"), F.avg("diff_anom").alias("mean_diff_anom"), F.avg(F.abs("diff_abs")).alias("mad")]
    out = ranked.groupBy(*PAIR).agg(F.count("*").alias("n_zones"), F.first("gap_days").alias("gap_days"), *each, *means)
    return out.where(F.col("n_zones") >= settings.pair_zones)


def concordance_summary(metrics: DataFrame) -> DataFrame:
    """Medians and quartiles of the measures over pairs of scenes."""
    out = []
    for c in (f"{m}{end}" for end in ("", "_anom") for m in MEASURES):
        out += [F.median(c).alias(f"{c}_median"), F.percentile(c, 0.25).alias(f"{c}_q25"), F.percentile(c, 0.75).alias(f"{c}_q75")]
    return metrics.groupBy("variable", "comparison").agg(F.count("*").alias("n_pairs"), F.median("n_zones").alias("zones_median"), *out)


def reliability(long: DataFrame, pairs: DataFrame) -> DataFrame:
    """Share of the spread between zones that is signal, of anomalies and of values, by kind of pair.

    The error is the spread of paired differences over the root of two; a slope on a covariate of reliability ``r`` is
    drawn towards zero by that factor.
    """
    signal = long.groupBy("variable").agg(F.stddev_samp("value").alias("sd_signal"), F.stddev_samp("anomaly").alias("sd_signal_anom"))
    noise = lambda c: F.stddev_samp(c) / F.sqrt(F.lit(2.0))
    out = pairs.groupBy("variable", "comparison").agg(F.count("*").alias("n"), noise("diff_abs").alias("sd_err"), noise("diff_anom").alias("sd_err_anom"))
    out = out.join(signal, "variable", "left")
    for end in ("", "_anom"):
        spread, error = F.col(f"sd_signal{end}"), F.col(f"sd_err{end}")
        true = F.greatest(spread * spread - error * error, F.lit(0.0))
        out = out.withColumns({f"var_true{end}": true, f"snr{end}": F.when(error > 0, F.try_divide(F.sqrt(true), error)), f"lambda{end or '_abs'}": F.when(spread > 0, F.try_divide(true, spread * spread))})
    out = out.withColumn("attenuation_pct", 100 * (1 - F.col("lambda_anom")))
    return out.withColumn("verdict", F.when(F.col("attenuation_pct") > 25, "strong").when(F.col("attenuation_pct") > 10, "moderate").when(F.col("attenuation_pct").isNotNull(), "slight"))


def limits(summary: DataFrame) -> DataFrame:
    """Mean difference and its limits of agreement, from :func:`pair_summary`."""
    bias, sd = F.col("mean_diff"), F.col("sd_diff")
    return summary.select("variable", "comparison", "n", bias.alias("bias"), (bias - 1.96 * sd).alias("lower"), (bias + 1.96 * sd).alias("upper"), "p95")


def gap_dependence(pairs: DataFrame) -> DataFrame:
    """How the absolute difference grows with days between scenes."""
    by = ["variable", "comparison"]
    d = pairs.select(*by, F.col("gap_days").cast("double").alias("gap"), F.abs("diff_abs").alias("d"))
    return with_ranks(d, "gap", "d", by).groupBy(*by).agg(
        F.count("*").alias("n"),
        F.min("gap").alias("min_gap"),
        F.max("gap").alias("max_gap"),
        F.median("gap").alias("median_gap"),
        F.when(F.count("*") > 5, F.regr_slope("d", "gap")).alias("slope"),
        pearson(F.col("rank_x"), F.col("rank_y"), 3).alias("spearman"),
    )


def validation(summary: DataFrame, gaps: DataFrame, reliable: DataFrame, concord: DataFrame) -> DataFrame:
    """Limits, gap dependence, reliability and concordance of each kind of pair, side by side."""
    by = ["variable", "comparison"]
    out = limits(summary).join(gaps.drop("n"), by, "left")
    out = out.join(reliable.select(*by, "sd_signal_anom", "sd_err_anom", "snr_anom", "lambda_anom", "attenuation_pct"), by, "left")
    kept = ["spearman_anom", "ccc_anom", "sma_anom", "spearman", "ccc"]
    return out.join(concord.select(*by, "n_pairs", *[f"{c}_median" for c in kept]), by, "left")


def interpretation(summary: DataFrame, concord: DataFrame) -> DataFrame:
    """What the report says of pairs between instruments, by variable; null where there is nothing to judge.

    ``anomalies_help``: they take away more than half of the difference.  ``instrument_effect``: pairs of one
    instrument differ by less than four fifths of what pairs between instruments do.
    """
    between = summary.where("comparison = 'Between instruments'").select("variable", "mad", "reduction")
    same = summary.where("comparison = 'Same instrument'").select("variable", F.col("mad").alias("mad_same"))
    ranks = concord.where("comparison = 'Between instruments'").select("variable", F.col("spearman_anom_median").alias("rho"), F.col("sma_anom_median").alias("sma"))
    rho = F.when(F.col("rho") > 0.8, "strong").when(F.col("rho") > 0.5, "moderate").when(F.col("rho").isNotNull(), "weak")
    scale = F.when(F.abs(F.col("sma") - 1) < 0.15, "same scale").when(F.col("sma").isNotNull(), "other scale")
    out = between.join(same, "variable", "left").join(ranks, "variable", "left")
    return out.select("variable", "reduction", (F.col("reduction") > 50).alias("anomalies_help"), (F.col("mad_same") < 0.8 * F.col("mad")).alias("instrument_effect"), "rho", rho.alias("rank_agreement"), "sma", scale.alias("scale"))


def directional(pairs: DataFrame) -> DataFrame:
    """Newer less older instrument, from means of pairs of scenes: bias of values and anomalies, standard error and t."""
    older_a = S.generation(F.col("sensor_a")) <= S.generation(F.col("sensor_b"))
    signed = lambda c: F.when(older_a, F.col(c)).otherwise(-F.col(c))
    new, old = F.when(older_a, F.col("sensor_b")).otherwise(F.col("sensor_a")), F.when(older_a, F.col("sensor_a")).otherwise(F.col("sensor_b"))
    rows = pairs.where("comparison = 'Between instruments'").withColumn("direction", F.concat_ws(" - ", S.short_sensor(new), S.short_sensor(old)))
    means = rows.groupBy("variable", "direction", "ano", "mes", "scene_a", "scene_b").agg(F.avg(signed("diff_abs")).alias("m"), F.avg(signed("diff_anom")).alias("m_anom"))
    out = means.groupBy("variable", "direction").agg(F.count("*").alias("n_pairs"), F.avg("m").alias("bias"), F.stddev_samp("m").alias("sd"), F.avg("m_anom").alias("bias_anom"))
    out = out.withColumn("se", F.col("sd") / F.sqrt(F.col("n_pairs").cast("double")))
    return out.withColumn("t", F.when(F.col("se") > 0, F.try_divide(F.col("bias"), F.col("se"))))


def with_p_values(bias: DataFrame, level: float = 0.95) -> DataFrame:
    """Adds ``p_value, ci_low, ci_high``; a table of a row for each pair of sensors, so a Python function will do."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            df = f["n_pairs"] - 1
            ok = (df > 0) & f["t"].notna()
            f["p_value"] = [t_two_sided(t, d) if o else None for t, d, o in zip(f["t"], df, ok, strict=True)]
            half = [t_quantile((1 + level) / 2, d) * s if o else None for d, s, o in zip(df, f["se"], ok, strict=True)]
            f["ci_low"], f["ci_high"] = f["bias"] - pd.Series(half, dtype=float), f["bias"] + pd.Series(half, dtype=float)
            yield f

    schema = ", ".join(f"{c} {t}" for c, t in bias.dtypes) + ", p_value double, ci_low double, ci_high double"
    return bias.mapInPandas(run, schema)
