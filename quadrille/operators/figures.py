"""Tables behind figures: histograms, box summaries, colour limits, stacked panels."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .quantiles import quantiles


def histogram(df: DataFrame, value: str, bins: int = 28) -> DataFrame:
    """Bins of equal width between the extremes: ``bin, low, high, n``; empty bins stay."""
    x = F.col(value).cast("double")
    ends = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    at = F.least(F.floor(F.try_divide((x - F.col("lo")) * bins, F.col("hi") - F.col("lo"))), F.lit(bins - 1))
    counted = df.where(x.isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    grid = ends.select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    return grid.join(counted, "bin", "left").select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def boxes(df: DataFrame, value: str, by: Sequence[str]) -> DataFrame:
    q = {f"q{p:02d}": F.percentile(value, p / 100) for p in (25, 50, 75)}
    return df.where(F.col(value).isNotNull()).groupBy(*by).agg(F.count("*").alias("n"), F.min(value).alias("low"), *[c.alias(n) for n, c in q.items()], F.max(value).alias("high"))


def density(df: DataFrame, value: str, by: Sequence[str], panel: Sequence[str], points: int = 512) -> DataFrame:
    """``by, i, x, density``: a Gaussian kernel estimate at ``points`` places over the range of the panel.

    The bandwidth is Silverman's, from the smaller of the deviation and the quartiles' distance.  Values are first
    shared out between the two places next to them, so the sum over values becomes one over places: a group is an
    array of ``points`` weights whatever its size.  ``df`` is read three times, so it should be a written table.
    """
    rows = df.where(F.col(value).isNotNull()).select(*{*by, *panel}, F.col(value).cast("double").alias("v_"))
    ends = rows.groupBy(*panel).agg(F.min("v_").alias("__lo"), F.max("v_").alias("__hi"))
    q = quantiles(rows, by, ["v_"], (0.25, 0.75), [F.count("*").alias("k"), F.stddev_samp("v_").alias("sd"), *[F.first(c).alias(c) for c in panel if c not in by]])
    narrow = F.least("sd", (F.col("v__q1") - F.col("v__q0")) / 1.34)
    wide = F.coalesce(F.nullif(narrow, F.lit(0.0)), F.nullif("sd", F.lit(0.0)), F.lit(1.0))
    bands = q.select(*by, "k", (0.9 * wide * F.pow(F.col("k").cast("double"), F.lit(-0.2))).alias("__bw"))
    step = (F.col("__hi") - F.col("__lo")) / (points - 1)
    at = F.coalesce(F.try_divide(F.col("v_") - F.col("__lo"), step), F.lit(0.0))
    left = F.least(F.floor(at), F.lit(points - 1)).cast("int")
    share = at - left
    both = F.explode(F.array(F.struct(left.alias("j"), (1 - share).alias("w")), F.struct(F.least(left + 1, F.lit(points - 1)).alias("j"), share.alias("w")))).alias("p")
    weights = rows.join(ends, list(panel)).select(*by, "__lo", "__hi", both).groupBy(*by, "__lo", "__hi", "p.j").agg(F.sum("p.w").alias("w"))
    lists = weights.groupBy(*by, "__lo", "__hi").agg(F.collect_list(F.struct("j", "w")).alias("w"))  # at most ``points`` of them
    made = lists.join(bands, list(by)).select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    apart = lambda e: (e["j"] - F.col("i")) * step / F.col("__bw")
    total = F.aggregate("w", F.lit(0.0), lambda a, e: a + e["w"] * F.exp(-apart(e) * apart(e) / 2))
    return made.select(*by, "i", (F.col("__lo") + F.col("i") * step).alias("x"), (total / (F.col("k") * F.col("__bw") * math.sqrt(2 * math.pi))).alias("density"))


def color_limits(df: DataFrame, value: str, digits: int = 1) -> DataFrame:
    """The middle 96 percent, padded and rounded outwards."""
    x = F.col(value)
    q = df.where(x.isNotNull() & ~F.isnan(x)).agg(F.percentile(value, 0.02).alias("a"), F.percentile(value, 0.98).alias("b"))
    unit = 10.0**-digits
    pad = F.greatest(0.15 * (F.col("b") - F.col("a")), F.lit(unit))
    return q.select((F.floor((F.col("a") - pad) / unit) * unit).alias("low"), (F.ceil((F.col("b") + pad) / unit) * unit).alias("high"))


def panels(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Series of several variables under one another."""
    return df.unpivot(list(keys), list(values), "variable", "value")
