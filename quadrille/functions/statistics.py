"""Aggregates and guarded statistics as expressions; every one is null where its guard fails, none throws."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: What :func:`on_grid` takes for a hair.
HAIR = 3.3e-10


def clean(x: Column) -> Column:
    """NaN counts as missing."""
    return F.when(~F.isnan(x), x)


def weighted_mean(x: Column, w: Column) -> Column:
    """Over rows with a value and a positive weight."""
    ok = x.isNotNull() & (w > 0)
    return F.try_divide(F.sum(F.when(ok, x * w)), F.sum(F.when(ok, w)))


def summary(x: Column, median: Column | None, name: str) -> list[Column]:
    """Mean, median (an aggregate, or none here), least, largest, sample deviation and count."""
    return [
        F.avg(x).alias(f"{name}_media"),
        *([] if median is None else [median.alias(f"{name}_mediana")]),
        F.min(x).alias(f"{name}_min"),
        F.max(x).alias(f"{name}_max"),
        F.stddev_samp(x).alias(f"{name}_dp"),
        F.count(x).alias(f"{name}_n"),
    ]


def pearson(x: Column, y: Column, least: int = 2) -> Column:
    """Over complete pairs; null for fewer than ``least`` or a constant side."""
    both = x.isNotNull() & y.isNotNull()
    a, b = F.when(both, x), F.when(both, y)
    return F.when(F.count(a) >= least, F.try_divide(F.covar_samp(a, b), F.stddev_samp(a) * F.stddev_samp(b)))


def average_rank(value: str, by: Sequence[str]) -> Column:
    """Rank within groups, ties at their mean rank."""
    first = F.rank().over(Window.partitionBy(*by).orderBy(value))
    return first + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / F.lit(2.0)


def with_ranks(df: DataFrame, x: str, y: str, by: Sequence[str]) -> DataFrame:
    """Complete pairs with their average ranks ``rank_x`` and ``rank_y``: Pearson of these is Spearman."""
    pairs = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    return pairs.withColumns({"rank_x": average_rank(x, by), "rank_y": average_rank(y, by)})


def slope(y: Column, x: Column, least: int) -> Column:
    return F.when(F.count(F.when(x.isNotNull(), y)) >= least, F.regr_slope(y, x))


def concordance(a: Column, b: Column) -> Column:
    """Lin's concordance coefficient, from three pairs on."""
    spread = F.var_samp(a) + F.var_samp(b) + F.pow(F.avg(a) - F.avg(b), 2)
    return F.when((F.count(a) >= 3) & (spread > 0), F.try_divide(2 * F.covar_samp(a, b), spread))


def major_axis_slope(a: Column, b: Column) -> Column:
    """Slope of the standardised major axis; null for fewer than three pairs, a constant side or no covariance."""
    cov = F.covar_samp(a, b)
    return F.when((F.count(a) >= 3) & (cov != 0), F.try_divide(F.signum(cov) * F.stddev_samp(b), F.nullif(F.stddev_samp(a), F.lit(0.0))))


def cv_pct(x: Column) -> Column:
    return F.try_divide(100 * F.stddev_samp(x), F.avg(x))


def on_grid(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded half up, where a value a hair below a tie counts as the tie.

    For comparing rows of two engines by equality: sums taken in another order differ in their last bits, and means of
    a few digital numbers often are ties.
    """
    return rounded(df.select(*[(F.col(c) + HAIR).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes]), digits)


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Every double column rounded, without negative zeros; for sinks."""
    return df.select(*[(F.round(c, digits) + 0.0).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


# --- Student's t, for tables of a few rows ----------------------------------------------------------------------------


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, by Lentz's method."""
    tiny, c = 1e-300, 1.0
    d = 1.0 / max(1.0 - (a + b) * x / (a + 1), tiny)
    h = d
    for m in range(1, 400):
        for step in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1.0 / (1.0 + step * d or tiny)
            c = 1.0 + step / c or tiny
            h *= d * c
        if abs(d * c - 1) < 1e-15:
            break
    return h


def _beta(a: float, b: float, x: float) -> float:
    if x <= 0 or x >= 1:
        return float(x >= 1)
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    return front * _beta_fraction(a, b, x) / a if x < (a + 1) / (a + b + 2) else 1 - front * _beta_fraction(b, a, 1 - x) / b


def t_two_sided(t: float, df: float) -> float:
    """Probability of a larger absolute value."""
    return _beta(df / 2, 0.5, df / (df + t * t))


def t_quantile(p: float, df: float) -> float:
    """Value below which a share ``p`` of at least one half lies."""
    low, high = 0.0, 1.0
    while 1 - t_two_sided(high, df) / 2 < p:
        high *= 2
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if 1 - t_two_sided(mid, df) / 2 < p else (low, mid)
    return (low + high) / 2
