"""Exact quantiles of groups of any size, in two passes that gather no group.

The first pass takes a sketch of each group, of bounded size, whose two values surely lie around the quantile.  The
second counts what lies below them and keeps only the values between: some thousandth of the group, whatever its ties,
because values equal to a bound are counted and not kept.  Both passes are aggregations with partial sums where the rows
are, so a group that fills many partitions is dealt over all of them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks that a sketch may be wrong by, as a share of the group, and how far from the quantile its bounds are asked for.
ERROR, MARGIN = 1e-4, 5e-4
#: Groups with fewer values are kept whole: the margin is then less than some ranks.
SMALL = 10_000


def _sketch(x: str, fraction: float, name: str) -> list[Column]:
    asked = [max(0.0, fraction - MARGIN), min(1.0, fraction + MARGIN)]
    return [F.percentile_approx(x, asked, round(1 / ERROR)).alias(f"{name}_near")]


def quantiles(df: DataFrame, by: Sequence[str], columns: Sequence[str], fractions: Sequence[float] = (0.5,), also: Sequence[Column] = ()) -> DataFrame:
    """``by``, the aggregates ``also``, and for column ``c`` and fraction number ``i`` the quantile ``c_q{i}``.

    Between two values a quantile is interpolated.  Nulls do not count; a group without values has a null.  ``df`` is
    read twice, so it should be a written table or cheap to make.
    """
    names = [(c, i, q, f"__{c}_{i}") for c in columns for i, q in enumerate(fractions)]
    extent = [e for c in columns for e in (F.count(c).alias(f"__n_{c}"), F.min(c).alias(f"__min_{c}"), F.max(c).alias(f"__max_{c}"))]
    first = df.groupBy(*by).agg(*also, *extent, *[s for c, _, q, name in names for s in _sketch(c, q, name)])
    for c, _, _, name in names:
        whole = F.col(f"__n_{c}") < SMALL
        first = first.withColumns({f"{name}_lo": F.when(whole, F.col(f"__min_{c}")).otherwise(F.get(f"{name}_near", F.lit(0))), f"{name}_hi": F.when(whole, F.col(f"__max_{c}")).otherwise(F.get(f"{name}_near", F.lit(1)))})
    bounds = first.select(*[F.col(b).alias(f"__by_{b}") for b in by], *[f"{name}_{end}" for *_, name in names for end in ("lo", "hi")])
    same = F.lit(True)
    for b in by:
        same = same & F.col(b).eqNullSafe(F.col(f"__by_{b}"))
    parts = []
    for c, _, _, name in names:
        x, lo, hi = F.col(c), F.col(f"{name}_lo"), F.col(f"{name}_hi")
        parts += [F.count_if(x <= lo).alias(f"{name}_low"), F.array_sort(F.collect_list(F.when((x > lo) & (x < hi), x))).alias(f"{name}_mid")]
    second = df.select(*by, *columns).join(bounds, same).groupBy(*[f"__by_{b}" for b in by]).agg(*parts)
    out = first.join(second, same)
    for c, i, q, name in names:

        def at(rank: Column, name: str = name) -> Column:
            """The value of a rank from 0, in order; ranks up to the lower bound's last are that bound."""
            low, mid = F.col(f"{name}_low"), F.col(f"{name}_mid")
            return F.when(rank < low, F.col(f"{name}_lo")).when(rank < low + F.size(mid), F.get(mid, (rank - low).cast("int"))).otherwise(F.col(f"{name}_hi"))

        place = (F.col(f"__n_{c}") - 1) * F.lit(q)
        rank = F.floor(place)
        share = place - rank
        value = F.when(share > 0, at(rank) * (1 - share) + at(rank + 1) * share).otherwise(at(rank))
        out = out.withColumn(f"{c}_q{i}", F.when(F.col(f"__n_{c}") > 0, value))
    return out.select(*[c for c in out.columns if not c.startswith("__")])
