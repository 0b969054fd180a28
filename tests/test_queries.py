"""Every query of the catalogue against its SQL on another engine."""

import math

import pytest

from quadrille.plans import catalogue

from conftest import close_rows, same_rows


@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, sf, duck, name):
    df = catalogue.QUERIES[name](spark, sf)
    close_rows(df.collect(), df.columns, duck.execute(catalogue.ORACLES[name]))


@pytest.mark.parametrize("name", ["scene_stats", "calibrate_reflectance", "pair_summary"])
def test_compared(spark, sf, duck, name):
    """Brought to six digits, rows are equal."""
    df = catalogue.compared(name)(spark, sf)
    same_rows(df.collect(), df.columns, duck.execute(catalogue.compared_sql(name)))


def test_intervals(spark, sf):
    """Against the finite series of Student's distribution for whole degrees of freedom."""
    rows = catalogue.QUERIES["directional_bias_intervals"](spark, sf).collect()

    def two_sided(t, n):
        a = math.atan(abs(t) / math.sqrt(n))
        if n == 1:
            return 1 - 2 * a / math.pi
        term, total = (1.0, 1.0) if n % 2 == 0 else (math.cos(a), math.cos(a))
        for k in range(2 if n % 2 == 0 else 3, n - 1, 2):
            term *= (k - 1) / k * math.cos(a) ** 2
            total += term
        inside = math.sin(a) * total
        return 1 - (inside if n % 2 == 0 else 2 / math.pi * (a + inside))

    judged = [r for r in rows if r.p_value is not None]
    assert judged
    for r in judged:
        assert abs(r.p_value - two_sided(r.t, r.n_pairs - 1)) < 1e-9
        assert abs(two_sided((r.ci_high - r.bias) / r.se, r.n_pairs - 1) - 0.05) < 1e-9 and abs(r.bias - r.ci_low - (r.ci_high - r.bias)) < 1e-9


@pytest.mark.parametrize("name", ["zone_monthly", "zone_annual", "pair_summary", "pixel_composite_monthly", "zone_extremes_topk", "zone_persistence"])
def test_pixels_are_read_once(spark, sf, name):
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_orderkey#") and sum("Relation" in line and "l_orderkey#" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("name", ["sensor_validation", "sensor_interpretation"])
def test_zone_table_is_made_once(spark, sf, name):
    """What they share is written beforehand: their own plans never touch pixels."""
    plan = catalogue.QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert "l_orderkey" not in plan and "l_partkey" not in plan


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 2100
    assert set(e.oracle_sql()) <= set(e.queries())


def test_plans_are_native(spark, sf):
    """No Python and no nested loop over pixels in the flagship's plan; only needed columns are read."""
    df = catalogue.QUERIES["zone_monthly"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert "l_extendedprice" not in plan


def test_tasks_grow_with_the_pixels(spark, sf, monkeypatch):
    """A table of more pixels than the session's partitions are to hold is dealt over more, once and for all steps by scene."""
    want = catalogue.QUERIES["zone_monthly"](spark, sf).collect()
    monkeypatch.setattr(catalogue.D, "PIXELS", 500)
    df = catalogue.QUERIES["zone_monthly"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    parts = math.ceil(spark.read.parquet(f"{sf}/lineitem.parquet").count() / 500)
    assert parts > 4 and f", {parts}), REPARTITION_BY_NUM" in plan
    got = df.collect()
    assert len(got) == len(want) and all(a[:2] == b[:2] and a.ndvi_n == b.ndvi_n and a.n_cenas == b.n_cenas for a, b in zip(sorted(got, key=lambda r: (r.zone_id, r.ano, r.mes)), sorted(want, key=lambda r: (r.zone_id, r.ano, r.mes)), strict=True))
