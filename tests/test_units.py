"""Single operators on literal fixtures, and the decisions about doubtful cases."""

import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from quadrille.config import KELVIN, PROFILES, Settings
from quadrille.functions import pixels as P
from quadrille.functions import scene as S
from quadrille.functions import statistics as T
from quadrille.operators import climate as K
from quadrille.operators import coverage as V
from quadrille.operators import inventory as I
from quadrille.operators import projection as J
from quadrille.operators import quality as Q
from quadrille.operators import raster as X
from quadrille.operators import series as R
from quadrille.operators import spatial as Z
from quadrille.plans import catalogue
from quadrille.plans import proxies as D
from quadrille.sources import files, geotiff, metadata, sinks, vector

SET = Settings(year_start=2015, year_end=2016)


def one(spark, expr, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v))
    return df.select(expr.alias("r")).first().r


def test_settings():
    assert SET.qa_mask == 187
    with pytest.raises(ValueError, match="years?"):
        Settings(year_start=2020, year_end=2010)
    with pytest.raises(ValueError):
        Settings(lst_min=80.0)
    with pytest.warns(UserWarning, match="bit 6"):
        Settings(qa_bits=(0, 6))
    assert PROFILES["temperate"].hemisphere == "north"


def test_weighted_mean(spark):
    df = spark.createDataFrame([(10.0, 1), (20.0, 3), (None, 9), (5.0, 0)], "x double, w int")
    assert df.agg(T.weighted_mean(F.col("x"), F.col("w")).alias("m")).first().m == 17.5
    assert spark.createDataFrame([(1.0, 0), (2.0, 0)], "x double, w int").agg(T.weighted_mean(F.col("x"), F.col("w")).alias("m")).first().m is None


def test_pixel_composite_has_its_own_denominator(spark):
    rows = [(1, 0.6, 10), (1, 0.6, 10), (1, 0.6, 10), (2, 0.6, 10), (2, None, 10), (2, None, 10), (3, None, 10), (3, 0.6, 10), (4, None, 10)]
    out = R.pixel_composite(spark.createDataFrame(rows, "cell int, v double, w int"), ["cell"], "v", "w").collect()
    assert {r.cell: round(r.v, 9) for r in out} == {1: 0.6, 2: 0.6, 3: 0.6}


@pytest.mark.parametrize("scale,offset", [(0.00341802, 149.0), (0.0035, 150.0)])
def test_sentinel_inverts(spark, scale, offset):
    dn = one(spark, P.sentinel_dn(SET, F.lit(scale), F.lit(offset)))
    assert abs(dn * scale + offset - KELVIN - SET.lst_min) < 1e-6


def test_out_of_range_is_null_never_the_bound(spark):
    assert one(spark, P.reflectance(F.lit(0))) is None
    assert one(spark, P.reflectance(F.lit(65535))) is None
    assert one(spark, P.lst(F.lit(65535), SET)) is None
    assert one(spark, P.ndvi(F.lit(0.0), F.lit(0.0), SET)) is None
    assert one(spark, P.is_clear(F.lit(None).cast("int"), SET)) is None
    assert one(spark, P.is_clear(F.lit(64), SET)) is True
    assert all(one(spark, P.is_clear(F.lit(64 | 1 << b), SET)) is False for b in (0, 1, 3, 4, 5, 7))


def test_ids(spark):
    good = "LC08_L2SP_219076_20150205_20150824_02_T1"
    rows = [(good,), ("LC08_L2SP_219076_20151399_20150824_02_T1",), ("XX",), ("LE07_L2SP_1_20150902_2_02_T2",), ("LE07_L2SP_1_20090902_2_02_T1",), ("LE07_L2SP_1_20150902",)]
    out = I.audit(I.decode(spark.createDataFrame(rows, "scene_id string")), SET).collect()
    assert [r.outcome for r in out] == ["kept", "date", "name", "tier", "period", "tier"]
    assert (out[0].sensor, out[0].tag_thermal, out[0].year, out[0].month) == ("Landsat8", "ST_B10", 2015, 2)


def test_names(spark):
    assert one(spark, S.season(F.lit(1), SET)) == "Summer"
    assert one(spark, S.season(F.lit(1), SET.with_values(hemisphere="north"))) == "Winter"
    assert one(spark, S.season(F.lit(1), SET.with_values(hemisphere=None))) is None
    assert one(spark, S.generation(F.lit("Landsat7"))) == 7 and one(spark, S.generation(F.lit("x"))) == 99
    assert one(spark, S.period(F.lit(2015), F.lit(3))) == "2015-03"
    assert str(one(spark, S.mid_month(F.lit(2015), F.lit(3)))) == "2015-03-15"


def test_sensor_mix(spark):
    df = spark.createDataFrame([("Landsat8",), ("Landsat8",), ("Landsat7",)], "sensor string").withColumn("g", F.lit(1))
    assert R.sensor_mix(df, ["g"]).first().sensores_usados == "L7x1, L8x2"
    merged = spark.createDataFrame([(1, "L7x1, L8x2"), (1, "L8x1"), (1, "odd")], "g int, sensores_usados string")
    assert R.merge_mixes(merged, ["g"]).first().sensores_usados == "L7x1, L8x3"


def test_calendar_has_gaps_and_recomputes(spark):
    rows = [("a", "Landsat8", 2015, 5, 10.0, 10, 50.0), ("b", "Landsat7", 2015, 5, 20.0, 30, 10.0)]
    df = spark.createDataFrame(rows, "scene string, sensor string, ano int, mes int, lst_c_media double, lst_c_n long, cloud_cover double")
    for v in ("ndvi", "lst_c"):
        for x in ("media", "mediana", "min", "max", "dp"):
            df = df.withColumn(f"{v}_{x}", F.col("lst_c_media"))
    df = df.withColumn("ndvi_n", F.col("lst_c_n"))
    out = {(r.ano, r.mes): r for r in R.monthly(df, SET).collect()}
    assert len(out) == 24 and sum(r.lst_c_media is None for r in out.values()) == 23
    may = out[2015, 5]
    assert may.lst_c_media == 17.5 and may.lst_c_n == 40 and may.cloud_cover_med == 20.0 and may.sensores_usados == "L7x1, L8x1"
    assert str(may.data_ref) == "2015-05-15" and may.mes_nome == "May"


def test_cascade_boundaries(spark):
    base = dict(n_total_cena=100, n_clear=50, n_area=100, ndvi_n=50, lst_n=50, n_at_bound=0)
    cases = {
        "clear share at the limit passes": (dict(n_clear=10), None),
        "below it fails": (dict(n_clear=9), "scene valid fraction"),
        "area": (dict(ndvi_n=9, lst_n=9), "area valid fraction"),
        "ratio of five passes": (dict(ndvi_n=50, lst_n=10), None),
        "above five fails": (dict(ndvi_n=51, lst_n=10), "ndvi to lst ratio"),
        "no temperatures passes": (dict(lst_n=0), None),
        "saturated": (dict(lst_n=100, n_at_bound=2), "saturated thermal"),
        "one percent passes": (dict(lst_n=100, n_at_bound=1), None),
    }
    rows = [(k, *(base | v).values()) for k, (v, _) in cases.items()]
    out = Q.cascade(spark.createDataFrame(rows, "k string, " + ", ".join(f"{c} long" for c in base)), SET).collect()
    assert {r.k: r.reject for r in out} == {k: e for k, (_, e) in cases.items()}


def test_statistics_guards(spark):
    flat = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 4.0)], "a double, b double")
    r = flat.agg(T.pearson(F.col("a"), F.col("b")).alias("p"), T.major_axis_slope(F.col("a"), F.col("b")).alias("s"), T.slope(F.col("b"), F.col("a"), 2).alias("o")).first()
    assert (r.p, r.s, r.o) == (None, None, None)
    same = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (4.0, 4.0)], "a double, b double")
    r = same.agg(T.concordance(F.col("a"), F.col("b")).alias("c"), T.major_axis_slope(F.col("a"), F.col("b")).alias("s"), T.pearson(F.col("a"), F.col("b")).alias("p")).first()
    assert abs(r.c - 1) < 1e-12 and abs(r.s - 1) < 1e-12 and abs(r.p - 1) < 1e-12


def test_average_ranks(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 7.0), (1, 1.0)], "g int, v double")
    assert sorted(r.r for r in df.select(T.average_rank("v", ["g"]).alias("r")).collect()) == [1.0, 2.5, 2.5, 4.0]


def test_student():
    # Tabled quantiles of Student's distribution.
    assert abs(T.t_quantile(0.975, 9) - 2.262157) < 1e-5
    assert abs(T.t_quantile(0.975, 1) - 12.706205) < 1e-4
    assert abs(T.t_two_sided(2.262157, 9) - 0.05) < 1e-6


SQUARE = [[{"x": 0.0, "y": 0.0}, {"x": 4.0, "y": 0.0}, {"x": 4.0, "y": 4.0}, {"x": 0.0, "y": 4.0}], [{"x": 1.0, "y": 1.0}, {"x": 3.0, "y": 1.0}, {"x": 3.0, "y": 3.0}, {"x": 1.0, "y": 3.0}]]
TRIANGLE = [[{"x": 2.2, "y": 0.3}, {"x": 9.1, "y": 3.7}, {"x": 4.4, "y": 9.6}]]


def test_span_join_against_brute_force(spark):
    zones = spark.createDataFrame([(1, SQUARE), (2, TRIANGLE)], "zone_id int, rings array<array<struct<x: double, y: double>>>")
    grid = Z.Grid(0.0, 10.0, 1.0, 10, 10)
    got = {(r.zone_id, r.row, r.col) for r in Z.in_zones(X.cells(spark, grid), Z.spans(zones, grid)).collect()}

    def inside(x, y, rings):
        hit = False
        for ring in rings:
            for p, q in zip(ring, ring[1:] + ring[:1]):
                if (p["y"] > y) != (q["y"] > y) and x < p["x"] + (y - p["y"]) * (q["x"] - p["x"]) / (q["y"] - p["y"]):
                    hit = not hit
        return hit

    want = {(z, r, c) for z, g in ((1, SQUARE), (2, TRIANGLE)) for r in range(10) for c in range(10) if inside(c + 0.5, 9.5 - r, g)}
    assert got == want and sum(z == 1 for z, _, _ in got) == 12
    masked = Z.clip(X.cells(spark, grid), Z.spans(zones, grid)).count()
    assert masked == len({(r, c) for _, r, c in want})


def test_footprint(spark):
    """A hole is no area, and an overlap counts once."""
    schema = "zone_id int, rings array<array<struct<x: double, y: double>>>"
    boxes = spark.createDataFrame([(-1.0, -1.0, 9.0, 9.0), (2.0, 0.0, 9.0, 9.0), (1.0, 1.0, 3.0, 3.0), (5.0, 5.0, 6.0, 6.0)], "xmin double, ymin double, xmax double, ymax double")
    holed = spark.createDataFrame([(1, SQUARE), (2, [SQUARE[0]])], schema)
    assert [r.area for r in Z.areas(holed).orderBy("zone_id").collect()] == [12.0, 16.0]
    assert [r.overlap for r in Z.footprint_overlap(boxes, holed.where("zone_id = 1")).collect()] == [1.0, 0.5, 0.0, 0.0]
    assert [r.overlap for r in Z.footprint_overlap(boxes, holed).collect()] == [1.0, 0.5, 0.25, 0.0]
    rng = np.random.default_rng(0)
    polygons = [[rng.uniform(0, 10, (7, 2))] for _ in range(4)] + [[rng.uniform(0, 10, (5, 2)), rng.uniform(2, 8, (4, 2))]]
    p = rng.uniform(0, 10, (100_000, 2))

    def inside(rings):
        hit = np.zeros(len(p), bool)
        for ring in rings:
            for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True):
                hit ^= ((a[1] > p[:, 1]) != (b[1] > p[:, 1])) & (p[:, 0] < a[0] + (p[:, 1] - a[1]) * (b[0] - a[0]) / (b[1] - a[1]))
        return hit

    covered, box = np.any([inside(r) for r in polygons], axis=0), (2.3, 1.1, 6.7, 8.4)
    t = Z.trapezoids(polygons)
    within = (p[:, 0] > box[0]) & (p[:, 0] < box[2]) & (p[:, 1] > box[1]) & (p[:, 1] < box[3])
    assert abs(Z.area_within(t) - 100 * covered.mean()) < 0.5 and abs(Z.area_within(t, *box) - 100 * (covered & within).mean()) < 0.5


@pytest.mark.parametrize("slab", [1_500, 40])
def test_dissolve_in_slabs(spark, monkeypatch, slab):
    """Overlaps, holes, rings that cross themselves: the same union whatever the slabs, and no limit of corners."""
    monkeypatch.setattr(Z, "SLAB", slab)
    rng = np.random.default_rng(12)
    polygons = [[rng.uniform(0, 10, (12, 2))] for _ in range(6)] + [[np.array([(1, 1), (9, 1), (9, 9), (1, 9)], float), np.array([(2, 2), (8, 2), (8, 8), (2, 8)], float)]]
    df = spark.createDataFrame([(k, [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]) for k, rings in enumerate(polygons)], "zone_id int, rings array<array<struct<x: double, y: double>>>").repartition(3)
    want = Z.trapezoids(polygons)
    t = np.array([tuple(r[c] for c in ("y0", "y1", "left0", "left1", "right0", "right1")) for r in Z.dissolve(df).collect()])
    assert abs(Z.area_within(t) - Z.area_within(want)) < 1e-9
    boxes = spark.createDataFrame([(float(a), float(b), float(a + c), float(b + d)) for a, b, c, d in rng.uniform(0, 6, (20, 4))] + [(50.0, 50.0, 60.0, 60.0), (-1.0, -1.0, 20.0, 20.0)], "xmin double, ymin double, xmax double, ymax double")
    for r in Z.footprint_overlap(boxes, df).collect():
        assert abs(r.overlap - Z.area_within(want, r.xmin, r.ymin, r.xmax, r.ymax) / Z.area_within(want)) < 1e-9
    assert [r.overlap for r in Z.footprint_overlap(boxes.limit(1), df.where("false")).collect()] == [None] and Z.dissolve(df.where("false")).count() == 0


def test_dissolve_of_a_detailed_layer(spark):
    """A coast of 210,000 corners beside a square that overlaps it."""
    n = 210_000
    turn = np.linspace(0, 2 * np.pi, n, endpoint=False)
    radius = 100 + 5 * np.sin(40 * turn) + np.sin(977 * turn)
    x, y = radius * np.cos(turn), radius * np.sin(turn)
    ring = [{"x": float(a), "y": float(b)} for a, b in zip(x, y, strict=True)]
    square = [{"x": float(a), "y": float(b)} for a, b in ((-50, -50), (50, -50), (50, 50), (-50, 50))]
    df = spark.createDataFrame([(1, [ring]), (2, [square])], "zone_id int, rings array<array<struct<x: double, y: double>>>")
    t = Z.dissolve(df)
    area = t.agg(F.sum((F.col("y1") - F.col("y0")) * (F.col("right0") - F.col("left0") + F.col("right1") - F.col("left1")) / 2)).first()[0]
    shoelace = abs((x * np.roll(y, -1) - y * np.roll(x, -1)).sum()) / 2
    assert abs(area / shoelace - 1) < 1e-9


def test_touched_cells():
    """Against the intersection of each cell with a polygon cut into fine pieces; borders touch nothing."""
    rng = np.random.default_rng(9)
    grid = Z.Grid(0.0, 10.0, 1.0, 10, 12)

    def cells(rings, touched):
        got = [(r, c) for r, a, b in Z.ring_spans(rings, grid, touched) for c in range(a, b + 1)]
        assert len(got) == len(set(got))
        return set(got)

    square = [np.array([(2.0, 3.0), (5.0, 3.0), (5.0, 7.0), (2.0, 7.0)])]
    assert cells(square, True) == cells(square, False) == {(r, c) for r in range(3, 7) for c in range(2, 5)}
    thin = [np.array([(1.1, 1.2), (9.9, 8.7), (9.9, 8.75)])]
    assert not cells(thin, False) <= {(5, 5)} or len(cells(thin, True)) > len(cells(thin, False))
    for _ in range(30):
        ring = rng.uniform(-1, 11, (rng.integers(3, 7), 2))
        t = np.linspace(0, 1, 4001)[:, None]
        on = np.concatenate([a + t * (b - a) for a, b in zip(ring, np.roll(ring, -1, axis=0), strict=True)])
        passed = {(int(r), int(c)) for r, c in zip(np.floor(10 - on[:, 1]), np.floor(on[:, 0]), strict=True) if 0 <= r < 10 and 0 <= c < 12}
        got, centres = cells([ring], True), cells([ring], False)
        assert centres <= got and passed <= got and len(got - passed - centres) <= 3  # corners that the fine pieces step over


def test_inner_points():
    """Inside by the even-odd rule, whatever the shape."""
    rng = np.random.default_rng(10)

    def inside(x, y, rings):
        e = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
        e = e[(e[:, 1] > y) != (e[:, 3] > y)]
        return (e[:, 0] + (y - e[:, 1]) * (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]) > x).sum() % 2 == 1

    horseshoe = [np.array([(0, 0), (9, 0), (9, 9), (6, 9), (6, 2), (3, 2), (3, 9), (0, 9)], float)]
    holed = [np.array([(0, 0), (10, 0), (10, 10), (0, 10)], float), np.array([(1, 1), (9, 1), (9, 9), (1, 9)], float)]
    for rings in (horseshoe, holed, *[[rng.uniform(0, 5, (rng.integers(3, 9), 2))] for _ in range(200)]):
        assert inside(*Z.inner_point(rings), rings)
    assert Z.inner_point([]) is None and Z.inner_point([np.array([(0, 1), (5, 1), (9, 1)], float)]) is None


def test_density(spark):
    """Against the sum over all values, and it integrates to nearly one."""
    from quadrille.operators import figures as U

    rng = np.random.default_rng(11)
    data = {"a": rng.normal(0, 1, 3000), "b": rng.exponential(2, 500), "same": np.full(40, 1.5), "one": np.array([0.7])}
    df = spark.createDataFrame([("v", g, float(x)) for g, v in data.items() for x in v] + [("v", "a", None), ("w", "flat", 2.0)], "panel string, kind string, x double")
    got = {}
    for r in U.density(df, "x", ["kind"], ["panel"], 256).collect():
        got.setdefault(r.kind, []).append((r.i, r.x, r.density))
    low, high = min(map(np.min, data.values())), max(map(np.max, data.values()))
    for g, v in data.items():
        at = np.array(sorted(got[g]))
        assert len(at) == 256 and at[0, 1] == low and abs(at[-1, 1] - high) < 1e-12
        sd = np.std(v, ddof=1) if len(v) > 1 else None
        q = np.subtract(*np.quantile(v, [0.75, 0.25])) / 1.34
        width = 0.9 * (min(sd, q) if sd else 1.0 or 1.0) * len(v) ** -0.2 if sd and min(sd, q) else 0.9 * len(v) ** -0.2
        want = np.exp(-(((at[:, 1][:, None] - v) / width) ** 2) / 2).sum(axis=1) / (len(v) * width * math.sqrt(2 * math.pi))
        assert np.abs(at[:, 2] - want).max() < 0.02 * want.max()
    a = np.array(sorted(got["a"]))
    assert abs(np.trapezoid(a[:, 2], a[:, 1]) - 1) < 0.01 and len(got["flat"]) == 256


def test_equal_area(spark):
    """Areas of a degree cell agree between systems, and points come back."""
    df = spark.createDataFrame([(-55.0, -12.0, "ESRI:102033"), (-100.0, 40.0, "EPSG:5070"), (20.0, 47.0, "EPSG:3035")], "lon double, lat double, crs string")
    for r in df.collect():
        one = df.where(F.col("crs") == r.crs)
        lon, lat = X.to_lonlat(*X.from_lonlat(F.col("lon"), F.col("lat"), r.crs), r.crs)
        back = one.select(lon.alias("a"), lat.alias("b")).first()
        assert abs(back.a - r.lon) < 1e-7 and abs(back.b - r.lat) < 1e-7
        ring = F.array(*[F.struct(F.lit(r.lon + a).alias("x"), F.lit(r.lat + b).alias("y")) for a, b in ((0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01))])
        zone = one.select(F.lit(1).alias("zone_id"), F.array(ring).alias("rings"))
        area = Z.areas(Z.transform(zone, "EPSG:4326", r.crs)).first().area
        e2, phi = J.System("degrees").e2, math.radians(r.lat + 0.005)
        true = 6378137.0**2 * (1 - e2) * math.cos(phi) / (1 - e2 * math.sin(phi) ** 2) ** 2 * math.radians(0.01) ** 2
        assert abs(area / true - 1) < 1e-6
    # Snyder's worked example of the ellipsoidal Albers on another ellipsoid is matched by area; the origin is exact.
    x, y = X.from_lonlat(F.lit(10.0), F.lit(52.0), "EPSG:3035")
    at = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(at.x - 4321000) < 1e-6 and abs(at.y - 3210000) < 1e-6


CLARKE = 'GEOGCS["GCS",DATUM["D",SPHEROID["Clarke_1866",6378206.4,294.9786982]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'


def test_systems_from_text(spark):
    """Worked examples of a textbook on map projections, round trips to a millimetre, and the text of shapefiles."""
    par = lambda **k: "".join(f',PARAMETER["{n}",{v}]' for n, v in k.items())
    text = lambda projection, unit=("Meter", 1.0), **k: f'PROJCS["P",{CLARKE},PROJECTION["{projection}"]{par(**k)},UNIT["{unit[0]}",{unit[1]}]]'
    cone = {"False_Easting": 0.0, "False_Northing": 0.0, "Central_Meridian": -96.0, "Latitude_Of_Origin": 23.0}
    cases = [
        (text("Albers", Standard_Parallel_1=29.5, Standard_Parallel_2=45.5, **cone), -75.0, 35.0, 1885472.7, 1535925.0),
        (text("Lambert_Conformal_Conic", Standard_Parallel_1=33.0, Standard_Parallel_2=45.0, **cone), -75.0, 35.0, 1894410.9, 1564649.5),
        (text("Transverse_Mercator", Central_Meridian=-75.0, Scale_Factor=0.9996, Latitude_Of_Origin=0.0), -73.5, 40.5, 127106.5, 4484124.4),
        (text("Lambert_Azimuthal_Equal_Area", Central_Meridian=-100.0, Latitude_Of_Origin=40.0), -110.0, 30.0, -965932.1, -1056814.9),
        (text("Lambert_Conformal_Conic", ("Foot_US", 0.3048006096012192), Standard_Parallel_1=33.0, Standard_Parallel_2=45.0, **(cone | {"False_Easting": 1000.0})), -75.0, 35.0, 1894410.9 / 0.3048006096012192 + 1000, 1564649.5 / 0.3048006096012192),
    ]
    for crs, lon, lat, x, y in cases:
        one = spark.range(1).select(F.lit(lon).alias("lon"), F.lit(lat).alias("lat"))
        px, py = J.from_lonlat(F.col("lon"), F.col("lat"), crs)
        back = J.to_lonlat(F.col("x"), F.col("y"), crs)
        r = one.select(px.alias("x"), py.alias("y")).select("x", "y", back[0].alias("a"), back[1].alias("b")).first()
        assert abs(r.x - x) < 0.2 and abs(r.y - y) < 0.2 and abs(r.a - lon) < 1e-8 and abs(r.b - lat) < 1e-8, crs
    esri = 'PROJCS["SIRGAS_2000_UTM_Zone_23S",GEOGCS["GCS_SIRGAS_2000",DATUM["D_SIRGAS_2000",SPHEROID["GRS_1980",6378137.0,298.257222101]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]],PROJECTION["Transverse_Mercator"],PARAMETER["False_Easting",500000.0],PARAMETER["False_Northing",10000000.0],PARAMETER["Central_Meridian",-45.0],PARAMETER["Scale_Factor",0.9996],PARAMETER["Latitude_Of_Origin",0.0],UNIT["Meter",1.0]]'
    assert vector.text_crs(esri) == esri and vector.text_crs(esri[:-1] + ',AUTHORITY["EPSG","31983"]]') == "EPSG:31983" and vector.text_crs("PROJCS") is None
    a, b = (J.from_lonlat(F.lit(-46.3), F.lit(-23.9), c) for c in (esri, "EPSG:31983"))
    r = spark.range(1).select(a[0].alias("ax"), a[1].alias("ay"), b[0].alias("bx"), b[1].alias("by")).first()
    assert abs(r.ax - r.bx) < 1e-3 and abs(r.ay - r.by) < 1e-3
    for wrong in ("", "PROJCS[", 'GEOCCS["x"]', text("Mercator")):
        with pytest.raises((ValueError, IndexError)):
            J.from_text(wrong)
    # a system with an origin of its own, south of the equator
    odd = J.System("transverse", lat0=-30.0, lon0=20.0, scale=1.0, east=100.0, north=200.0)
    x, y = J._transverse(odd, F.lit(20.0), F.lit(-30.0))
    r = spark.range(1).select(x.alias("x"), y.alias("y")).first()
    assert abs(r.x) < 1e-6 and abs(r.y) < 1e-6


def test_reprojection_round_trip(spark):
    df = spark.createDataFrame([(-46.3, -23.9), (-43.2, -22.9), (-45.0, -0.5)], "lon double, lat double")
    x, y = X.from_lonlat(F.col("lon"), F.col("lat"), "EPSG:31983")
    lon, lat = X.to_lonlat(F.col("x"), F.col("y"), "EPSG:31983")
    out = df.withColumns({"x": x, "y": y}).withColumns({"a": lon, "b": lat}).collect()
    for r in out:
        assert abs(r.a - r.lon) < 1e-8 and abs(r.b - r.lat) < 1e-8  # a millimetre
    assert abs(out[2].x - 500000) < 1e-6  # the central meridian
    # A plane stays a plane when moved to the neighbouring zone and back.
    source, target = X.Grid(360000.0, 7350000.0, 30.0, 40, 40), X.Grid(360300.0, 7349700.0, 30.0, 10, 10)
    cells = X.cells(spark, source).select(F.lit(1).alias("scene"), "row", "col", (F.col("x") + 2 * F.col("y")).alias("value"))
    same = X.resample(cells, source, target).join(X.cells(spark, target), ["row", "col"]).select(F.max(F.abs(F.col("value") - F.col("x") - 2 * F.col("y"))).alias("e")).first().e
    assert same < 1e-6


def test_resample_skips_missing(spark):
    cells = spark.createDataFrame([(1, 0, 0, 1.0), (1, 0, 1, None), (1, 1, 0, 3.0), (1, 1, 1, 8.0)], "scene int, row int, col int, value double")
    out = X.resample(cells, X.Grid(0.0, 2.0, 1.0, 2, 2), X.Grid(0.0, 2.0, 2.0, 1, 1)).collect()
    assert [r.value for r in out] == [4.0]


def test_metadata(spark):
    """One source whole: what the text lacks is a constant, not the JSON's value."""
    text = "GROUP = LANDSAT_METADATA_FILE\n  GROUP = LEVEL1_RADIOMETRIC_RESCALING\n    REFLECTANCE_MULT_BAND_4 = 9.9999E-05\n  END_GROUP = LEVEL1_RADIOMETRIC_RESCALING\n  GROUP = LEVEL2_SURFACE_REFLECTANCE_PARAMETERS\n    REFLECTANCE_MULT_BAND_4 = 3e-05\n    REFLECTANCE_ADD_BAND_4 = junk\n  END_GROUP = LEVEL2_SURFACE_REFLECTANCE_PARAMETERS\nEND_GROUP = LANDSAT_METADATA_FILE\n"
    js = '{"LANDSAT_METADATA_FILE": {"LEVEL2_SURFACE_TEMPERATURE_PARAMETERS": {"TEMPERATURE_MULT_BAND_ST_B10": "0.0035"}}}'
    df = spark.createDataFrame([(1, text, js), (2, None, None), (3, None, js), (4, None, "{broken")], "i int, mtl_text string, mtl_json string")
    a, b, c, d = metadata.factors(df).orderBy("i").collect()
    assert (a.sr_scale, a.sr_offset, a.st_scale, a.sr_scale_differs, a.mtl_source) == (3e-05, -0.2, 0.00341802, True, "txt")
    assert (b.sr_scale, b.st_offset, b.mtl_ok, b.sr_scale_differs, b.mtl_source) == (2.75e-05, 149.0, False, False, None)
    assert (c.sr_scale, c.st_scale, c.mtl_source) == (2.75e-05, 0.0035, "json") and not d.mtl_ok


@pytest.mark.parametrize("dtype", ["uint16", "float32"])
@pytest.mark.parametrize("compress", [False, True])
def test_geotiff_round_trip(dtype, compress):
    band = (np.arange(150 * 130).reshape(150, 130) * 37 % 60000).astype(dtype)
    got, place = geotiff.decode(geotiff.encode(band, 360000.0, 7350000.0, 30.0, compress))
    assert (got == band).all() and place == (360000.0, 7350000.0, 30.0)
    noise = np.random.default_rng(0).integers(0, 256, 30000, dtype=np.uint8).tobytes()
    assert geotiff.lzw_decode(geotiff.lzw_encode(noise)) == noise


def test_scene_folder_to_pixels(spark, tmp_path):
    sid = "LE07_L2SP_219076_20150205_20150824_02_T1"
    folder = tmp_path / "scenes" / sid
    folder.mkdir(parents=True)
    for tag, k in (("QA_PIXEL", 64), ("SR_B3", 9000), ("SR_B4", 20000), ("ST_B6", 43000)):
        band = np.full((20, 10), k, np.uint16)
        (folder / f"{sid}_{tag}.TIF").write_bytes(geotiff.encode(band, 0.0, 600.0, 30.0))
    broken = tmp_path / "scenes" / sid.replace("LE07", "LC08")
    broken.mkdir()
    (broken / f"{broken.name}_QA_PIXEL.TIF").write_bytes(b"II*\0nothing")
    bands = files.bands(files.scene_files(spark, [str(tmp_path / "scenes")]))
    rows = {r.scene_id: r for r in bands.collect()}
    assert rows[sid].file_red.endswith("SR_B3.TIF") and rows[broken.name].file_red is None
    px = geotiff.read_bands(spark, str(tmp_path / "scenes" / "*" / "*.TIF"))
    assert px.where("error is not null").count() == 1
    out = geotiff.scene_pixels(bands, px)
    assert out.count() == 200 and tuple(out.select("qa", "dn_red", "dn_nir", "dn_st").distinct().first()) == (64, 9000, 20000, 43000)


def test_tiled_rasters(spark, tmp_path):
    """Files of many tiles, some without cells, whose heads tell place and system, whether by code or definition."""
    from quadrille.sources import tiles

    rng = np.random.default_rng(8)
    band = rng.normal(size=(70, 100)).astype(np.float32)
    band[rng.random(band.shape) < 0.3], band[16:48, 50:] = np.nan, np.nan
    grid = Z.Grid(500.0, 9000.0, 30.0, 70, 100)
    rows = [(k, int(r), int(c), float(band[r, c]) * (1 + (k == "b"))) for k in "ab" for r, c in zip(*np.nonzero(~np.isnan(band)), strict=True)]
    px = spark.createDataFrame([*rows, ("a", 70, 3, 1.0), ("a", -1, 0, 1.0)], "id string, row int, col int, v double").repartition(5)
    own = 'PROJCS["own",GEOGCS["g",DATUM["d",SPHEROID["s",6378137.0,298.25]],PRIMEM["Greenwich",0],UNIT["Degree",0.0174532925199433]],PROJECTION["Albers"],PARAMETER["Standard_Parallel_1",-5.0],UNIT["Metre",1.0]]'
    for n, crs in enumerate(("EPSG:31983", "EPSG:4326", own, None)):
        made = tiles.tiles(px, "id", "v", grid, 16)
        assert made.groupBy("id").count().where("count = 29").count() == 2 and made.agg(F.max(F.octet_length("body"))).first()[0] < 16 * 16 * 4 + 100
        assert tiles.write_files(tiles.parts(made, "id", grid, crs, 16), "id", f"{tmp_path}/{n}", "_v.tif") == 2
        assert sorted(p.name for p in (tmp_path / str(n)).iterdir()) == ["a_v.tif", "b_v.tif"]
        body = (tmp_path / str(n) / "b_v.tif").read_bytes()
        assert geotiff.place(body) == (70, 100, 500.0, 9000.0, 30.0, crs)
        assert np.array_equal(geotiff.decode(body)[0], band.astype(float) * 2, equal_nan=True)
        assert np.array_equal(geotiff.Band(lambda at, size, b=body: b[at : at + size]).window(10, 35, 40, 70), band[10:35, 40:70].astype(float) * 2, equal_nan=True)


def test_layers(spark, tmp_path):
    import sqlite3

    (tmp_path / "z.geojson").write_text('{"type": "FeatureCollection", "features": [{"properties": {"nome": "Centro"}, "geometry": {"type": "Polygon", "coordinates": [[[0,0],[4,0],[4,4],[0,4]]]}}, {"properties": {"nome": "Sul"}, "geometry": {"type": "MultiPolygon", "coordinates": [[[[9,9],[10,9],[10,10]]]]}}]}')
    rows = vector.read_geojson(spark, str(tmp_path / "z.geojson"), "nome").collect()
    assert [r.zone_name for r in rows] == ["Centro", "Sul"] and len(rows[0].rings[0]) == 4 and rows[1].rings[0][1].x == 10.0
    wkb = struct.pack("<BIII", 1, 3, 1, 4) + struct.pack("<8d", 0, 0, 4, 0, 4, 4, 0, 4)
    with sqlite3.connect(tmp_path / "z.gpkg") as db:
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text, srs_id int)")
        db.execute("insert into gpkg_geometry_columns values ('z', 'geom', 31983)")
        db.execute("create table z (NM text, geom blob)")
        db.execute("insert into z values ('Centro', ?)", (b"GP\0\1" + struct.pack("<i", 31983) + wkb,))
    got = vector.read_geopackage(spark, str(tmp_path / "z.gpkg"), "NM").first()
    assert got.zone_name == "Centro" and [(p.x, p.y) for p in got.rings[0]] == [(0, 0), (4, 0), (4, 4), (0, 4)]
    shape = struct.pack("<i4d2ii8d", 5, 0, 0, 4, 4, 1, 4, 0, 0, 0, 4, 0, 4, 4, 0, 4)
    (tmp_path / "z.shp").write_bytes(b"\0" * 100 + struct.pack(">2i", 1, len(shape) // 2) + shape)
    field = b"NM".ljust(11, b"\0") + b"C" + b"\0" * 4 + bytes([10]) + b"\0" * 15
    (tmp_path / "z.dbf").write_bytes(struct.pack("<4xIHH20x", 1, 65, 11) + field + b"\r" + b" Centro    ")
    (tmp_path / "z.prj").write_text("PROJCS")
    (tmp_path / "z.dbf").write_bytes((tmp_path / "z.dbf").read_bytes().replace(b"Centro    ", "São João".encode("latin-1").ljust(10)))
    assert vector.read_shapefile(spark, str(tmp_path / "z.shp"), "NM").first().zone_name == "São João"
    (tmp_path / "z.dbf").write_bytes((tmp_path / "z.dbf").read_bytes().replace("São João".encode("latin-1").ljust(10), b"\x8eD       "[:10].ljust(10)))
    (tmp_path / "z.cpg").write_text("OEM 850")
    assert vector.read_shapefile(spark, str(tmp_path / "z.shp"), "NM").first().zone_name == "ÄD"
    (tmp_path / "z.dbf").write_bytes((tmp_path / "z.dbf").read_bytes().replace(b"\x8eD       "[:10].ljust(10), b"Centro    "))
    got = vector.read_shapefile(spark, str(tmp_path / "z.shp"), "NM").first()
    assert got.zone_name == "Centro" and len(got.rings[0]) == 4
    assert Z.name_column(spark.createDataFrame([(1, "a")], "id int, bairro string")) == "bairro"


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("ano;mes;lst_c_media\n2015;1;20,5\n2015;2;NA\n")
    df = files.normalise(files.read_table(spark, str(tmp_path / "a.csv")))
    assert df.columns == ["year", "month", "lst_mean"] and [tuple(r) for r in df.collect()] == [(2015, 1, 20.5), (2015, 2, None)]
    heads = {"a.csv": ["ano", "mes", "lst_c_media"], "z/b.csv": ["ano", "mes", "zone_name", "lst_c_media"]}
    assert files.find_table(heads, [("year", "ano"), ("lst_c_media",)], forbid=["zone_name"]) == "a.csv"
    assert files.find_table(heads, [("ano",), ("zone_name",)]) == "z/b.csv" and files.find_table(heads, [("none",)]) is None
    sinks.write_csv(spark.createDataFrame([(1, 0.12345678, None)], "a int, b double, c string"), str(tmp_path / "out"))
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert text == "a,b,c\n1,0.123457,NA\n"
    assert "--" in sinks.latex(spark.createDataFrame([(1, None)], "a_b int, c string"), "cap", "tab")
    sinks.write_text(spark.createDataFrame([(1, 2.0)], "a int, b double"), str(tmp_path / "txt"), "Title")
    assert next((tmp_path / "txt").glob("*.txt")).read_text().startswith("Title\n=====")
    assert math.isclose(files.climate_table(spark.createDataFrame([("2015", "1", "20,5")], "y string, m string, temp_mean string")).first().temp, 20.5)


def test_climate_columns(spark):
    rows = spark.createDataFrame([("2015", "1", "12,5", "20,5", "30"), ("2015", "2", "x", None, "31,5")], "ano string, mes string, t_min string, t_media string, t_max string")
    got = [tuple(r) for r in files.climate_table(rows).collect()]
    assert got == [(2015, 1, 20.5, 12.5, 30.0), (2015, 2, None, None, 31.5)]
    only = files.climate_table(rows.select("ano", "mes", F.col("t_max").alias("max_temp"), F.col("t_min").alias("air_temp")))
    assert [tuple(r) for r in only.collect()] == [(2015, 1, 12.5, None, 30.0), (2015, 2, None, None, 31.5)]
    assert files.climate_table(rows, "t_max").first().temp == 30.0
    with pytest.raises(ValueError, match="no column"):
        files.climate_table(rows, minimum="tmin")
    with pytest.raises(ValueError, match="no temperature"):
        files.climate_table(rows.select("ano", "mes", "t_max"))


def test_results_are_found_below_roots(spark, tmp_path):
    for p in ("a/empty", "b/.hidden/tables", "b/run2/tabelas", "c/deep/er/still/tables", "d"):
        (tmp_path / p).mkdir(parents=True)
    (tmp_path / "d/x.csv").write_text("a\n1\n")
    find = lambda *roots: files.find_results(spark, [str(tmp_path / r) for r in roots])
    assert find("none", "a", "b").endswith("b/run2/tabelas") and find("c") is None and find("a") is None
    assert find("d").endswith("/d") and find("b", "d").endswith("/d")  # the nearest first


def test_tables_in_order_of_their_measure(spark):
    from quadrille.plans import validation

    df = spark.createDataFrame([(1, "a", 2.0), (2, "b", 3.0), (3, "c", None), (4, "d", 3.0)], "zone_id int, zone_name string, mean_rank double")
    assert [r.zone_id for r in df.orderBy(*validation.order_of("ranking/persistence", df)).collect()] == [2, 4, 1, 3]
    assert [r.zone_id for r in df.orderBy(*validation.order_of("other", df)).collect()] == [1, 2, 3, 4]


def test_stream(spark, tmp_path):
    from quadrille.streaming import arrivals

    schema = "acquired timestamp, zone_id int, ndvi double, lst_c double, n long"
    rows = spark.sql("select timestamp'2015-01-05 00:00:00' acquired, 1 zone_id, 0.2D ndvi, 10D lst_c, 1L n union all select timestamp'2015-01-21 00:00:00', 1, 0.6D, 20D, 3L")
    rows.write.parquet(str(tmp_path / "in"))
    stream = arrivals.monthly_stream(arrivals.pixel_stream(spark, str(tmp_path / "in"), schema))
    q = stream.writeStream.outputMode("complete").format("memory").queryName("months").start()
    q.processAllAvailable()
    q.stop()
    got = spark.sql("select * from months").collect()
    assert len(got) == 1 and got[0].lst_c == 17.5 and got[0].n == 4


def test_calendar_shows_gaps(spark):
    city = spark.createDataFrame([(2015, 1, 0.5, 20.0), (2015, 2, 0.5, None), (2015, 3, None, 20.0)], "ano int, mes int, ndvi_media double, lst_c_media double")
    got = {(r.ano, r.mes): r.symbol for r in V.calendar(city, SET).collect()}
    assert len(got) == 24
    assert [got[2015, m] for m in (1, 2, 3, 4)] == ["O", "n", "l", "."]


def test_coverage_takes_every_scene(spark, sf):
    """Months and scenes of the queries are those of the scene table, no sample of it."""
    seen = D.scene_stats(spark, sf).where("ndvi_media is not null or lst_c_media is not null")
    assert catalogue.QUERIES["coverage_overall"](spark, sf).first().n_any == seen.select("ano", "mes").distinct().count()
    shared = seen.groupBy("ano", "mes").count().where("count >= 2").agg(F.sum("count")).first()[0]
    assert catalogue.QUERIES["sensor_month_inventory"](spark, sf).agg(F.sum("n_scenes")).first()[0] == shared


def test_raster_takes_every_part(spark, tmp_path):
    rows = [(k, float(k), k % 50) for k in (0, 1, 9999, 10000, 10101, 20000, 123456)]
    spark.createDataFrame(rows, "p_partkey long, p_retailprice double, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = catalogue.QUERIES["raster_bilinear"](spark, str(tmp_path)).collect()
    assert {(r.scene, r.row, r.col): round(r.value, 3) for r in got} == {(0, 0, 0): 0.5, (0, 49, 49): 9999, (1, 0, 0): 10050.5, (2, 0, 0): 20000, (12, 17, 28): 123456}
    assert catalogue.QUERIES["raster_nearest"](spark, str(tmp_path)).count() == 4 * len(rows)


def test_station_takes_every_order(spark, tmp_path):
    """Of seven orders of a month all count; a month without orders matches none."""
    spark.createDataFrame([(k, 10 * k) for k in range(1, 8)], "o_orderkey long, o_custkey long").withColumn("o_orderdate", F.expr("date'2015-01-09'")).write.parquet(f"{tmp_path}/orders.parquet")
    station = D.station(spark, str(tmp_path))
    assert [tuple(r) for r in station.collect()] == [(2015, 1, 15 + 10 * 40 / 50)]
    months = spark.createDataFrame([(2015, 1, 30.0), (2015, 2, 30.0)], "ano int, mes int, lst_c_media double")
    pairs = K.matched(months, station, SET)
    assert [(r.mes, r.offset) for r in pairs.collect()] == [(1, 7.0)]
    with pytest.raises(ValueError, match="fewer than 10"):
        K.enough_months(pairs)


def test_every_zone_in_every_scene(spark):
    """A zone without pixels has a count of 0; the month counts all its scenes for every zone."""
    px = spark.createDataFrame([("a", 1, 0.5, 20.0), ("a", 1, 0.7, None), ("b", 2, 0.1, 30.0)], "scene string, zone_id int, ndvi double, lst_c double")
    px = px.withColumns({"sensor": F.when(F.col("scene") == "a", "Landsat7").otherwise("Landsat8"), "ano": F.lit(2015), "mes": F.lit(5)})
    zones = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "zone_id int, zone_name string")
    stats = R.scene_stats(px, ["scene", "zone_id", "sensor", "ano", "mes"])
    full = {(r.scene, r.zone_id): (r.ndvi_n, r.ndvi_media, r.ndvi_mediana, r.sensor) for r in R.complete_zones(stats, zones).collect()}
    assert len(full) == 6 and full["a", 1][0] == 2 and full["a", 3] == (0, None, None, "Landsat7") and full["b", 1] == (0, None, None, "Landsat8")
    assert abs(full["a", 1][2] - 0.6) < 1e-12
    for source in (stats, R.complete_zones(stats, zones)):
        may = {r.zone_id: r for r in R.monthly(source, SET, zones, ("zone_id",)).where("ano = 2015 and mes = 5").collect()}
        assert [(may[z].n_cenas, may[z].sensores_usados, may[z].ndvi_n, may[z].lst_c_n) for z in (1, 2, 3)] == [(2, "L7x1, L8x1", 2, 1), (2, "L7x1, L8x1", 1, 1), (2, "L7x1, L8x1", 0, 0)]


def test_quantiles(spark, monkeypatch):
    """Groups of every size, with ties, outliers and nulls, against sorted values."""
    from quadrille.operators import quantiles as Z

    rng = np.random.default_rng(4)
    groups = {"big": rng.normal(size=40_000), "ties": rng.integers(0, 3, 30_000).astype(float), "one value": np.full(25_000, 7.0), "far": np.r_[rng.normal(size=20_001), 1e300, -1e300], "two": np.array([1.0, 4.0]), "one": np.array([5.0]), "odd": rng.normal(size=9_999)}
    groups["cut"] = np.r_[np.zeros(15_000), rng.normal(size=2), np.ones(15_000)]
    rows = [(g, float(x)) for g, v in groups.items() for x in v] + [("none", None), ("two", None), (None, 3.0), (None, 8.0)]
    df = spark.createDataFrame(rows, "g string, x double").withColumn("y", -F.col("x")).repartition(5).persist()
    got = {r.g: r for r in Z.quantiles(df, ["g"], ["x", "y"], (0.5, 0.25, 0.95, 0.0, 1.0), [F.count("*").alias("n")]).collect()}
    assert len(got) == 10 and got["none"].x_q0 is None and got[None].x_q0 == 5.5 and got["two"].n == 3
    for g, v in groups.items():
        for c, values in (("x", v), ("y", -v)):
            for i, q in enumerate((0.5, 0.25, 0.95, 0.0, 1.0)):
                assert got[g][f"{c}_q{i}"] == pytest.approx(np.quantile(values, q), rel=1e-12, abs=1e-12), (g, c, q)
    mid = Z.quantiles(df.where("g = 'big'"), ["g"], ["x"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in mid
    px = spark.createDataFrame([(g, float(x), float(2 * x)) for g in ("big", "two", "far") for x in groups[g]], "scene string, ndvi double, lst_c double").withColumn("sensor", F.lit("s"))
    a, b = ({r.scene: r.asDict() for r in R.scene_stats(px, ["scene"], ["sensor"], most).collect()} for most in (50_000, None))
    assert a.keys() == b.keys() and all(a[k][c] == pytest.approx(b[k][c], rel=1e-12) if isinstance(a[k][c], float) else a[k][c] == b[k][c] for k in a for c in a[k])


def test_whole_run(spark, tmp_path):
    """Made scenes, from files to tables: the counts, files and recomputed values that a run must give."""
    import made_scenes as M

    from quadrille.plans import run, validation

    folder, layer = M.write(str(tmp_path))
    settings = Settings(year_start=2010, year_end=2011, crs=M.CRS, lst_min=-20.0, lst_max=70.0, pair_zones=3, top_n=1, hemisphere="north")
    out = str(tmp_path / "out")
    # one scene of the second tier is not listed; one is under cloud; one has a damaged band
    bad = next((tmp_path / "scenes").glob("LE07*20111111*"))
    red = next(bad.glob("*SR_B3.TIF"))
    red.write_bytes(red.read_bytes()[:2000])
    assert run.process(spark, [folder, str(tmp_path / "none")], layer, out, settings, pixel_tables=True) == {"listed": 10, "tried": 9, "used": 8}
    log = "\n".join(r.value for r in spark.read.text(f"{out}/run_log").collect())
    assert "10 scenes listed, 10 of them with all bands" in log and "ERROR" in log and "1 scenes cannot be read" in log and log.rstrip().endswith("done")
    with pytest.raises(ValueError, match="no scene passes"):
        run.process(spark, [folder], layer, str(tmp_path / "failed"), settings.with_values(year_start=1990, year_end=1991))
    assert "the run ends: no scene passes" in spark.read.text(str(tmp_path / "failed/run_log")).first().value
    faults = spark.read.parquet(f"{out}/faults").collect()
    assert [(r.scene_id, r.path.rsplit("/", 1)[-1], r.n_faults > 0, bool(r.error)) for r in faults] == [(bad.name, red.name, True, True)]
    read = lambda name: files.read_table(spark, f"{out}/tables/{name}")
    months, zones, scenes = read("monthly/ndvi_lst_monthly"), read("spatial/zones/ndvi_lst_per_zone_monthly"), read("scenes/ndvi_lst_per_scene")
    assert months.count() == 24 and months.where("ndvi_media is null").count() == 18 and zones.count() == 72
    assert read("scenes/scene_inventory").count() == 10
    assert len(list((tmp_path / "out/rasters/lst").iterdir())) == 8 and read("anomalies/summary_by_sensor").count() == 3
    # every scene from its arrays: with factors of its own where it states them, clear share of the whole scene
    rows = {r.scene_id: r for r in scenes.collect()}
    judged = {r.scene_id: r for r in spark.read.parquet(f"{out}/_work/judged").collect()}
    box = np.s_[20:50, 12:52]
    for k, args in enumerate(M.SCENES):
        name, made = M.scene(*args, k)
        if name not in judged:
            continue
        f = M.factors(args[4])
        qa, red, nir, dn = (geotiff.decode(made[f"{name}_{tag}.TIF"])[0].astype(float) for tag in ("QA_PIXEL", *(getattr(M.SENSORS[args[0]], b) for b in ("red", "nir", "thermal"))))
        clear = (qa.astype(int) & settings.qa_mask) == 0
        assert judged[name].pct_valido == round(100 * clear.mean(), 2) and judged[name].n_scene == 64 * 64 and judged[name].n_total_cena == 30 * 40
        assert (name in rows) == (judged[name].reject is None)
        if name not in rows:
            continue
        inside = np.zeros_like(clear)
        for a, b, c, d in M.ZONES.values():
            inside[a:c, b:d] = True
        red, nir = (np.where(clear & (v != 0), v * f["sr_scale"] + f["sr_offset"], np.nan) for v in (red, nir))
        red, nir = (np.where((v >= 0) & (v <= 1), v, np.nan) for v in (red, nir))
        ndvi, heat = (nir - red) / (nir + red), np.where(clear, dn * f["st_scale"] + f["st_offset"] - KELVIN, np.nan)
        for v, got in ((ndvi, rows[name].ndvi_media), (heat, rows[name].lst_c_media)):
            assert abs(np.nanmean(v[inside]) - got) < 1e-6
        body = (tmp_path / f"out/rasters/lst/{name}_LST_Celsius.tif").read_bytes()
        assert geotiff.place(body)[5] == M.CRS
        band, place = geotiff.decode(body)
        assert place == (M.LEFT + 12 * 30, M.TOP - 20 * 30, 30.0) and np.allclose(band, np.where(inside, heat, np.nan)[box], atol=1e-4, equal_nan=True)
    assert sum(a[4] for a in M.SCENES) == 2 and any(r.pct_valido < 100 for r in judged.values())
    may = zones.where("ano = 2010 and mes = 7 and zone_name = 'East'").first()
    assert may.n_cenas == 2 and may.sensores_usados == "L7x2" and 0 < may.lst_c_n < 2 * 30 * 22
    assert (tmp_path / "out/tables/spatial/pixels/lst_c_annual").exists()

    climate = spark.createDataFrame([(y, m, 20.0 + 5 * math.cos(m - 2)) for y in (2010, 2011) for m in range(1, 13)], "ano int, mes int, temp double")
    with pytest.raises(ValueError, match="fewer than 10"):
        validation.tables(spark, f"{out}/tables", settings, climate)
    per_zone = spark.read.parquet(f"{out}/_work/zone_scene_stats").withColumnsRenamed({"scene_id": "scene", "data_aq": "acq_date"})
    made = validation.write(spark, f"{out}/tables", str(tmp_path / "v"), settings, zone_scenes=per_zone)
    assert len(made) == 21 and files.read_table(spark, str(tmp_path / "v/coverage/by_month")).count() == 24
    assert files.read_table(spark, str(tmp_path / "v/ranking/persistence")).where("mean_rank is not null").count() == 3
    assert (tmp_path / "v/sensors/latex_all").exists()


def test_windows_read_the_area_only(spark, tmp_path):
    """Bytes read and cells sent on grow with the area; whatever the layout, cells are those of the whole file."""
    from quadrille.sources import windows

    rng = np.random.default_rng(3)
    whole = rng.integers(1, 60000, (900, 700)).astype(np.uint16)
    path = tmp_path / "b.tif"
    path.write_bytes(geotiff.encode(whole, 100.0, 90_000.0, 30.0, epsg=32633))
    taken = []
    for rows in (10, 200, 900):
        ranges = windows.Ranges(f"file://{path}")
        band = geotiff.Band(ranges)
        assert (band.window(300, min(900, 300 + rows), 50, 80) == whole[300 : 300 + rows, 50:80]).all()
        taken.append(ranges.taken)
    assert taken[0] < 0.25 * path.stat().st_size and taken[0] < taken[1] < taken[2]
    beyond = band.window(-2, 3, 698, 702)
    assert np.isnan(beyond[:2]).all() and np.isnan(beyond[:, 2:]).all() and (beyond[2:, :2] == whole[:3, 698:]).all()

    scenes = []
    for k, cut in enumerate((0, 3)):  # bands of other extents on the same lattice
        paths = {}
        for file, step in (("file_qa", 0), ("file_red", cut), ("file_nir", 0), ("file_lst", 0)):
            paths[file] = f"file:{tmp_path}/{k}{file}.tif"
            (tmp_path / f"{k}{file}.tif").write_bytes(geotiff.encode(whole[step:], 100.0, 90_000.0 - 30 * step, 30.0))
        scenes.append((f"s{k}", *paths.values(), 900, 700, 100.0, 90_000.0, 30.0, 290, 310, 10, 25))
    scenes.append(("bad", *[str(tmp_path / "none.tif")] * 4, 900, 700, 100.0, 90_000.0, 30.0, 290, 310, 10, 25))
    df = spark.createDataFrame(scenes, "scene_id string, file_qa string, file_red string, file_nir string, file_lst string, rows int, cols int, left double, top double, size double, row_from int, row_to int, col_from int, col_to int")
    got = windows.scene_cells(df).collect()
    cells = [r for r in got if r.error is None]
    assert len(cells) == 2 * 20 * 15 and {r.scene_id for r in got if r.error} == {"bad"}
    assert all(r.qa == r.dn_red == r.dn_nir == r.dn_st == whole[r.row, r.col] and r.x == 100 + 30 * (r.col + 0.5) for r in cells)
    counts = {r.scene_id: (r.n_scene, r.n_clear) for r in windows.clear_counts(df, 187).collect()}
    assert counts["s0"] == (900 * 700, int(((whole & 187) == 0).sum())) and counts["bad"] == (None, None)


def test_layouts_of_bands():
    """Tiles, predictors for whole numbers and for fractions, deflate, and big files."""
    import zlib

    def tiff(band, predictor=1, tile=None, big=False, compress=zlib.compress, code=8):
        h, w = band.shape
        th, tw = tile or (h, w)
        blocks = []
        for r in range(0, h, th):
            for c in range(0, w, tw):
                b = np.zeros((th, tw), band.dtype)
                part = band[r : r + th, c : c + tw]
                b[: part.shape[0], : part.shape[1]] = part
                if predictor == 2:
                    b = np.diff(b, axis=1, prepend=b.dtype.type(0))
                raw = b.tobytes()
                if predictor == 3:
                    planes = b.astype(b.dtype.newbyteorder(">")).view(np.uint8).reshape(th, tw, -1).transpose(0, 2, 1).reshape(th, -1)
                    raw = np.diff(planes, axis=1, prepend=np.uint8(0)).tobytes()
                blocks.append(compress(raw))
        word, start = ("Q", 16) if big else ("I", 8)
        offsets = [start + sum(map(len, blocks[:i])) for i in range(len(blocks))]
        fields = [(256, "I", [w]), (257, "I", [h]), (258, "H", [band.dtype.itemsize * 8]), (259, "H", [code]), (277, "H", [1]), (317, "H", [predictor]), (339, "H", [{"u": 1, "f": 3}[band.dtype.kind]])]
        fields += [(322, "I", [tw]), (323, "I", [th]), (324, word, offsets), (325, "I", [len(b) for b in blocks])] if tile else [(273, word, offsets), (278, "I", [h]), (279, "I", [len(b) for b in blocks])]
        at = start + sum(map(len, blocks))
        entry, inline = (20, 8) if big else (12, 4)
        tail_at = at + (8 if big else 2) + entry * len(fields) + (8 if big else 4)
        table, tail = b"", b""
        for tag, kind, values in sorted(fields):
            body = struct.pack(f"<{len(values)}{kind}", *values)
            table += struct.pack(f"<HH{word}", tag, {"H": 3, "I": 4, "Q": 16}[kind], len(values))
            if len(body) <= inline:
                table += body.ljust(inline, b"\0")
            else:
                table += struct.pack(f"<{word}", tail_at + len(tail))
                tail += body
        head = struct.pack("<2sHHHQ", b"II", 43, 8, 0, at) if big else struct.pack("<2sHI", b"II", 42, at)
        return head + b"".join(blocks) + struct.pack("<Q" if big else "<H", len(fields)) + table + bytes(8 if big else 4) + tail

    rng = np.random.default_rng(5)
    whole, parts = rng.integers(0, 5000, (70, 90)).astype("<u2"), rng.normal(size=(70, 90)).astype("<f4")
    for big in (False, True):
        for tile in (None, (32, 48)):
            for band, predictor in ((whole, 1), (whole, 2), (parts, 1), (parts, 3)):
                got, _ = geotiff.decode(tiff(band, predictor, tile, big))
                assert (got == band).all()
            assert (geotiff.decode(tiff(whole, 2, tile, big, geotiff.lzw_encode, 5))[0] == whole).all()


def test_tables_by_content(spark, tmp_path):
    (tmp_path / "tables").mkdir()
    (tmp_path / "tables/city_monthly.csv").write_text("ano,mes,lst_c_media,ndvi_media\n2015,1,20.5,0.3\n")
    (tmp_path / "tables/per_zone.csv").write_text("ano;mes;nome_bairro;lst_media;ndvi_media\n2015;1;Sul;20,5;0,3\n2015;1;Centro;21,5;0,4\n")
    assert files.load_city(spark, str(tmp_path)).columns == ["year", "month", "lst_mean", "ndvi_mean"]
    got = {r.zone_name: (r.zone_id, r.lst_mean) for r in files.load_zones(spark, str(tmp_path)).collect()}
    assert got == {"Centro": (1, 21.5), "Sul": (2, 20.5)}
    assert files.raster_suffix("LC08_x_y_NDVI.tif", ["LC08_x", "LC08_x_y"]) == "_NDVI.tif" and files.raster_suffix("q.tif", ["LC08"]) is None
    with pytest.raises(ValueError):
        files.scene_files(spark, [str(tmp_path / "none")])
    with pytest.raises(ValueError, match="coordinate system"):
        (tmp_path / "z.prj").write_text("PROJCS")
        vector.layer_crs(spark, str(tmp_path / "z.shp"))


def test_geotiff_layouts():
    """No-data becomes NaN; layouts that are not supported are an error."""
    body = bytearray(geotiff.encode(np.arange(12, dtype=np.uint16).reshape(3, 4), 0.0, 9.0, 3.0, compress=False, epsg=31983))
    assert geotiff.place(bytes(body)) == (3, 4, 0.0, 9.0, 3.0, "EPSG:31983")
    at = body.index(struct.pack("<HHIHH", geotiff.SAMPLES, 3, 1, 1, 0))
    two = bytes(body[:at]) + struct.pack("<HHIHH", geotiff.SAMPLES, 3, 1, 2, 0) + bytes(body[at + 12 :])
    with pytest.raises(ValueError, match="2 samples"):
        geotiff.decode(two)
    none = bytes(body[:at]) + struct.pack("<HHI4s", geotiff.NODATA, 2, 2, b"5\0") + bytes(body[at + 12 :])
    band, _ = geotiff.decode(none)
    assert np.isnan(band[1, 1]) and np.isnan(band).sum() == 1


@pytest.mark.parametrize("sep,point", [(",", "."), (";", ",")])
def test_types_are_judged_by_all_rows(spark, tmp_path, sep, point):
    last = sep.join(["1", f"25{point}3", "later", f"2{point}5e1", "", "3f"])
    (tmp_path / "t.csv").write_text("\n".join([sep.join("abcdef"), *[sep.join(["7", "1", "2", "NA", "", "4"])] * 1500, last]))
    df = files.read_table(spark, str(tmp_path / "t.csv"))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "double", "string", "string"]
    assert tuple(df.where("c = 'later'").first()) == (1, 25.3, "later", 25.0, None, "3f")
    assert df.where("b = 1 and c = '2' and d is null").count() == 1500


@pytest.mark.parametrize("block", [4_000, 7])
def test_pairs_without_listing(spark, monkeypatch, block):
    """Sums, gaps and the quantile of all pairs, against a list of them: ties, one scene, one instrument, blocks."""
    from quadrille.operators import agreement as G
    from quadrille.operators import pairwise as W

    monkeypatch.setattr(W, "BLOCK", block)
    monkeypatch.setattr(W, "FEW", 20)
    rng = np.random.default_rng(6)
    rows = []
    for month, zone, n in ((1, 1, 60), (1, 2, 1), (2, 1, 2), (3, 3, 25), (4, 1, 30)):
        for k in range(n):
            value = float(rng.integers(0, 3)) if month == 3 else float(rng.normal(20, 5))
            rows.append((f"s{month}{zone}{k:03d}", "L8" if month == 4 else str(rng.choice(["L5", "L7", "L8"])), f"2010-{month:02d}-{rng.integers(1, 29):02d}", 2010, month, zone, "lst_c", value, value - 20 + float(rng.normal())))
    rows += [("a", "L5", "2010-01-01", 2010, 1, 1, "ndvi", 0.5, 0.5), ("b", "L5", "2010-01-01", 2010, 1, 1, "ndvi", 0.5, 0.1)]
    long = spark.createDataFrame(rows, "scene string, sensor string, acq_date string, ano int, mes int, zone_id int, variable string, value double, anomaly double").withColumn("acq_date", F.to_date("acq_date"))
    want = {(r.variable, r.comparison): r.asDict() for r in G.pair_summary(G.scene_pairs(long), ["variable", "comparison"]).drop("mad_pct").collect()}
    got = {(r.variable, r.comparison): r.asDict() for r in W.summary(long).collect()}
    assert got.keys() == want.keys() and len(got) == 3
    for k in want:
        for c, v in want[k].items():
            assert got[k][c] == pytest.approx(v, rel=1e-9, abs=1e-12) if isinstance(v, float) else got[k][c] == v, (k, c)
    assert W.summary(long.where("false")).count() == 0


def test_counts_of_differences():
    """Below every threshold as many differences as a list has, to the last bit."""
    from quadrille.operators import pairwise as W

    rng = np.random.default_rng(7)
    for a, b in ((rng.normal(size=40), rng.normal(size=30)), (rng.integers(0, 4, 50) / 10, rng.integers(0, 4, 20) / 10), (np.array([0.1, 0.2, 0.3]), np.array([0.3, 0.7]))):
        d = np.sort(np.abs(a[:, None] - b[None]).ravel())
        limits = np.concatenate([[-1.0, 0.0], d[::3], [d.max()]])
        assert (W.counted(a, b, False, limits) == [(d <= t).sum() for t in limits]).all()
        i, j = np.triu_indices(len(a), 1)
        own = np.abs(a[i] - a[j])
        assert (W.counted(a, a, True, limits) == [(own <= t).sum() for t in limits]).all()
        low, high = np.quantile(d, [0.3, 0.6])
        found = W.between(a, b, False, low, high)
        assert sum(found.values()) == ((d > low) & (d <= high)).sum() and set(found) <= set(d)


def test_pairs_of_blocks_are_shuffled_once(spark):
    """Rows are dealt by group and repeated where they lie; the rounds read written values and shuffle counts only."""
    from quadrille.operators import pairwise as W

    long = spark.createDataFrame([("a", "L5", 2010, 1, 1, "ndvi", 0.5, 0.5)], "scene string, sensor string, ano int, mes int, zone_id int, variable string, value double, anomaly double").withColumn("acq_date", F.to_date(F.lit("2010-01-01")))
    schema = "variable string"
    rows = W.block_pairs(long).groupBy(*W.TASK).applyInPandas(lambda f: f[["variable"]], schema)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 1
