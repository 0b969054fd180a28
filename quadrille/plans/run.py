"""A whole run: scene folders and a polygon layer in, tables and reports out.

Of a scene only the strips or tiles that the area touches are read, and its quality band whole for the share of clear
cells; the calibrated pixels of the area's box are written as a table, by scene, and everything else reads that table.
Scenes with a file that cannot be read are left out and named in the table ``faults``.  Every table below ``out`` is written by Spark; only settings, paths and reports of bounded size are
on the driver.
"""

from __future__ import annotations

import contextlib
import datetime
import logging
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import scene as S
from ..operators import inventory as I
from ..operators import quality as Q
from ..operators import raster as X
from ..operators import series as R
from ..operators import spatial as P
from ..sources import files, metadata, sinks, tiles, vector, windows

LOG = logging.getLogger("quadrille")
SCENE = ("scene_id", "sensor", "data_aq", "ano", "mes", "pathrow", "tier", "cloud_cover", "sun_elevation", "pct_valido")


def kept(df: DataFrame, path: str) -> DataFrame:
    """``df`` written as a table and read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def inventory(spark: SparkSession, folders: list[str], settings: Settings) -> DataFrame:
    """Scenes that pass the filters of names, with their files and metadata; empty folders are an error."""
    bands = I.inventory(files.bands(files.scene_files(spark, folders)), settings)
    there = [f for f in folders if files.exists(spark, f)]
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_[mM][tT][lL].*")
    texts = reader.load(there).select("path", F.decode("content", "UTF-8").alias("body"))
    for column, file in (("mtl_text", "file_mtl_txt"), ("mtl_json", "file_mtl_json")):
        bands = bands.join(texts.withColumnsRenamed({"path": file, "body": column}), file, "left")
    out = metadata.factors(bands).drop("mtl_text", "mtl_json")
    return out.withColumn("complete", I.is_complete("file_qa", "file_red", "file_nir", "file_lst"))


def area_grid(zones: DataFrame, size: float, left: float, top: float) -> P.Grid:
    """The cells around the zones, on the lattice of a raster."""
    p = zones.select(F.explode(F.flatten("rings")).alias("p")).agg(F.min("p.x"), F.min("p.y"), F.max("p.x"), F.max("p.y")).first()
    col, row = int((p[0] - left) // size), int((top - p[3]) // size)
    return P.Grid(left + col * size, top - row * size, size, int(-((p[1] - top) // size)) - row, int(-((left - p[2]) // size)) - col)


def _on_grid(cells: DataFrame, grid: P.Grid) -> DataFrame:
    """Rows and columns of the area's grid."""
    row, col = F.round((grid.y0 - F.col("y")) / grid.size - 0.5).cast("int"), F.round((F.col("x") - grid.x0) / grid.size - 0.5).cast("int")
    return cells.withColumns({"row": row, "col": col})


def _box_in(grid: P.Grid, crs: str, target: str, spark: SparkSession) -> tuple[float, float, float, float]:
    """``xmin, ymin, xmax, ymax`` of a grid in another system, from points along its border."""
    right, bottom = grid.x0 + grid.cols * grid.size, grid.y0 - grid.rows * grid.size
    steps = [k / 32 for k in range(33)]
    border = [(grid.x0 + t * (right - grid.x0), y) for t in steps for y in (grid.y0, bottom)] + [(x, bottom + t * (grid.y0 - bottom)) for t in steps for x in (grid.x0, right)]
    x, y = X.project(F.col("x"), F.col("y"), crs, target)
    return tuple(spark.createDataFrame(border, "x double, y double").select(x.alias("x"), y.alias("y")).agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first())


def _asked(scenes: DataFrame, box: tuple[float, float, float, float], margin: int) -> DataFrame:
    """The rows and columns of each scene that a box touches, and ``margin`` cells around them."""
    inside = lambda v, most: F.least(F.greatest(v, F.lit(0)), F.col(most)).cast("int")
    down, across = (lambda y: (F.col("top") - y) / F.col("size")), (lambda x: (x - F.col("left")) / F.col("size"))
    near = 1e-6  # a border of the box that is one of cells' touches no further cell
    return scenes.withColumns(
        {
            "row_from": inside(F.floor(down(F.lit(box[3])) + near) - margin, "rows"),
            "row_to": inside(F.ceil(down(F.lit(box[1])) - near) + margin, "rows"),
            "col_from": inside(F.floor(across(F.lit(box[0])) + near) - margin, "cols"),
            "col_to": inside(F.ceil(across(F.lit(box[2])) - near) + margin, "cols"),
        }
    )


FACTORS = ("sr_scale", "sr_offset", "st_scale", "st_offset")
PRODUCTS = ("scene_id", "row", "col", "x", "y", "qa", "dn_st", "clear", "ndvi_raw", "ndvi", "below_sentinel", "lst_raw", "lst_c")


def products(cells: DataFrame, scenes: DataFrame, settings: Settings) -> DataFrame:
    """Products of cells by the factors of their own scene."""
    own = cells.drop("path", "error").join(F.broadcast(scenes.select("scene_id", *FACTORS)), "scene_id")  # a row a scene that is read
    return Q.with_products(own, settings, {c: F.col(c) for c in FACTORS}).select(*PRODUCTS)


def calibrated(spark: SparkSession, scenes: DataFrame, settings: Settings, grid: P.Grid, crs: str, work: str) -> tuple[DataFrame, DataFrame]:
    """Products of the cells in the area's box, on its grid, and the faults of what could not be read."""
    same = crs == settings.crs
    box = (grid.x0, grid.y0 - grid.rows * grid.size, grid.x0 + grid.cols * grid.size, grid.y0) if same else _box_in(grid, settings.crs, crs, spark)
    cells = kept(windows.scene_cells(_asked(scenes, box, 0 if same else 2)), f"{work}/cells")
    faults = cells.where("error is not null").select("scene_id", "path", "error")
    made = products(cells.where("error is null"), scenes, settings)
    if same:
        return _on_grid(made, grid), faults
    # another system: values are resampled on the area's grid; bits are not, so a cell is clear where it has a value
    parts = []
    size, left, top = scenes.select("size", "left", "top").first()
    offset = F.round((top - F.col("y")) / size - 0.5).cast("int"), F.round((F.col("x") - left) / size - 0.5).cast("int")  # one lattice for all
    for v in ("ndvi", "lst_c"):
        source = made.select("scene_id", offset[0].alias("row"), offset[1].alias("col"), F.col(v).alias("value"))
        moved = X.reproject(source, P.Grid(left, top, size, 1, 1), crs, grid, settings.crs)
        parts.append(moved.withColumnRenamed("value", v))
    both = parts[0].join(parts[1], ["scene_id", "row", "col"], "full").join(X.cells(spark, grid), ["row", "col"])
    flags = {"qa": F.lit(None).cast("int"), "dn_st": F.lit(None).cast("int"), "clear": F.lit(True), "ndvi_raw": F.col("ndvi"), "below_sentinel": F.lit(False), "lst_raw": F.col("lst_c")}
    return both.withColumns(flags).select(*PRODUCTS), faults


@contextlib.contextmanager
def journal(spark: SparkSession, path: str) -> Iterator[None]:
    """Whatever is logged meanwhile, with its time and level, is written as text at the end, also of a run that fails."""
    lines: list[str] = []

    class Keep(logging.Handler):
        def emit(self, record: logging.LogRecord) -> None:
            lines.append(f"{datetime.datetime.fromtimestamp(record.created):%Y-%m-%d %H:%M:%S} {record.levelname:<7} {record.getMessage()}")

    keep, was = Keep(), LOG.level
    LOG.addHandler(keep)
    LOG.setLevel(logging.INFO)
    try:
        yield
    except Exception as e:
        LOG.error("the run ends: %s", " ".join(str(e).split())[:500])
        raise
    finally:
        LOG.removeHandler(keep)
        LOG.setLevel(was)
        sinks.write_lines(spark, lines, path)


def process(spark: SparkSession, folders: list[str], area: str, out: str, settings: Settings, area_name: str = "area", zone_label: str = "zone", rasters: bool = True, pixel_tables: bool = False) -> dict[str, int]:
    """Run all stages and write the result folder; returns how many scenes were listed, tried and used.

    What happened, stage by stage, is in the text ``run_log``.
    """
    with journal(spark, f"{out}/run_log"):
        return _process(spark, folders, area, out, settings, area_name, zone_label, rasters, pixel_tables)


def _process(spark: SparkSession, folders: list[str], area: str, out: str, settings: Settings, area_name: str, zone_label: str, rasters: bool, pixel_tables: bool) -> dict[str, int]:
    """Scenes of one lattice (system, cell size and origin) are processed together."""
    work = f"{out}/_work"
    listed = kept(inventory(spark, folders, settings), f"{work}/inventory")
    if listed.isEmpty():
        raise ValueError("no scene passes the filters of period, months and tier")
    LOG.info("%d scenes listed, %d of them with all bands", *listed.agg(F.count("*"), F.count_if("complete")).first())
    sinks.write_csv(I.without_files(listed), f"{out}/tables/scenes/scene_inventory", order=["acq_date", "scene_id"])
    zones = kept(vector.read_layer(spark, area, settings.zone_column, settings.crs), f"{work}/zones")

    placed = kept(windows.places(listed.where("complete")), f"{work}/heads")
    faults = [placed.where("size is null").select("scene_id", F.col("file_lst").alias("path"), F.lit("the thermal band has no readable head").alias("error"))]
    scenes = placed.where("size is not null")
    scenes = scenes.withColumn("crs", F.coalesce("crs", F.lit(settings.crs)))
    scenes = kept(_footprints(scenes, settings.crs), f"{work}/places")
    if settings.min_overlap > 0:
        scenes = kept(P.footprint_overlap(scenes, zones), f"{work}/overlap")
        scenes = scenes.where(F.col("overlap") > settings.min_overlap)
    counts = kept(windows.clear_counts(scenes, settings.qa_mask), f"{work}/clear")
    faults.append(counts.where("error is not null").select("scene_id", "path", "error"))
    lattices = scenes.select("crs", "size", (F.col("left") % F.col("size")).alias("dx"), (F.col("top") % F.col("size")).alias("dy")).distinct().collect()
    grids = []
    for k, t in enumerate(lattices):
        same = scenes.where((F.col("crs") == t["crs"]) & (F.col("size") == t["size"]) & (F.col("left") % F.col("size") == t["dx"]) & (F.col("top") % F.col("size") == t["dy"]))
        grid = area_grid(zones, t["size"], t["dx"], t["dy"])
        grids.append(grid)
        cells, bad = calibrated(spark, same, settings, grid, t["crs"], f"{work}/lattice-{k}")
        faults.append(bad)
        spans = P.spans(zones, grid)
        mask = P.clip(cells.select("row", "col").distinct(), spans).withColumn("in_area", F.lit(True))
        marked = cells.join(mask, ["row", "col"], "left").withColumn("in_area", F.coalesce("in_area", F.lit(False)))
        marked.write.mode("overwrite").parquet(f"{work}/pixels/lattice={k}")
        kept(spans, f"{work}/spans/lattice={k}")
    LOG.info("%d scenes over the area, on %d lattices; %d zones", scenes.count(), len(lattices), zones.count())
    if not lattices:
        raise ValueError("no scene overlaps the area: is min_overlap too high for it?")
    faults = kept(fault_table(faults), f"{out}/faults")
    broken = faults.count()
    if broken:
        LOG.error("%d scenes cannot be read and are left out, see %s/faults", broken, out)
    pixels, spans = spark.read.parquet(f"{work}/pixels").join(faults.select("scene_id"), "scene_id", "left_anti"), spark.read.parquet(f"{work}/spans")

    info = scenes.select("scene_id", "sensor", F.col("acq_date").alias("data_aq"), F.col("year").alias("ano"), F.col("month").alias("mes"), "pathrow", "tier", "cloud_cover", "sun_elevation")
    of_area = {c: F.when(F.col("in_area"), F.col(c)) for c in ("ndvi", "ndvi_raw", "lst_c", "lst_raw", "below_sentinel")}
    measures = Q.scene_measures(pixels.withColumns(of_area), ["scene_id"], settings).drop("n_clear")  # shares are of the box
    measures = measures.join(counts.select("scene_id", "n_scene", "n_clear"), "scene_id").join(info, "scene_id")
    judged = kept(Q.cascade(measures, settings), f"{work}/judged")
    for r in judged.where("reject is not null").groupBy("reject").agg(F.count("*").alias("n")).collect():
        LOG.warning("%d scenes left out: %s", r["n"], r["reject"])
    good = judged.where("reject is null").select(*SCENE)
    if good.isEmpty():
        raise ValueError("no scene passes the quality rules")
    LOG.info("%d scenes pass the quality rules", good.count())
    mine = pixels.where("in_area").join(good, "scene_id")

    most = max(r[0] for r in spans.groupBy("lattice").agg(F.sum(F.col("col_to") - F.col("col_from") + 1)).collect())  # cells of all zones
    stats = kept(R.scene_stats(mine, ["scene_id"], SCENE[1:], most).withColumn("mes_nome", S.month_name(F.col("data_aq"))), f"{work}/scene_stats")
    sinks.write_csv(stats, f"{out}/tables/scenes/ndvi_lst_per_scene", order=["data_aq", "scene_id"])
    monthly = kept(R.monthly(stats, settings, scene="scene_id"), f"{work}/monthly")
    annual = R.annual(monthly)
    sinks.write_csv(monthly, f"{out}/tables/monthly/ndvi_lst_monthly", order=["ano", "mes"])
    sinks.write_csv(annual, f"{out}/tables/monthly/ndvi_lst_annual", order=["ano"])
    reports(spark, stats, monthly, annual, out, settings, area_name)

    LOG.info("tables of the area are written")
    zoned = _in_zones(mine, spans)
    zone_stats = R.scene_stats(zoned, ["scene_id", "zone_id"], SCENE[1:], most)
    zone_stats = kept(R.complete_zones(zone_stats, zones, scene="scene_id"), f"{work}/zone_scene_stats")
    names = zones.select("zone_id", "zone_name")
    zone_monthly = kept(R.monthly(zone_stats.drop("cloud_cover", "sun_elevation"), settings, zones, ("zone_id",), scene="scene_id").join(names, "zone_id"), f"{work}/zone_monthly")
    zone_annual = R.annual(zone_monthly, ("zone_id", "zone_name"))
    zone_tables(zone_monthly, zone_annual, f"{out}/tables/spatial/zones", area_name, zone_label)

    anomaly_tables(Q.anomalies(judged.where("reject is null or reject = 'saturated thermal'"), settings), f"{out}/tables/anomalies")
    LOG.info("tables of zones and anomalies are written")
    if rasters:
        for v, name, suffix in (("ndvi", "ndvi", "_NDVI.tif"), ("lst_c", "lst", "_LST_Celsius.tif")):
            shown = pixels.where("in_area").join(good.select("scene_id"), "scene_id")
            for k, grid in enumerate(grids):
                made = kept(tiles.tiles(shown.where(F.col("lattice") == k), "scene_id", v, grid), f"{work}/tiles/{name}-{k}")
                tiles.write_files(tiles.parts(made, "scene_id", grid, settings.crs), "scene_id", f"{out}/rasters/{name}", suffix)
    if pixel_tables:
        weighted = R.with_scene_weight(mine, "scene_id", stats)
        for v in R.VARIABLES:
            for name, by in (("monthly", ["ano", "mes"]), ("annual", ["ano"])):
                composite = R.pixel_composite(weighted, [*by, "x", "y"], v, "ndvi_n")
                if "mes" not in by:
                    composite = composite.withColumn("mes", F.lit(None).cast("int"))
                sinks.write_pixels(composite, f"{out}/tables/spatial/pixels/{v}_{name}")
    LOG.info("done")
    return {"listed": listed.count(), "tried": judged.count(), "used": stats.count()}


def fault_table(parts: list[DataFrame]) -> DataFrame:
    """A row a scene that cannot be read: its first bad file and error, and how many reads failed."""
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    first = F.min(F.struct("path", "error")).alias("first")
    return out.groupBy("scene_id").agg(first, F.count("*").alias("n_faults")).select("scene_id", "first.path", "first.error", "n_faults")


def _footprints(scenes: DataFrame, crs: str) -> DataFrame:
    """Adds ``xmin, ymin, xmax, ymax`` of a scene's corners in the run's system."""
    right, bottom = F.col("left") + F.col("cols") * F.col("size"), F.col("top") - F.col("rows") * F.col("size")
    out = None
    for source in [r[0] for r in scenes.select("crs").distinct().collect()]:
        corners = [X.project(x, y, source, crs) for x in (F.col("left"), right) for y in (F.col("top"), bottom)]
        xs, ys = [c[0] for c in corners], [c[1] for c in corners]
        part = scenes.where(F.col("crs") == source).withColumns({"xmin": F.least(*xs), "ymin": F.least(*ys), "xmax": F.greatest(*xs), "ymax": F.greatest(*ys)})
        out = part if out is None else out.unionByName(part)
    return scenes if out is None else out


def _in_zones(pixels: DataFrame, spans: DataFrame) -> DataFrame:
    """Pixels with each zone that holds them, by the lattice that both are on."""
    side = spans.withColumnsRenamed({"row": "__row", "lattice": "__lattice"})
    side = side.withColumn("__block", F.explode(F.sequence(F.floor(F.col("col_from") / P.BLOCK), F.floor(F.col("col_to") / P.BLOCK))))
    hit = (F.col("lattice") == F.col("__lattice")) & (F.col("row") == F.col("__row")) & (F.floor(F.col("col") / P.BLOCK) == F.col("__block")) & F.col("col").between(F.col("col_from"), F.col("col_to"))
    return pixels.join(side, hit).drop("__lattice", "__row", "__block", "col_from", "col_to")


def reports(spark: SparkSession, stats: DataFrame, monthly: DataFrame, annual: DataFrame, out: str, settings: Settings, area_name: str) -> None:
    """The full report (summary, scenes, months) and the annual summary."""
    total = sinks.run_summary(stats)
    head = [f"NDVI AND LST REPORT - {area_name}", f"Period: {settings.year_start} to {settings.year_end}", "Monthly means are weighted by valid pixels", ""]
    sensors = ", ".join(r[0] for r in stats.select("sensor").distinct().orderBy("sensor").collect())
    scenes = stats.select("scene_id", F.col("data_aq").cast("string").alias("data_aq"), "ndvi_media", "lst_c_media", "pct_valido", "cloud_cover").orderBy("data_aq", "scene_id")
    months = monthly.select("ano", "mes", "mes_nome", "ndvi_media", "ndvi_min", "ndvi_max", "lst_c_media", "lst_c_min", "lst_c_max").orderBy("ano", "mes")
    lines = [*head, *sinks.text_lines(total, "OVERALL SUMMARY"), f"Sensors used: {sensors}", "", *sinks.text_lines(scenes, "PER SCENE"), "", *sinks.text_lines(months, "MONTHLY SERIES")]
    sinks.write_lines(spark, lines, f"{out}/tables/full_report")
    sinks.write_text(annual.orderBy("ano"), f"{out}/tables/annual_summary", f"ANNUAL SUMMARY - NDVI and LST - {area_name}")


def zone_tables(monthly: DataFrame, annual: DataFrame, folder: str, area_name: str, label: str) -> None:
    """Tables of zones by month and year, each as CSV and as a report of fixed width."""
    sinks.write_csv(monthly, f"{folder}/ndvi_lst_per_zone_monthly", order=["zone_id", "data_ref"])
    sinks.write_csv(annual, f"{folder}/ndvi_lst_per_zone_annual", order=["zone_id", "ano"])
    title = [f"NDVI AND LST BY {label.upper()} | {area_name}", "Means are weighted by valid pixels; NA: no usable scene", ""]
    columns = {"zone_name": "%-28s", "ano": "%-6d", "mes": "%-4d", "ndvi_media": "%10.4f", "lst_c_media": "%10.2f", "ndvi_n": "%10d"}
    sinks.fixed_width(monthly, columns, ["zone_id", "ano", "mes"], [*title, "zone                         year   mon        ndvi        lst         px"], f"{folder}/report_monthly")
    columns = {"zone_name": "%-28s", "ano": "%-6d", "ndvi_media_anual": "%10.4f", "lst_media_anual": "%10.2f", "n_meses_com_dados": "%8d"}
    sinks.fixed_width(annual, columns, ["zone_id", "ano"], [*title, "zone                         year         ndvi        lst   months"], f"{folder}/report_annual")


def anomaly_tables(report: DataFrame, folder: str) -> None:
    """The report of each scene, by sensor, by year, and of critical scenes: CSV with four digits, and text."""
    tables = {"anomalies_per_scene": report, "summary_by_sensor": Q.anomaly_summary(report, "sensor"), "summary_by_year": Q.anomaly_summary(report, "ano"), "critical_scenes": Q.critical(report)}
    short = ["scene_id", "sensor", "data_aq", "lst_raw_min", "lst_raw_max", "pct_lst_desc", "anomaly_type"]
    for name, table in tables.items():
        order = [c for c in ("data_aq", "scene_id", "sensor", "ano") if c in table.columns]
        sinks.write_csv(table, f"{folder}/{name}", digits=4, order=order)
        if not table.isEmpty():
            text = table.select(*short).withColumn("data_aq", F.col("data_aq").cast("string")) if "scene_id" in table.columns else table
            sinks.write_text(text.orderBy(*[c for c in order if c in text.columns]), f"{folder}/{name}_text", name.replace("_", " ").upper())
    a = Q.advisory(report).first()
    if a["check_bounds"]:
        LOG.warning("more than half of the scenes touch a temperature bound: the bounds are probably wrong for this climate")
