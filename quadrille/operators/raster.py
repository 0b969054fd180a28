"""Rasters as long tables ``(scene, row, col, value)``: resampling and reprojection by joins on cell indices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .projection import from_lonlat, project, to_lonlat
from .spatial import Grid

__all__ = ["cells", "from_lonlat", "project", "reproject", "resample", "same_grid", "to_lonlat"]


def same_grid(a: Grid, b: Grid) -> bool:
    return a == b


def cells(spark, grid: Grid) -> DataFrame:
    """All cells of a grid with their centres."""
    rows = spark.range(grid.rows).select(F.col("id").cast("int").alias("row"))
    out = rows.select("row", F.explode(F.sequence(F.lit(0), F.lit(grid.cols - 1))).alias("col"))
    x, y = grid.center(F.col("row"), F.col("col"))
    return out.withColumns({"x": x, "y": y})


def _place(source: Grid, x: Column, y: Column) -> tuple[Column, Column]:
    """Fractional row and column in the source, whole at centres."""
    return (source.y0 - y) / source.size - 0.5, (x - source.x0) / source.size - 0.5


def resample(pixels: DataFrame, source: Grid, target: Grid, method: str = "bilinear", value: str = "value", project=None) -> DataFrame:
    """Values on the target grid.

    ``nearest`` takes the cell that holds the target's centre.  ``bilinear`` weighs the four cells around it; missing
    neighbours drop out and the rest is rescaled; without any the cell is missing.  ``project`` maps the target's
    ``(x, y)`` columns to the source's system.
    """
    spark = pixels.sparkSession
    at = cells(spark, target)
    x, y = project(F.col("x"), F.col("y")) if project else (F.col("x"), F.col("y"))
    fr, fc = _place(source, x, y)
    at = at.withColumns({"fr": fr, "fc": fc})
    if method == "nearest":
        near = at.select("row", "col", F.floor(F.col("fr") + 0.5).cast("int").alias("srow"), F.floor(F.col("fc") + 0.5).cast("int").alias("scol"), F.lit(1.0).alias("w"))
    elif method == "bilinear":
        r0, c0 = F.floor("fr").cast("int"), F.floor("fc").cast("int")
        tr, tc = F.col("fr") - F.floor("fr"), F.col("fc") - F.floor("fc")
        four = [F.struct((r0 + i).alias("srow"), (c0 + j).alias("scol"), ((tr if i else 1 - tr) * (tc if j else 1 - tc)).alias("w")) for i in (0, 1) for j in (0, 1)]
        near = at.select("row", "col", F.explode(F.array(*four)).alias("s")).select("row", "col", "s.*").where("w > 0")
    else:
        raise ValueError(method)
    data = pixels.withColumnsRenamed({"row": "srow", "col": "scol"}).where(F.col(value).isNotNull())
    joined = data.join(near, ["srow", "scol"])
    keys = [c for c in data.columns if c not in ("srow", "scol", value)]
    return joined.groupBy(*keys, "row", "col").agg(F.try_divide(F.sum(F.col(value) * F.col("w")), F.sum("w")).alias(value))


def reproject(pixels: DataFrame, source: Grid, source_crs: str, target: Grid, target_crs: str, value: str = "value") -> DataFrame:
    """Bilinear values on a grid of another system; the same system needs a resampling at most."""
    if source_crs == target_crs:
        return pixels if source == target else resample(pixels, source, target, value=value)
    return resample(pixels, source, target, value=value, project=lambda x, y: project(x, y, target_crs, source_crs))
