"""Polygons on a grid of cells: membership by cell centre, areas and footprints.

A polygon is ``zone_id, zone_name, rings``: rings are arrays of ``struct<x, y>``; holes follow by the even-odd rule.
Where polygons overlap, their union counts once: it is cut into trapezoids between neighbouring heights at which
anything changes, which holds for holes, overlaps and rings that cross themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Spans up to this number are broadcast (four integers each); more are joined by a shuffle.
BROADCAST_SPANS = 1_000_000
#: Columns of a block: cells and runs meet by row and block, so no row of a wide grid is one key.
BLOCK = 256


@dataclass(frozen=True)
class Grid:
    """Cell (0, 0) is at the upper left; ``x0, y0`` is its outer corner."""

    x0: float
    y0: float
    size: float
    rows: int
    cols: int

    def center(self, row: Column, col: Column) -> tuple[Column, Column]:
        return self.x0 + (col + 0.5) * self.size, self.y0 - (row + 0.5) * self.size


def _merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs of columns without overlaps, in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(runs):
        if out and first <= out[-1][1] + 1:
            out[-1] = out[-1][0], max(out[-1][1], last)
        else:
            out.append((first, last))
    return out


def ring_spans(rings: list[np.ndarray], grid: Grid, touched: bool = False) -> list[tuple[int, int, int]]:
    """``(row, first column, last column)`` of the cells whose centres lie inside.

    With ``touched`` also those that the outline passes through: of every edge, the columns between the ends of its
    part within the row.  An outline on a border between cells passes through neither.
    """
    ys = np.concatenate([r[:, 1] for r in rings])
    top = max(0, int(np.floor((grid.y0 - ys.max()) / grid.size)))
    bottom = min(grid.rows - 1, int(np.ceil((grid.y0 - ys.min()) / grid.size)))
    edges = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
    down = edges[:, 1] > edges[:, 3]
    upward = np.where(down[:, None], edges[:, [2, 3, 0, 1]], edges)  # the lower end first
    out = []
    for row in range(top, bottom + 1):
        y = grid.y0 - (row + 0.5) * grid.size
        crossing = edges[(edges[:, 1] > y) != (edges[:, 3] > y)]
        x = np.sort(crossing[:, 0] + (y - crossing[:, 1]) * (crossing[:, 2] - crossing[:, 0]) / (crossing[:, 3] - crossing[:, 1]))
        # centres in [a, b)
        runs = [(int(np.ceil((a - grid.x0) / grid.size - 0.5)), int(np.ceil((b - grid.x0) / grid.size - 0.5)) - 1) for a, b in zip(x[::2], x[1::2], strict=False)]
        if touched:
            low, high = y - grid.size / 2, y + grid.size / 2
            e = upward[((upward[:, 1] < high) & (upward[:, 3] > low))]
            rise = e[:, 3] - e[:, 1]
            level = rise == 0
            slope = np.divide(e[:, 2] - e[:, 0], rise, out=np.zeros(len(e)), where=~level)
            xa = np.where(level, e[:, 0], e[:, 0] + (np.maximum(low, e[:, 1]) - e[:, 1]) * slope)
            xb = np.where(level, e[:, 2], e[:, 0] + (np.minimum(high, e[:, 3]) - e[:, 1]) * slope)
            first = np.floor((np.minimum(xa, xb) - grid.x0) / grid.size).astype(int)
            last = np.ceil((np.maximum(xa, xb) - grid.x0) / grid.size).astype(int) - 1
            runs += zip(first.tolist(), last.tolist(), strict=True)
        inside = [(max(0, first), min(grid.cols - 1, last)) for first, last in runs]
        out += [(row, first, last) for first, last in _merged([r for r in inside if r[1] >= r[0]])]
    return out


def _rings(value) -> list[np.ndarray]:
    return [np.array([(p["x"], p["y"]) for p in ring], float) for ring in value]


def spans(zones: DataFrame, grid: Grid, touched: bool = False) -> DataFrame:
    """``zone_id, row, col_from, col_to``: the polygons as runs of cells, made where the polygons are.

    A cell belongs to a polygon that holds its centre, or with ``touched`` to every polygon that it meets.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(z, *s) for z, rings in zip(f["zone_id"], f["rings"], strict=True) for s in ring_spans(_rings(rings), grid, touched)]
            yield pd.DataFrame(rows, columns=["zone_id", "row", "col_from", "col_to"])

    return zones.select("zone_id", "rings").mapInPandas(run, f"zone_id {zones.schema['zone_id'].dataType.simpleString()}, row int, col_from int, col_to int")


def _blocked(spans_: DataFrame) -> DataFrame:
    blocks = F.explode(F.sequence(F.floor(F.col("col_from") / BLOCK), F.floor(F.col("col_to") / BLOCK)))
    return spans_.withColumnRenamed("row", "__row").withColumn("__block", blocks)


def _hit(row: str, col: str) -> Column:
    return (F.col(row) == F.col("__row")) & (F.floor(F.col(col) / BLOCK) == F.col("__block")) & F.col(col).between(F.col("col_from"), F.col("col_to"))


def in_zones(cells: DataFrame, spans_: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """A row for each cell and zone that holds it; overlapping zones give several.

    The join is on the row and a block of columns, with the run as a residual condition.
    """
    side = _blocked(spans_.select("zone_id", "row", "col_from", "col_to"))
    if spans_.count() <= BROADCAST_SPANS:
        side = F.broadcast(side)
    return cells.join(side, _hit(row, col)).drop("__row", "__block", "col_from", "col_to")


def clip(cells: DataFrame, spans_: DataFrame, row: str = "row", col: str = "col") -> DataFrame:
    """Cells that lie in any zone, each once; the bounding box goes first, where the reader can use it."""
    box = spans_.agg(F.min("row"), F.max("row"), F.min("col_from"), F.max("col_to")).first()
    if box[0] is None:
        return cells.where("false")
    near = cells.where(F.col(row).between(box[0], box[1]) & F.col(col).between(box[2], box[3]))
    return near.join(_blocked(spans_.select("row", "col_from", "col_to")), _hit(row, col), "left_semi")


def _edges(polygons: list[list[np.ndarray]]) -> np.ndarray:
    """Rows ``x, y, x, y, polygon`` with the lower end first; level edges bound nothing."""
    out = [np.column_stack([r, np.roll(r, -1, axis=0), np.full(len(r), float(k))]) for k, rings in enumerate(polygons) for r in rings if len(r) > 2]
    e = np.concatenate(out) if out else np.zeros((0, 5))
    e = e[e[:, 1] != e[:, 3]]
    down = e[:, 1] > e[:, 3]
    e[down] = e[down][:, [2, 3, 0, 1, 4]]
    return e


def _crossings(some: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Heights at which the edges ``some`` cross edges of ``e``."""
    found = []
    for x0, y0, x1, y1, _ in some:
        near = e[(e[:, 1] < y1) & (e[:, 3] > y0)]
        dx, dy = near[:, 2] - near[:, 0], near[:, 3] - near[:, 1]
        turn = (x1 - x0) * dy - (y1 - y0) * dx
        with np.errstate(divide="ignore", invalid="ignore"):
            t = ((near[:, 0] - x0) * dy - (near[:, 1] - y0) * dx) / turn
            y = y0 + t * (y1 - y0)
        ok = (turn != 0) & (t > 0) & (t < 1) & (y > near[:, 1]) & (y < near[:, 3])
        found.append(y[ok])
    return np.unique(np.concatenate(found)) if found else np.zeros(0)


def _slabs(low: np.ndarray, high: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Trapezoids ``y0, y1, left0, left1, right0, right1`` of the union between each pair of neighbouring heights."""
    out = []
    for y0, y1 in zip(low.tolist(), high.tolist(), strict=True):
        act = e[(e[:, 1] <= y0) & (e[:, 3] >= y1)]
        at = lambda y, act=act: act[:, 0] + (y - act[:, 1]) * (act[:, 2] - act[:, 0]) / (act[:, 3] - act[:, 1])
        order = np.argsort(at((y0 + y1) / 2), kind="stable")
        below, above, who = at(y0)[order], at(y1)[order], act[order, 4].astype(int).tolist()
        inside: set[int] = set()
        for k, p in enumerate(who):
            if not inside:
                first = k
            inside ^= {p}
            if not inside:
                out.append((y0, y1, below[first], above[first], below[k], above[k]))
    return np.array(out, float).reshape(-1, 6)


def trapezoids(polygons: list[list[np.ndarray]]) -> np.ndarray:
    """The union of polygons, each by the even-odd rule, in trapezoids."""
    e = _edges(polygons)
    y = np.unique(np.concatenate([e[:, 1], e[:, 3], _crossings(e, e)]))
    return _slabs(y[:-1], y[1:], e) if len(y) else np.zeros((0, 6))


def _upto(low: np.ndarray, high: np.ndarray, bound: float) -> np.ndarray:
    """The mean of ``min(x, bound)`` as ``x`` runs evenly from ``low`` to ``high``."""
    primitive = lambda z: np.where(z > bound, bound * z - bound * bound / 2, z * z / 2)
    wide = np.abs(high - low) > 1e-9 * np.maximum(1, np.abs(low))
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where(wide, (primitive(high) - primitive(low)) / (high - low), np.minimum((low + high) / 2, bound))


def area_within(t: np.ndarray, xmin: float = -np.inf, ymin: float = -np.inf, xmax: float = np.inf, ymax: float = np.inf) -> float:
    """Area of trapezoids inside a rectangle."""
    y0, y1 = np.maximum(t[:, 0], ymin), np.minimum(t[:, 1], ymax)
    t, y0, y1 = t[y1 > y0], y0[y1 > y0], y1[y1 > y0]
    if not len(t):
        return 0.0
    low, high = max(xmin, t[:, 2:].min()), min(xmax, t[:, 2:].max())
    if high <= low:
        return 0.0
    at = lambda k, y: t[:, k] + (y - t[:, 0]) * (t[:, k + 1] - t[:, k]) / (t[:, 1] - t[:, 0]) - low  # noqa: E731  shifted: bounds near zero lose no digits
    kept = [_upto(a, b, high - low) - _upto(a, b, 0.0) for a, b in ((at(k, y0), at(k, y1)) for k in (2, 4))]
    return float(((kept[1] - kept[0]) * (y1 - y0)).sum())


def areas(zones: DataFrame) -> DataFrame:
    """``zone_id, area``: holes do not count."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"zone_id": f["zone_id"], "area": [area_within(trapezoids([_rings(r)])) for r in f["rings"]]})

    return zones.select("zone_id", "rings").mapInPandas(run, f"zone_id {zones.schema['zone_id'].dataType.simpleString()}, area double")


TRAPEZOID = "slab int, y0 double, y1 double, left0 double, left1 double, right0 double, right1 double"
#: Ends of edges in a slab of heights, about; edges that only pass through come on top.
SLAB = 1_500


def edge_table(zones: DataFrame) -> DataFrame:
    """``x0, y0, x1, y1, who``: the edges of all rings with the lower end first, and whose they are.  Level ones bound nothing."""
    numbered = zones.select("rings").withColumn("who", F.monotonically_increasing_id())  # before the rings come apart
    numbered = numbered.select("who", F.explode("rings").alias("r")).where(F.size("r") > 2)
    following = F.concat(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1))
    each = numbered.select("who", F.explode(F.arrays_zip(F.col("r").alias("a"), following.alias("b"))).alias("e")).select("who", "e.a", "e.b")
    up = F.col("a.y") <= F.col("b.y")
    low, high = F.when(up, F.col("a")).otherwise(F.col("b")), F.when(up, F.col("b")).otherwise(F.col("a"))
    return each.where("a.y <> b.y").select(low["x"].alias("x0"), low["y"].alias("y0"), high["x"].alias("x1"), high["y"].alias("y1"), "who")


def slab_bounds(edges: DataFrame) -> np.ndarray:
    """Heights that cut the edges into slabs of about ``SLAB`` ends each; the first and last are the extent's."""
    ends = edges.select(F.explode(F.array("y0", "y1")).alias("y"))
    n, low, high = ends.agg(F.count("*"), F.min("y"), F.max("y")).first()
    if not n:
        return np.zeros(0)
    k = max(1, -(-n // SLAB))
    inner = ends.agg(F.percentile_approx("y", [i / k for i in range(1, k)], max(10_000, 4 * k))).first()[0] if k > 1 else []
    return np.unique([low, *inner, high])


def _dealt(rows: DataFrame, low: str, high: str, bounds: np.ndarray) -> DataFrame:
    """Each row once for every slab that it reaches into."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            first = np.clip(np.searchsorted(bounds, f[low].to_numpy(), side="right") - 1, 0, len(bounds) - 2)
            last = np.clip(np.searchsorted(bounds, f[high].to_numpy(), side="left") - 1, first, len(bounds) - 2)
            times = last - first + 1
            at = np.repeat(np.arange(len(f)), times)
            out = f.iloc[at].reset_index(drop=True)
            out["slab"] = (np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times) + first[at]).astype(np.int32)
            yield out

    schema = ", ".join(f"`{c}` {t}" for c, t in rows.dtypes) + ", slab int"
    return rows.mapInPandas(run, schema)


def dissolve(zones: DataFrame, edges: DataFrame | None = None, bounds: np.ndarray | None = None) -> DataFrame:
    """The union of all zones as trapezoids, slab by slab of height.

    Edges are dealt to the slabs that they cross; a task finds where those of its slab cross each other and cuts the
    trapezoids between neighbouring heights.  The driver holds a height a slab.
    """
    edges = edge_table(zones) if edges is None else edges
    bounds = slab_bounds(edges) if bounds is None else bounds

    def cut(f: pd.DataFrame) -> pd.DataFrame:
        k = int(f["slab"].iloc[0])
        low, high = bounds[k], bounds[k + 1]
        e = np.column_stack([f[c].to_numpy(float) for c in ("x0", "y0", "x1", "y1")] + [pd.factorize(f["who"])[0].astype(float)])
        crossed = _crossings(e, e)
        y = np.unique(np.concatenate([e[:, 1], e[:, 3], crossed, [low, high]]))
        y = y[(y >= low) & (y <= high)]
        out = pd.DataFrame(_slabs(y[:-1], y[1:], e), columns=["y0", "y1", "left0", "left1", "right0", "right1"])
        return out.assign(slab=np.int32(k))

    if len(bounds) < 2:
        return zones.sparkSession.createDataFrame([], TRAPEZOID)
    return _dealt(edges, "y0", "y1", bounds).groupBy("slab").applyInPandas(cut, TRAPEZOID)


def footprint_overlap(scenes: DataFrame, zones: DataFrame) -> DataFrame:
    """Adds ``overlap``: the share of the dissolved area inside the scene's extent ``xmin, ymin, xmax, ymax``.

    Extents, each once, are dealt to the slabs of the area that they reach into, and met there by its trapezoids.
    """
    spark, box = scenes.sparkSession, ["xmin", "ymin", "xmax", "ymax"]
    edges = edge_table(zones)
    bounds = slab_bounds(edges)
    t = dissolve(zones, edges, bounds)
    extents = scenes.select(*[F.col(c).cast("double").alias(c) for c in box]).distinct()

    def measured(traps: pd.DataFrame, boxes: pd.DataFrame) -> pd.DataFrame:
        mine = traps[["y0", "y1", "left0", "left1", "right0", "right1"]].to_numpy(float).reshape(-1, 6)
        asked = boxes[box].to_numpy(float).reshape(-1, 4)
        rows = [(*b, area_within(mine, *b)) for b in asked.tolist()] + [(np.nan,) * 4 + (area_within(mine),)]
        return pd.DataFrame(rows, columns=[*box, "area"])

    if len(bounds) < 2:
        return scenes.withColumn("overlap", F.lit(None).cast("double"))
    reached = _dealt(extents.where((F.col("ymax") > float(bounds[0])) & (F.col("ymin") < float(bounds[-1]))), "ymin", "ymax", bounds)
    parts = t.groupBy("slab").cogroup(reached.groupBy("slab")).applyInPandas(measured, "xmin double, ymin double, xmax double, ymax double, area double")
    summed = parts.groupBy(*box).agg(F.sum("area").alias("area"))  # the row without an extent is the whole area
    whole = F.col("xmin").isNull() | F.isnan("xmin")
    total = summed.where(whole).first()
    share = summed.where(~whole).select(*[F.col(c).alias(f"__{c}") for c in box], (F.col("area") / F.lit(total["area"] if total and total["area"] else None)).alias("overlap"))
    same = F.lit(True)
    for c in box:
        same = same & (F.col(c).cast("double") == F.col(f"__{c}"))
    joined = scenes.join(share, same, "left").drop(*[f"__{c}" for c in box])
    known = F.lit(bool(total and total["area"]))
    return joined.withColumn("overlap", F.when(known & F.col("xmin").isNotNull(), F.coalesce("overlap", F.lit(0.0))))


def transform(zones: DataFrame, source: str, target: str) -> DataFrame:
    """The zones in another coordinate system; vertices move, edges stay straight."""
    if source == target:
        return zones
    from . import raster

    def moved(p: Column) -> Column:
        x, y = raster.project(p["x"], p["y"], source, target)
        return F.struct(x.alias("x"), y.alias("y"))

    return zones.withColumn("rings", F.transform("rings", lambda ring: F.transform(ring, moved)))


def with_values(zones: DataFrame, values: DataFrame, key: str = "zone_name") -> DataFrame:
    """Zones with their values for a map; a zone without values stays."""
    return zones.join(values, key, "left")


def rectangle(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(xmin, ymin), p(xmax, ymin), p(xmax, ymax), p(xmin, ymax)))


def vertices(zones: DataFrame) -> DataFrame:
    """A row for each vertex, with ring and place, for maps."""
    rings = zones.select("zone_id", F.posexplode("rings").alias("ring", "points"))
    return rings.select("zone_id", "ring", F.posexplode("points").alias("vertex", "p")).select("zone_id", "ring", "vertex", "p.x", "p.y")


def duplicate_names(zones: DataFrame) -> DataFrame:
    return zones.groupBy("zone_name").agg(F.count("*").alias("n")).where("n > 1")


#: Names by which a column of zone names is known, in order of preference.
NAME_COLUMNS = (
    "NOME", "Nome", "nome", "NAME", "Name", "name", "NM_BAIRRO", "nm_bairro", "BAIRRO", "bairro", "NM_MUN", "NM_MUNICIP", "MUNICIPIO", "municipio",
    "NAME_1", "NAME_2", "NAME_3", "district", "DISTRICT", "zone", "ZONE",
)


def name_column(df: DataFrame, wanted: str | None = None) -> str:
    """The column of zone names: the wanted one, else a usual name, else the first text column."""
    if wanted:
        if wanted not in df.columns:
            raise ValueError(f"no column {wanted}")
        return wanted
    for c in NAME_COLUMNS:
        if c in df.columns:
            return c
    for c, t in df.dtypes:
        if t == "string":
            return c
    raise ValueError("no text column names the zones")


def inner_point(rings: list[np.ndarray]) -> tuple[float, float] | None:
    """A point inside, by the even-odd rule: in the middle of the widest piece of a level line through the middle.

    The line lies between the nearest corners above and below the middle of the heights, so it meets no corner.
    """
    ys = np.unique(np.concatenate([r[:, 1] for r in rings])) if rings else np.zeros(0)
    if len(ys) < 2:
        return None
    middle = (ys[0] + ys[-1]) / 2
    k = min(max(int(np.searchsorted(ys, middle, side="right")), 1), len(ys) - 1)
    y = (ys[k - 1] + ys[k]) / 2
    edges = np.concatenate([np.hstack([r, np.roll(r, -1, axis=0)]) for r in rings])
    crossing = edges[(edges[:, 1] > y) != (edges[:, 3] > y)]
    x = np.sort(crossing[:, 0] + (y - crossing[:, 1]) * (crossing[:, 2] - crossing[:, 0]) / (crossing[:, 3] - crossing[:, 1]))
    widths = x[1::2] - x[::2]
    if not len(widths):
        return None
    at = int(np.argmax(widths))
    return float((x[2 * at] + x[2 * at + 1]) / 2), float(y)


def label_points(zones: DataFrame) -> DataFrame:
    """``zone_id, x, y``: a point inside each polygon, where its label goes; nulls for one without an inside."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(z, *(inner_point(_rings(rings)) or (None, None))) for z, rings in zip(f["zone_id"], f["rings"], strict=True)]
            yield pd.DataFrame(rows, columns=["zone_id", "x", "y"])

    return zones.select("zone_id", "rings").mapInPandas(run, f"zone_id {zones.schema['zone_id'].dataType.simpleString()}, x double, y double")
