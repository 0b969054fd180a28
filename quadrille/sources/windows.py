"""Scenes read by windows: only the strips or tiles of their bands that the area touches, as byte ranges of the files.

A window is some rows of a scene.  One task reads it from all bands and puts them side by side, so cells are never
shuffled to meet, and what is read and sent on grows with the area and not with the scene.  The one thing that needs a
whole scene, the share of clear cells, is counted in the tasks that read its quality band, a row a window.

What cannot be read is a row of faults (scene, file, error) beside the cells; a scene with a fault is left out of a run
and named.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .geotiff import Band

#: Rows of a window, and bytes of a file's head that are read at once.
ROWS, HEAD = 512, 1 << 16
ROLES = {"file_qa": "qa", "file_red": "dn_red", "file_nir": "dn_nir", "file_lst": "dn_st"}


class Ranges:
    """Byte ranges of a file in any store that Arrow knows; ``taken`` counts the bytes read."""

    def __init__(self, path: str) -> None:
        from pyarrow import fs

        if path.startswith("file:/") and not path.startswith("file:///"):
            path = "file://" + path[len("file:") :]
        store, at = fs.FileSystem.from_uri(path)
        self.file = store.open_input_file(at)
        self.head = self.file.read_at(HEAD, 0)
        self.taken = len(self.head)

    def __call__(self, at: int, size: int) -> bytes:
        if at + size <= len(self.head):
            return self.head[at : at + size]
        self.taken += size
        body = self.file.read_at(size, at)
        if len(body) != size:
            raise ValueError("the file is cut short")
        return body


@lru_cache(maxsize=16)
def open_band(path: str) -> Band:
    return Band(Ranges(path))


def _shift(band: Band, left: float, top: float, size: float) -> tuple[int, int]:
    """By how many rows and columns a band lies off a lattice; an error if it is on another one."""
    rows, cols = (band.top - top) / size, (left - band.left) / size
    if abs(band.size - size) > 1e-6 * size or max(abs(rows - round(rows)), abs(cols - round(cols))) > 1e-3:
        raise ValueError("a band lies on another lattice than the scene")
    return round(rows), round(cols)


def places(scenes: DataFrame, file: str = "file_lst") -> DataFrame:
    """``scenes`` with ``rows, cols, left, top, size, crs`` of a band, read from its head; nulls where it cannot be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for path in batch["path"].to_pylist():
                try:
                    b = open_band(path)
                    rows.append((path, b.rows, b.cols, b.left, b.top, b.size, b.crs))
                except Exception:  # faults names it
                    rows.append((path, *[None] * 6))
            kinds = (pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], k) for k in kinds], names=names)

    names = ["path", "rows", "cols", "left", "top", "size", "crs"]
    found = scenes.select(F.col(file).alias("path")).where("path is not null").distinct().mapInArrow(run, "path string, rows int, cols int, left double, top double, size double, crs string")
    return scenes.join(found.withColumnRenamed("path", file), file, "left")


def _windows(scenes: DataFrame, first, last) -> DataFrame:
    """A row for every ``ROWS`` rows of a scene from ``first`` to before ``last``, dealt over all tasks."""
    steps = F.sequence(F.floor(first / ROWS).cast("int"), F.floor((last - 1) / ROWS).cast("int"))
    each = scenes.where(first < last).withColumn("window", F.explode(steps))
    out = each.withColumns({"from": F.greatest(F.col("window") * ROWS, first).cast("int"), "to": F.least((F.col("window") + 1) * ROWS, last).cast("int")})
    return out.repartition("scene_id", "window")


CELLS = "scene_id string, row int, col int, x double, y double, qa int, dn_red int, dn_nir int, dn_st int, path string, error string"
TYPES = [pa.string(), pa.int32(), pa.int32(), pa.float64(), pa.float64(), *[pa.int32()] * 4, pa.string(), pa.string()]


def _whole(values: np.ndarray) -> pa.Array:
    """Integers; null where there is no data."""
    missing = np.isnan(values)
    return pa.array(np.where(missing, 0, values).astype(np.int32), mask=missing)


def scene_cells(scenes: DataFrame) -> DataFrame:
    """Cells of ``scenes`` (with their files and place) within ``row_from, row_to, col_from, col_to``, ends left out.

    ``scene_id, row, col, x, y, qa, dn_red, dn_nir, dn_st``, rows and columns being the scene's own; or, where a band
    cannot be read, ``scene_id, path, error`` alone.
    """
    names = [f.split()[0] for f in CELLS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                found = {}
                for file, role in ROLES.items():
                    try:
                        band = open_band(r[file])
                        dr, dc = _shift(band, r["left"], r["top"], r["size"])
                        found[role] = band.window(r["from"] + dr, r["to"] + dr, r["col_from"] + dc, r["col_to"] + dc).ravel()
                    except Exception as e:  # one bad file must not end the run
                        yield pa.RecordBatch.from_arrays([pa.array([r["scene_id"]]), *[pa.nulls(1, t) for t in TYPES[1:-2]], pa.array([r[file]], pa.string()), pa.array([repr(e)[:200]])], names=names)
                        found = None
                        break
                if found is None:
                    continue
                row, col = (a.ravel() for a in np.mgrid[r["from"] : r["to"], r["col_from"] : r["col_to"]])
                n = len(row)
                fixed = [pa.array([r["scene_id"]] * n, pa.string()), pa.array(row.astype(np.int32)), pa.array(col.astype(np.int32)), pa.array(r["left"] + (col + 0.5) * r["size"]), pa.array(r["top"] - (row + 0.5) * r["size"])]
                yield pa.RecordBatch.from_arrays([*fixed, *(_whole(found[c]) for c in ROLES.values()), pa.nulls(n, pa.string()), pa.nulls(n, pa.string())], names=names)

    asked = _windows(scenes.where("col_from < col_to"), F.col("row_from"), F.col("row_to"))
    return asked.select("scene_id", *ROLES, "left", "top", "size", "from", "to", "col_from", "col_to").mapInArrow(run, CELLS)


def clear_counts(scenes: DataFrame, mask: int) -> DataFrame:
    """``scene_id, n_scene, n_clear, path, error``: cells of the whole scene, and those with no bit of ``mask``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                try:
                    band = open_band(r["file_qa"])
                    dr, dc = _shift(band, r["left"], r["top"], r["size"])
                    words = band.window(r["from"] + dr, r["to"] + dr, dc, r["cols"] + dc)
                    there = words[~np.isnan(words)].astype(np.int64)
                    rows.append((r["scene_id"], words.size, int(np.count_nonzero(there & mask == 0)), None, None))
                except Exception as e:
                    rows.append((r["scene_id"], None, None, r["file_qa"], repr(e)[:200]))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["scene_id", "n", "clear", "path", "error"])

    asked = _windows(scenes, F.lit(0), F.col("rows")).select("scene_id", "file_qa", "left", "top", "size", "cols", "from", "to")
    counted = asked.mapInArrow(run, "scene_id string, n long, clear long, path string, error string")
    return counted.groupBy("scene_id").agg(F.sum("n").alias("n_scene"), F.sum("clear").alias("n_clear"), F.min("path").alias("path"), F.min("error").alias("error"))
