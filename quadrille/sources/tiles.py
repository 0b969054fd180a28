"""Rasters written as tiled GeoTIFF files from long tables.

Cells are dealt by raster and tile and every tile is compressed where its cells are, so no task holds more than a tile.
The places of tiles in the file are prefix sums of their sizes; the head that holds them is made from the sizes alone.
A file is then written by one task that streams its head and its tiles in order, a tile at a time, into any store that
Arrow knows.  Tiles without cells share one tile of missing values.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.spatial import Grid
from . import geotiff as T

TILE = 256
#: Fixed value: the key of a system's citation.
CITATION = 3073
#: What stands before a definition in the citation of a raster.
DEFINITION = "ESRI PE String = "


def system_keys(crs: str | None) -> tuple[tuple[int, ...], bytes]:
    """The key directory of a system, given by its code or by its definition, and the texts that keys point to."""
    if not crs:
        return (), b""
    plane = "PROJCS" in crs or ("[" not in crs and crs not in ("EPSG:4326", "EPSG:4674", "EPSG:4269", "EPSG:4258"))
    kind, key = (1, T.PROJECTED) if plane else (2, T.GEOGRAPHIC)
    code = crs.split(":")[-1]
    head = [1024, 0, 1, kind, 1025, 0, 1, 1]  # cells are areas
    if "[" not in crs and crs.startswith("EPSG:") and int(code) < T.OWN:
        keys, text = [*head, key, 0, 1, int(code)], b""
    else:
        text = (DEFINITION + crs + "|").encode()
        keys = [*head, key, 0, 1, T.OWN, CITATION, T.TEXTS, len(text), 0]
    return (1, 1, 0, len(keys) // 4, *keys), text + b"\0" * bool(text)


def head(grid: Grid, sizes: dict[int, int], empty: int, crs: str | None, tile: int = TILE) -> bytes:
    """The head of a tiled file of 32-bit fractions, deflated; ``sizes`` by number of tile, ``empty`` that of a missing one.

    Behind it come the missing tile and then the tiles in order of their numbers.  A file of over four gigabytes is a
    big one.
    """
    n = -(-grid.rows // tile) * -(-grid.cols // tile)
    keys, text = system_keys(crs)
    big = sum(sizes.values()) + empty + 64 * n > 0xF0000000
    word, code, inline = ("Q", 16, 8) if big else ("I", 4, 4)
    fields: list[tuple[int, int, tuple | bytes]] = [
        (T.WIDTH, 4, (grid.cols,)), (T.HEIGHT, 4, (grid.rows,)), (T.BITS, 3, (32,)), (T.COMPRESSION, 3, (8,)), (262, 3, (1,)), (T.SAMPLES, 3, (1,)), (T.PREDICTOR, 3, (1,)), (T.TILE_W, 4, (tile,)), (T.TILE_H, 4, (tile,)),
        (T.TILES, code, (0,) * n), (T.TILE_BYTES, 4, tuple(sizes.get(i, empty) for i in range(n))), (T.FORMAT, 3, (3,)), (T.SCALE, 12, (grid.size, grid.size, 0.0)), (T.TIE, 12, (0.0, 0.0, 0.0, grid.x0, grid.y0, 0.0)), (T.NODATA, 2, b"nan\0"),
    ]
    if keys:
        fields.append((T.KEYS, 3, keys))
    if text:
        fields.append((T.TEXTS, 2, text))
    fields.sort(key=lambda f: f[0])
    count = len(fields)
    start = 16 if big else 8
    tail_at = start + (8 + 20 * count + 8 if big else 2 + 12 * count + 4)
    length = lambda kind, v: len(v) if isinstance(v, bytes) else T.SIZES[kind] * len(v)
    end = tail_at + sum(size + size % 2 for _, kind, v in fields if (size := length(kind, v)) > inline)
    place, offsets = end + empty, []
    for i in range(n):
        offsets.append(place if i in sizes else end)
        place += sizes.get(i, 0)
    table, tail = b"", b""
    for tag, kind, v in fields:
        values = tuple(offsets) if tag == T.TILES else v
        body = values if isinstance(values, bytes) else struct.pack(f"<{len(values)}{T.CODES[kind]}", *values)
        table += struct.pack(f"<HH{word}", tag, kind, len(values))
        if len(body) <= inline:
            table += body.ljust(inline, b"\0")
        else:
            table += struct.pack(f"<{word}", tail_at + len(tail))
            tail += body + b"\0" * (len(body) % 2)
    first = struct.pack("<2sHHHQ", b"II", 43, 8, 0, start) if big else struct.pack("<2sHI", b"II", 42, start)
    return first + struct.pack("<Q" if big else "<H", count) + table + bytes(8 if big else 4) + tail


def _packed(cells: np.ndarray) -> bytes:
    return zlib.compress(np.ascontiguousarray(cells, "<f4").tobytes())


def tiles(pixels: DataFrame, key: str, value: str, grid: Grid, tile: int = TILE) -> DataFrame:
    """``key, tile, body``: every tile that has cells, compressed."""
    across = -(-grid.cols // tile)

    def run(f: pd.DataFrame) -> pd.DataFrame:
        cells = np.full((tile, tile), np.nan, np.float32)
        cells[f["row"] % tile, f["col"] % tile] = f["value"]
        return pd.DataFrame({key: [f[key].iloc[0]], "tile": [f["tile"].iloc[0]], "body": [_packed(cells)]})

    inside = F.col("row").between(0, grid.rows - 1) & F.col("col").between(0, grid.cols - 1)
    number = F.floor(F.col("row") / tile) * across + F.floor(F.col("col") / tile)
    cells = pixels.where(inside).select(key, number.cast("long").alias("tile"), "row", "col", F.col(value).cast("double").alias("value"))
    return cells.groupBy(key, "tile").applyInPandas(run, f"{key} {pixels.schema[key].dataType.simpleString()}, tile long, body binary")


def parts(made: DataFrame, key: str, grid: Grid, crs: str | None, tile: int = TILE) -> DataFrame:
    """``key, at, body``: the pieces of every file in order, its head first, from a written table of its tiles."""
    missing = _packed(np.full((tile, tile), np.nan))
    sizes = made.groupBy(key).agg(F.collect_list(F.struct("tile", F.octet_length("body").alias("size"))).alias("sizes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bodies = [head(grid, {s["tile"]: s["size"] for s in of}, len(missing), crs, tile) + missing for of in batch["sizes"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[key], pa.array([-1] * len(bodies), pa.int64()), pa.array(bodies, pa.binary())], names=[key, "at", "body"])

    heads = sizes.mapInArrow(run, f"{key} {made.schema[key].dataType.simpleString()}, at long, body binary")
    return heads.unionByName(made.select(key, F.col("tile").alias("at"), "body"))


def write_files(pieces: DataFrame, key: str, folder: str, suffix: str) -> int:
    """Stream the pieces of each file into ``folder``; returns the number of files.

    A file is written under another name and then renamed, so a task that runs again replaces what it wrote.  All
    machines must reach ``folder``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        uri = folder if "://" in folder else f"file://{folder}"
        store, root = fs.FileSystem.from_uri(uri)
        store.create_dir(root, recursive=True)
        name, out, done = None, None, 0

        def close() -> None:
            out.close()
            store.move(f"{root}/{name}{suffix}.writing", f"{root}/{name}{suffix}")

        for batch in batches:
            for i in range(batch.num_rows):
                if batch["name"][i].as_py() != name:
                    if out is not None:
                        close()
                    name, done = batch["name"][i].as_py(), done + 1
                    out = store.open_output_stream(f"{root}/{name}{suffix}.writing")
                out.write(batch["body"][i].as_py())
        if out is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([done], pa.int64())], names=["files"])

    ordered = pieces.select(F.col(key).cast("string").alias("name"), "at", "body").repartition("name").sortWithinPartitions("name", "at")
    return ordered.drop("at").mapInArrow(run, "files long").agg(F.coalesce(F.sum("files"), F.lit(0))).first()[0]
