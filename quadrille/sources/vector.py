"""Polygon layers: GeoJSON, GeoPackage and shapefile, as ``zone_id, zone_name, rings, properties``."""

from __future__ import annotations

import codecs
import re
import sqlite3
import struct
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import exists

ZONES = "zone_id int, zone_name string, rings array<array<struct<x: double, y: double>>>, properties map<string, string>"


def _bytes(spark: SparkSession, path: str) -> bytes:
    """A layer of one study area is a small file; it is fetched through Spark's readers, so any store will do."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])


def read_geojson(spark: SparkSession, path: str, name: str | None) -> DataFrame:
    """Polygons and multipolygons; coordinates beyond x and y are left out."""
    schema = "crs string, features array<struct<properties: map<string, string>, geometry: struct<type: string, coordinates: string>>>"
    f = spark.read.schema(schema).option("multiLine", True).json(path).select(F.posexplode("features").alias("i", "f"))
    shape = F.col("f.geometry.coordinates")
    many = F.from_json(shape, "array<array<array<array<double>>>>")
    one = F.from_json(shape, "array<array<array<double>>>")
    rings = F.when(F.col("f.geometry.type") == "MultiPolygon", F.flatten(many)).otherwise(one)
    points = F.transform(rings, lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))
    return f.select((F.col("i") + 1).cast("int").alias("zone_id"), (F.col("f.properties")[name] if name else F.lit(None).cast("string")).alias("zone_name"), points.alias("rings"), F.col("f.properties").alias("properties"))


def wkb_rings(b: bytes, at: int = 0) -> tuple[list[list[tuple[float, float]]], int]:
    """Rings of a polygon or multipolygon, and where the geometry ends."""
    order = "<" if b[at] else ">"
    (kind,) = struct.unpack_from(order + "I", b, at + 1)
    dims = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3)
    (n,) = struct.unpack_from(order + "I", b, at + 5)
    at, rings = at + 9, []
    if kind % 1000 == 6:
        for _ in range(n):
            part, at = wkb_rings(b, at)
            rings += part
    elif kind % 1000 == 3:
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", b, at)
            v = struct.unpack_from(f"{order}{m * dims}d", b, at + 4)
            rings.append(list(zip(v[::dims], v[1::dims], strict=True)))
            at += 4 + 8 * m * dims
    else:
        raise ValueError(f"geometry type {kind}")
    return rings, at


def _frame(spark: SparkSession, rows: list) -> DataFrame:
    return spark.createDataFrame([(i, n, [[{"x": x, "y": y} for x, y in r] for r in rings], p) for i, (n, rings, p) in enumerate(rows, 1)], ZONES)


def read_geopackage(spark: SparkSession, path: str, name: str | None) -> DataFrame:
    body = _bytes(spark, path)
    with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:  # read on the driver alone
        f.write(body)
        f.flush()
        with sqlite3.connect(f.name) as db:
            table, column, srs = db.execute("select table_name, column_name, srs_id from gpkg_geometry_columns").fetchone()
            if not srs:
                raise ValueError("the layer has no coordinate system")
            cursor = db.execute(f'select * from "{table}"')
            names = [d[0] for d in cursor.description]
            rows = []
            for values in cursor:
                row = dict(zip(names, values, strict=True))
                blob = row.pop(column)
                envelope = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}[blob[3] >> 1 & 7]
                rows.append((str(row[name]) if name else None, wkb_rings(blob, 8 + envelope)[0], {k: str(v) for k, v in row.items()}))
    return _frame(spark, rows)


def _bytes_if_there(spark: SparkSession, path: str) -> bytes:
    return _bytes(spark, path) if exists(spark, path) else b""


def read_shapefile(spark: SparkSession, path: str, name: str | None) -> DataFrame:
    """``path`` is the ``.shp``; its ``.dbf`` and ``.prj`` lie beside it."""
    shp, dbf = _bytes(spark, path), _bytes(spark, path[:-4] + ".dbf")
    if not _bytes(spark, path[:-4] + ".prj").strip():
        raise ValueError("the layer has no coordinate system")
    shapes, at = [], 100
    while at < len(shp):
        (words,) = struct.unpack_from(">i", shp, at + 4)
        (kind,) = struct.unpack_from("<i", shp, at + 8)
        if kind in (5, 15, 25):
            parts, points = struct.unpack_from("<2i", shp, at + 44)
            starts = [*struct.unpack_from(f"<{parts}i", shp, at + 52), points]
            v = struct.unpack_from(f"<{2 * points}d", shp, at + 52 + 4 * parts)
            xy = list(zip(v[::2], v[1::2], strict=True))
            shapes.append([xy[a:b] for a, b in zip(starts, starts[1:], strict=False)])
        else:
            shapes.append([])
        at += 8 + 2 * words
    count, head, size = struct.unpack_from("<IHH", dbf, 4)
    encoding = _encoding(_bytes_if_there(spark, path[:-4] + ".cpg"), dbf[29])
    fields = []
    for i in range((head - 33) // 32):
        f = dbf[32 + 32 * i : 64 + 32 * i]
        fields.append((f[:11].split(b"\0")[0].decode(), f[16]))
    rows = []
    for i in range(count):
        at, values = head + i * size + 1, {}
        for field, length in fields:
            values[field] = _text(dbf[at : at + length], encoding)
            at += length
        rows.append((values[name] if name else None, shapes[i], values))
    return _frame(spark, rows)


def layer_crs(spark: SparkSession, path: str) -> str:
    """The layer's coordinate system as ``AUTHORITY:code``; a layer without one is an error, as it cannot be guessed."""
    code = None
    if path.endswith(".gpkg"):
        with tempfile.NamedTemporaryFile(suffix=".gpkg") as f:
            f.write(_bytes(spark, path))
            f.flush()
            with sqlite3.connect(f.name) as db:
                (code,) = db.execute("select srs_id from gpkg_geometry_columns").fetchone()
    elif path.endswith(".shp"):
        return text_crs(_bytes(spark, path[:-4] + ".prj").decode("utf-8", "replace")) or _refuse(path)
    else:  # without a member of its own, a GeoJSON layer is in degrees
        crs = spark.read.schema("crs struct<properties: struct<name: string>>").option("multiLine", True).json(path).first()["crs"]
        name = crs["properties"]["name"] if crs and crs["properties"] else None
        return "EPSG:4326" if not name or name.endswith("CRS84") else f"EPSG:{re.findall(r'[0-9]+', name)[-1]}"
    return f"EPSG:{code}" if code and code > 0 else _refuse(path)


def text_crs(text: str) -> str | None:
    """The code that well-known text ends with, else the text itself where it defines a system that is known here."""
    from ..operators import projection

    if found := re.search(r'(?:AUTHORITY|ID)\["(\w+)",\s*"?(\d+)"?\]\s*\]\s*$', text):
        return ":".join(found.groups())
    try:
        projection.from_text(text)
    except (ValueError, IndexError, TypeError):
        return None
    return " ".join(text.split())


def _encoding(declared: bytes, mark: int) -> str:
    """How a table's texts are written: by the file beside it (``.cpg``), else by the table's own mark, else UTF-8."""
    name = declared.decode("ascii", "replace").strip().lower()
    digits = re.sub(r"^(ansi|cp|windows-?|oem)\s*", "", name)
    name = {"utf-8": "utf-8", "utf8": "utf-8", "65001": "utf-8", "88591": "latin-1", "iso-8859-1": "latin-1", "iso8859-1": "latin-1"}.get(name, f"cp{digits}" if digits.isdigit() else name)
    try:
        return codecs.lookup(name).name if name else {0x57: "cp1252", 0x03: "cp1252", 0x02: "cp850", 0x01: "cp437"}.get(mark, "utf-8")
    except LookupError:
        return "utf-8"


def _text(raw: bytes, encoding: str) -> str:
    """A table's text; where it is not written as told, each byte is a letter of Latin-1, so that none is lost."""
    try:
        return raw.decode(encoding).strip("\0 ")
    except UnicodeDecodeError:
        return raw.decode("latin-1").strip("\0 ")


def _refuse(path: str) -> str:
    raise ValueError(f"{path} has no coordinate system")


def _first_text(zones: DataFrame, columns: list[str]) -> str:
    """The first column whose values are not all numbers; without one, zones have no name."""
    value = lambda c: F.col("properties")[c]
    texts = zones.agg(*[F.coalesce(F.bool_or((F.trim(value(c)) != "") & value(c).try_cast("double").isNull()), F.lit(False)).alias(f"t{i}") for i, c in enumerate(columns)]).first()
    found = next((c for i, c in enumerate(columns) if texts[f"t{i}"]), None)
    if found is None:
        raise ValueError("no text column names the zones")
    return found


def read_layer(spark: SparkSession, path: str, name: str | None = None, crs: str | None = None) -> DataFrame:
    """Zones of a layer by its kind, named by ``name`` or a usual column, in ``crs`` if one is asked for."""
    reader = read_geopackage if path.endswith(".gpkg") else read_shapefile if path.endswith(".shp") else read_geojson
    from ..operators import spatial

    source = layer_crs(spark, path)
    zones = reader(spark, path, name)
    if name is None:
        first = zones.first()
        columns = list(first["properties"]) if first else []
        if not columns:
            raise ValueError("no column names the zones")
        chosen = next((c for c in spatial.NAME_COLUMNS if c in columns), None) or _first_text(zones, columns)
        zones = zones.withColumn("zone_name", F.col("properties")[chosen])
    return spatial.transform(zones, source, crs) if crs else zones
