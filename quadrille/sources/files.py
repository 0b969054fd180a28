"""Scene folders, delimited tables and result folders."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SENSORS

# Spellings of the columns of result tables, by the name used here; the first that a table has counts.
ALIASES = {
    "year": ("year", "ano"),
    "month": ("month", "mes"),
    "zone_id": ("zone_id", "bairro_id", "id_bairro"),
    "zone_name": ("zone_name", "nome_bairro", "bairro", "BAIRRO", "NOME", "Nome", "nome", "NM_BAIRRO", "Bairro_Limpo"),
    "ndvi_mean": ("ndvi_mean", "ndvi_media"),
    "ndvi_sd": ("ndvi_sd", "ndvi_dp"),
    "ndvi_min": ("ndvi_min",),
    "ndvi_max": ("ndvi_max",),
    "ndvi_n": ("ndvi_n",),
    "lst_mean": ("lst_mean", "lst_c_mean", "lst_c_media", "lst_media"),
    "lst_sd": ("lst_sd", "lst_c_sd", "lst_c_dp"),
    "lst_min": ("lst_min", "lst_c_min"),
    "lst_max": ("lst_max", "lst_c_max"),
    "lst_n": ("lst_n", "lst_c_n"),
    "n_scenes": ("n_scenes", "n_cenas"),
    "sensors_used": ("sensors_used", "sensores_usados"),
}


LOG = logging.getLogger("quadrille")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, in whatever store it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def scene_files(spark: SparkSession, folders: Iterable[str]) -> DataFrame:
    """``group, scene_dir, scene_id, path`` of every file in the scene folders below ``folders``.

    Only paths are projected, so file contents are not read.  A folder that is not there is skipped with a warning;
    without any there is an error.
    """
    out = None
    for folder in folders:
        if not exists(spark, folder):
            LOG.warning("no folder %s", folder)
            continue
        listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
        part = listing.select(F.lit(folder.rstrip("/").rsplit("/", 1)[-1]).alias("group"), F.regexp_extract("path", r"^(.*)/[^/]+$", 1).alias("scene_dir"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("scene_id"), "path")
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("no scene folders")
    return out


def bands(files: DataFrame) -> DataFrame:
    """A row a scene with its band files and metadata files; missing ones are null.  One aggregation, no join."""
    name = F.lower(F.regexp_extract("path", r"([^/]+)$", 1))
    prefix = F.split("scene_id", "_")[0]

    def file(role: str):
        tag = F.try_element_at(F.create_map(*[F.lit(x) for k, s in SENSORS.items() for x in (k, getattr(s, role))]), prefix)
        return F.min(F.when(name == F.lower(F.concat(F.col("scene_id"), F.lit("_"), tag, F.lit(".tif"))), F.col("path")))

    return files.groupBy("group", "scene_dir", "scene_id").agg(
        F.min(F.when(name == F.lower(F.concat("scene_id", F.lit("_qa_pixel.tif"))), F.col("path"))).alias("file_qa"),
        file("red").alias("file_red"),
        file("nir").alias("file_nir"),
        file("thermal").alias("file_lst"),
        F.min(F.when(name.endswith("_mtl.txt"), F.col("path"))).alias("file_mtl_txt"),
        F.min(F.when(name.endswith("_mtl.json"), F.col("path"))).alias("file_mtl_json"),
    )


def header(spark: SparkSession, path: str) -> str:
    rows = spark.read.text(path).limit(1).collect()
    return rows[0]["value"] if rows else ""


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV whose header tells the separator; with ``;`` numbers carry decimal commas.  ``NA`` and blanks are null."""
    semicolon = ";" in header(spark, path)
    df = spark.read.options(header=True, sep=";" if semicolon else ",", nullValue="NA").csv(path)
    texts = [F.regexp_replace(F.col(f"`{c}`"), ",", ".") if semicolon else F.col(f"`{c}`") for c in df.columns]
    counts = []  # values that are there, and how many of them are no whole numbers and no numbers: judged by all rows
    for i, t in enumerate(texts):
        there = F.trim(t) != ""
        suffixed = t.rlike(r"[0-9.][dDfF]\s*$")  # a cast takes 1d and 1f for numbers
        counts += [F.count_if(there).alias(f"n{i}"), F.count_if(there & t.try_cast("long").isNull()).alias(f"l{i}"), F.count_if(there & (t.try_cast("double").isNull() | suffixed)).alias(f"d{i}")]
    seen = df.agg(*counts).first() if counts else None
    out = []
    for i, (c, t) in enumerate(zip(df.columns, texts, strict=True)):
        kind = None if not seen[f"n{i}"] else "long" if not seen[f"l{i}"] else "double" if not seen[f"d{i}"] else None
        out.append(t.try_cast(kind).alias(c) if kind else F.col(f"`{c}`"))
    return df.select(*out)


def numeric(df: DataFrame) -> DataFrame:
    """All columns as numbers, decimal commas too; what is none becomes null."""
    return df.select(*[F.regexp_replace(F.col(c).cast("string"), ",", ".").try_cast("double").alias(c) for c in df.columns])


#: Words by which the columns of a climate table are told, in the order in which they are tried.
TEMPERATURES = {"temp": (("mean", "med", "avg", "méd"), ("temp", "tmp", "tair")), "temp_min": (("min",),), "temp_max": (("max",),)}


def climate_table(df: DataFrame, temperature: str | None = None, minimum: str | None = None, maximum: str | None = None) -> DataFrame:
    """``ano, mes, temp, temp_min, temp_max`` from a table whose first two columns are year and month.

    Each temperature is the column named, else the first whose name speaks of it (the mean: else of a temperature that
    is neither lowest nor highest).  The mean must be there; a lowest or highest that is not is null.
    """
    rest, named, found = df.columns[2:], {"temp": temperature, "temp_min": minimum, "temp_max": maximum}, {}
    for target, groups in TEMPERATURES.items():
        if named[target] is not None and named[target] not in rest:
            raise ValueError(f"no column {named[target]} among {rest}")
        free = [c for c in rest if target != "temp" or not any(w in c.lower() for w in ("min", "max"))]
        found[target] = named[target] or next((c for words in groups for c in free if any(w in c.lower() for w in words)), None)
    if found["temp"] is None:
        raise ValueError(f"no temperature column among {rest}")
    n = numeric(df)
    values = [F.col(c).alias(t) if c else F.lit(None).cast("double").alias(t) for t, c in found.items()]
    return n.select(F.col(df.columns[0]).cast("int").alias("ano"), F.col(df.columns[1]).cast("int").alias("mes"), *values)


def normalise(df: DataFrame) -> DataFrame:
    """Columns under their own names; a name that is there already stays."""
    names = {}
    for target, spellings in ALIASES.items():
        if target not in df.columns and (found := next((s for s in spellings if s in df.columns), None)):
            names[found] = target
    return df.withColumnsRenamed(names)


def find_table(headers: dict[str, Sequence[str]], required: Sequence[Sequence[str]], prefer: str | None = None, forbid: Sequence[str] = ()) -> str | None:
    """The first path whose header has a name of each group and none that is forbidden; preferred paths come first."""
    paths = sorted(headers, key=lambda p: (prefer is None or prefer not in p))
    for p in paths:
        have = set(headers[p])
        if all(have & set(group) for group in required) and not have & set(forbid):
            return p
    return None


def tables_below(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Headers of all CSV files below a folder of results, by path; their contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").load(folder)
    out = {}
    for path in sorted(r["path"] for r in listing.select("path").collect()):
        first = header(spark, path)
        out[path] = [c.strip().strip('"') for c in first.split(";" if ";" in first else ",")]
    return out


def _loaded(spark: SparkSession, folder: str, required: Sequence[Sequence[str]], prefer: str, forbid: Sequence[str]) -> DataFrame:
    path = find_table(tables_below(spark, folder), required, prefer, forbid)
    if path is None:
        raise ValueError(f"no table below {folder} has columns {[g[0] for g in required]}")
    return normalise(read_table(spark, path))


#: Groups of names of which a monthly table must have one each.
MONTHLY = (ALIASES["year"], ALIASES["month"], ALIASES["lst_mean"], ALIASES["ndvi_mean"])


def load_city(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly table of the area: the one without zones."""
    return _loaded(spark, folder, MONTHLY, "monthly", ALIASES["zone_name"])


def load_zones(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly table of the zones, numbered by name if it has no ids."""
    return with_zone_ids(_loaded(spark, folder, (*MONTHLY, ALIASES["zone_name"]), "zone", ()))


def read_excel(spark: SparkSession, path: str, sheet: str | int = 0) -> DataFrame:
    """A spreadsheet of a few thousand rows, read on the driver; needs a library that reads the format."""
    import io

    import pandas as pd

    body = spark.read.format("binaryFile").load(path).select("content").first()["content"]
    try:
        frame = pd.read_excel(io.BytesIO(bytes(body)), sheet_name=sheet, dtype=str)
    except ImportError as e:
        raise ImportError("spreadsheets need openpyxl; save the table as CSV instead") from e
    return spark.createDataFrame(frame.astype(object).where(frame.notna(), None), ", ".join(f"`{c}` string" for c in frame.columns))


def raster_suffix(name: str, scene_ids: Iterable[str]) -> str | None:
    """What a raster's file name has behind the longest scene id that it begins with."""
    found = max((i for i in scene_ids if name.startswith(i)), key=len, default=None)
    return None if found is None else name[len(found) :]


def find_results(spark: SparkSession, roots: Iterable[str], depth: int = 2) -> str | None:
    """The first folder with result tables: a root or a folder up to ``depth`` levels below one, breadth first.

    A folder has tables where a sub-folder of either usual name is there, or a CSV file in itself.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    level = [r for r in roots if exists(spark, r)]
    for _ in range(depth + 1):
        below = []
        for folder in level:
            at = jvm.org.apache.hadoop.fs.Path(folder)
            entries = sorted((e.getPath().toString(), e.isDirectory()) for e in at.getFileSystem(conf).listStatus(at))
            names = {p.rsplit("/", 1)[-1]: p for p, is_folder in entries if is_folder}
            for sub in ("tables", "tabelas"):
                if sub in names:
                    return names[sub]
            if any(p.lower().endswith(".csv") for p, is_folder in entries if not is_folder):
                return folder
            below += [p for name, p in names.items() if not name.startswith((".", "_"))]
        level = below
    return None


def with_zone_ids(zone_months: DataFrame) -> DataFrame:
    """Zones numbered in the order of their names, where a table has no ids."""
    if "zone_id" in zone_months.columns:
        return zone_months
    from pyspark.sql.window import Window

    names = zone_months.select("zone_name").distinct()
    ids = names.withColumn("zone_id", F.row_number().over(Window.orderBy("zone_name")))  # as many rows as zones
    return zone_months.join(ids, "zone_name")
