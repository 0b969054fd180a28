"""Scene metadata from sectioned text or JSON, with the collection's constants behind them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import SR_OFFSET, SR_SCALE, ST_OFFSET, ST_SCALE
from ..functions.pixels import deviates

# Sections and keys of the metadata, in the order in which they are tried (it differs by source).
REFLECTANCE, TEMPERATURE, IMAGE = "LEVEL2_SURFACE_REFLECTANCE_PARAMETERS", "LEVEL2_SURFACE_TEMPERATURE_PARAMETERS", "IMAGE_ATTRIBUTES"
TEXT_KEYS = {
    "sr_scale": [(REFLECTANCE, "REFLECTANCE_MULT_BAND_3"), (REFLECTANCE, "REFLECTANCE_MULT_BAND_4")],
    "sr_offset": [(REFLECTANCE, "REFLECTANCE_ADD_BAND_3"), (REFLECTANCE, "REFLECTANCE_ADD_BAND_4")],
    "st_scale": [(TEMPERATURE, "TEMPERATURE_MULT_BAND_ST_B6"), (TEMPERATURE, "TEMPERATURE_MULT_BAND_ST_B10")],
    "st_offset": [(TEMPERATURE, "TEMPERATURE_ADD_BAND_ST_B6"), (TEMPERATURE, "TEMPERATURE_ADD_BAND_ST_B10")],
    "cloud_cover": [(IMAGE, "CLOUD_COVER")],
    "sun_elevation": [(IMAGE, "SUN_ELEVATION")],
}
JSON_KEYS = {
    "sr_scale": [(REFLECTANCE, "REFLECTANCE_MULT_BAND_4"), (REFLECTANCE, "REFLECTANCE_MULT_BAND_3")],
    "sr_offset": [(REFLECTANCE, "REFLECTANCE_ADD_BAND_4"), (REFLECTANCE, "REFLECTANCE_ADD_BAND_3")],
    "st_scale": [(TEMPERATURE, "TEMPERATURE_MULT_BAND_ST_B10"), (TEMPERATURE, "TEMPERATURE_MULT_BAND_ST_B6")],
    "st_offset": [(TEMPERATURE, "TEMPERATURE_ADD_BAND_ST_B10"), (TEMPERATURE, "TEMPERATURE_ADD_BAND_ST_B6")],
    "cloud_cover": [(IMAGE, "CLOUD_COVER")],
    "sun_elevation": [(IMAGE, "SUN_ELEVATION")],
}
CONSTANTS = {"sr_scale": SR_SCALE, "sr_offset": SR_OFFSET, "st_scale": ST_SCALE, "st_offset": ST_OFFSET}


def section(text: Column, name: str) -> Column:
    """What stands between a section's first and last line."""
    return F.regexp_extract(text, rf"(?ms)^\s*GROUP\s*=\s*{name}\s*$(.*?)^\s*END_GROUP\s*=\s*{name}\s*$", 1)


def text_value(text: Column, name: str, key: str) -> Column:
    raw = F.regexp_extract(section(text, name), rf"(?m)^\s*{key}\s*=\s*(.*?)\s*$", 1)
    return F.regexp_replace(raw, '"', "").try_cast("double")


def json_value(text: Column, name: str, key: str) -> Column:
    """With or without the enclosing root."""
    return F.coalesce(*[F.get_json_object(text, f"$.{root}{name}.{key}").try_cast("double") for root in ("LANDSAT_METADATA_FILE.", "")])


def parse_text(text: Column) -> dict[str, Column]:
    return {n: F.coalesce(*[text_value(text, *k) for k in keys]) for n, keys in TEXT_KEYS.items()}


def parse_json(text: Column) -> dict[str, Column]:
    return {n: F.coalesce(*[json_value(text, *k) for k in keys]) for n, keys in JSON_KEYS.items()}


def factors(df: DataFrame, mtl_text: str | None = "mtl_text", mtl_json: str | None = "mtl_json") -> DataFrame:
    """Adds the factors and attributes, and which factors differ from the constants.

    One source is taken whole: the text if there is one, else the JSON if it can be read; what it lacks is a constant.
    ``mtl_source`` names it, and is null without any; ``mtl_ok`` tells whether there was one.
    """
    sources = {"txt": (F.col(mtl_text).isNotNull(), parse_text(F.col(mtl_text)))} if mtl_text else {}
    sources |= {"json": (F.get_json_object(mtl_json, "$").isNotNull(), parse_json(F.col(mtl_json)))} if mtl_json else {}
    out = df.withColumn("mtl_source", F.coalesce(F.lit(None).cast("string"), *[F.when(there, F.lit(name)) for name, (there, _) in sources.items()]))
    out = out.withColumn("mtl_ok", F.col("mtl_source").isNotNull())
    for column in TEXT_KEYS:
        found = [F.when(F.col("mtl_source") == name, values[column]) for name, (_, values) in sources.items()]
        out = out.withColumn(column, F.coalesce(*found, F.lit(CONSTANTS.get(column)).cast("double")))
    return out.withColumns({f"{n}_differs": deviates(F.col(n), c) for n, c in CONSTANTS.items()})
