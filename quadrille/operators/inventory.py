"""From scene ids to an inventory, with the reason for each scene that is left out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Settings
from ..functions import scene as S


def decode(scenes: DataFrame, scene_id: str = "scene_id") -> DataFrame:
    """Parts of the scene ids.

    They are generated as a row of their own: else the optimiser would put the whole decoding into every filter and
    column that names a part, and do it again for each.
    """
    c = F.col(scene_id)
    parts = F.struct(S.prefix(c).alias("sensor_prefix"), S.path_row(c).alias("pathrow"), S.acquired(c).alias("acq_date"), S.tier(c).alias("tier"))
    out = scenes.select("*", F.inline(F.array(parts)))
    p = F.col("sensor_prefix")
    bands = {"tag_red": S.band(p, "red"), "tag_nir": S.band(p, "nir"), "tag_thermal": S.band(p, "thermal")}
    return out.withColumns({"sensor": S.sensor(p), "year": F.year("acq_date"), "month": F.month("acq_date"), **bands})


def audit(decoded: DataFrame, settings: Settings, scene_id: str = "scene_id") -> DataFrame:
    """Adds ``outcome``: the first filter that a scene fails, or ``kept``."""
    why = F.when(~F.coalesce(S.is_scene(F.col(scene_id)), F.lit(False)), "name").when(F.col("acq_date").isNull(), "date")
    why = why.when(~F.col("year").between(settings.year_start, settings.year_end), "period")
    if settings.months is not None:
        why = why.when(~F.col("month").isin(*settings.months), "month")
    if settings.tiers is not None:
        why = why.when(~F.coalesce(F.col("tier").isin(*settings.tiers), F.lit(False)), "tier")
    return decoded.withColumn("outcome", why.otherwise("kept"))


def inventory(scenes: DataFrame, settings: Settings, scene_id: str = "scene_id") -> DataFrame:
    """Scenes that pass every filter.  The filters judge parts of the name, so they run behind the scan, before any join."""
    return audit(decode(scenes, scene_id), settings, scene_id).where("outcome = 'kept'").drop("outcome")


def is_complete(*files: str) -> Column:
    out = F.lit(True)
    for f in files:
        out = out & F.col(f).isNotNull()
    return out


def without_files(df: DataFrame) -> DataFrame:
    """The inventory without its path columns, as it is exported."""
    return df.drop(*[c for c in df.columns if c.startswith("file_")])
