"""Columns read off scene ids, dates, sensors and periods."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import SCENE_ID, SENSORS, Settings


def is_scene(scene_id: Column) -> Column:
    return scene_id.rlike(SCENE_ID)


def id_part(scene_id: Column, n: int) -> Column:
    """The ``n``-th part between underscores; null if there are fewer."""
    return F.try_element_at(F.split(scene_id, "_"), F.lit(n))


def prefix(scene_id: Column) -> Column:
    return id_part(scene_id, 1)


def path_row(scene_id: Column) -> Column:
    return id_part(scene_id, 3)


def acquired(scene_id: Column) -> Column:
    """Date of acquisition; null where it is not a date."""
    return F.try_to_timestamp(id_part(scene_id, 4), F.lit("yyyyMMdd")).cast("date")


def tier(scene_id: Column) -> Column:
    return id_part(scene_id, 7)


def _lookup(key: Column, values: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def sensor(prefix_: Column) -> Column:
    return _lookup(prefix_, {k: s.name for k, s in SENSORS.items()})


def band(prefix_: Column, role: str) -> Column:
    """Band tag for ``red``, ``nir`` or ``thermal``."""
    return _lookup(prefix_, {k: getattr(s, role) for k, s in SENSORS.items()})


def short_sensor(name: Column) -> Column:
    return F.regexp_replace(name, "Landsat", "L")


def generation(name: Column) -> Column:
    """The digits in a sensor's name; 99 without any."""
    return F.coalesce(F.regexp_replace(name, "[^0-9]", "").try_cast("int"), F.lit(99))


def month_name(date: Column) -> Column:
    return F.date_format(date, "MMMM")


def mid_month(year: Column, month: Column) -> Column:
    return F.make_date(year, month, F.lit(15))


def period(year: Column, month: Column | None = None) -> Column:
    return F.format_string("%04d", year) if month is None else F.format_string("%04d-%02d", year, month)


def decimal_year(year: Column, month: Column) -> Column:
    return year + (month - 1) / F.lit(12.0)


def season(month: Column, settings: Settings) -> Column:
    """Season of a month by hemisphere; null where none is set."""
    if settings.hemisphere is None:
        return F.lit(None).cast("string")
    names = ("Summer", "Autumn", "Winter", "Spring") if settings.hemisphere == "south" else ("Winter", "Spring", "Summer", "Autumn")
    return F.element_at(F.array(*[F.lit(names[m % 12 // 3]) for m in range(1, 13)]), month)


def low_quality(year: Column, month: Column, settings: Settings) -> Column:
    """Whether the month is on the list of months of low quality."""
    out = F.lit(False)
    for y, m, _ in settings.low_quality:
        out = out | ((year == y) & (month == m))
    return out


def pair_label(a: Column, b: Column) -> Column:
    """``La vs Lb`` with the names in order."""
    return F.concat_ws(" vs ", F.least(short_sensor(a), short_sensor(b)), F.greatest(short_sensor(a), short_sensor(b)))
