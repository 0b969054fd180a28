"""Settings of a run: one frozen value, checked when made."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Sensor:
    """Bands that carry red, near infrared and thermal for a scene-id prefix."""

    name: str
    red: str
    nir: str
    thermal: str


# The collection's band layout and scale factors.
SENSORS: dict[str, Sensor] = {
    "LC08": Sensor("Landsat8", "SR_B4", "SR_B5", "ST_B10"),
    "LC09": Sensor("Landsat9", "SR_B4", "SR_B5", "ST_B10"),
    "LE07": Sensor("Landsat7", "SR_B3", "SR_B4", "ST_B6"),
    "LT05": Sensor("Landsat5", "SR_B3", "SR_B4", "ST_B6"),
    "LT04": Sensor("Landsat4", "SR_B3", "SR_B4", "ST_B6"),
}
SCENE_ID = r"^(LC08|LC09|LE07|LT05|LT04)_L2SP_"
SR_SCALE, SR_OFFSET = 0.0000275, -0.2
ST_SCALE, ST_OFFSET = 0.00341802, 149.0
KELVIN = 273.15
QA_NAMES = ("fill", "dilated cloud", "cirrus", "cloud", "cloud shadow", "snow", "clear", "water")


@dataclass(frozen=True)
class Settings:
    year_start: int = 2010
    year_end: int = 2025
    months: tuple[int, ...] | None = None
    tiers: tuple[str, ...] | None = ("T1",)
    crs: str = "EPSG:32723"
    ndvi_min: float = -1.0
    ndvi_max: float = 1.0
    lst_min: float = -20.0
    lst_max: float = 75.0
    qa_bits: tuple[int, ...] = (0, 1, 3, 4, 5, 7)
    min_scene_valid: float = 0.10
    min_area_valid: float = 0.10
    min_overlap: float = 0.10
    max_ratio: float = 5.0
    max_at_bound: float = 0.01
    bound_width: float = 0.05
    critical_pct: float = 5.0
    hemisphere: str | None = "south"
    low_quality: tuple[tuple[int, int, str], ...] = ()
    trend_months: int = 24
    zone_months: int = 12
    top_n: int = 10
    pair_zones: int = 10
    zone_column: str | None = None
    expected_resolution: float = 30.0
    notes: tuple[str, ...] = field(default=(), compare=False)

    def __post_init__(self) -> None:
        fatal = [
            (self.year_start > self.year_end, "the first year is after the last"),
            (self.ndvi_min >= self.ndvi_max, "the NDVI bounds are not in order"),
            (self.lst_min >= self.lst_max, "the LST bounds are not in order"),
            (any(not 0 <= b <= 15 for b in self.qa_bits), "a QA bit lies outside 0 to 15"),
            (self.hemisphere not in ("south", "north", None), "the hemisphere is south, north or none"),
        ]
        if wrong := [text for bad, text in fatal if bad]:
            raise ValueError("; ".join(wrong))
        doubtful = [
            (self.months is not None and not set(self.months) <= set(range(1, 13)), "months outside 1 to 12 match nothing"),
            (not self.qa_bits, "no QA bit is masked"),
            (0 not in self.qa_bits, "fill pixels (bit 0) are not masked"),
            (6 in self.qa_bits, "bit 6 marks clear pixels; masking it drops good data"),
            (self.ndvi_min < -1 or self.ndvi_max > 1, "NDVI bounds beyond -1 and 1"),
            (not 0 <= self.min_scene_valid <= 1 or not 0 <= self.min_area_valid <= 1, "valid shares lie between 0 and 1"),
            (self.lst_min < -60 or self.lst_max > 90, "unusual LST bounds"),
        ]
        notes = tuple(text for bad, text in doubtful if bad)
        object.__setattr__(self, "notes", notes)
        for text in notes:
            warnings.warn(text, stacklevel=3)

    @property
    def qa_mask(self) -> int:
        return sum(1 << b for b in self.qa_bits)

    def with_values(self, **values) -> Settings:
        return replace(self, **values)


#: Profiles differ from the defaults in values only.
PROFILES = {
    "coastal": Settings(lst_min=5.0, lst_max=70.0),
    "temperate": Settings(hemisphere="north", lst_min=-30.0, lst_max=60.0),
    "large region": Settings(min_area_valid=0.05, min_overlap=0.05),
}
