"""Columns of single pixels: quality bits, calibration, indices.  Out of range always becomes null, never the bound."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import KELVIN, SR_OFFSET, SR_SCALE, ST_OFFSET, ST_SCALE, Settings


def bit(qa: Column, n: int) -> Column:
    return F.shiftright(qa, n).bitwiseAND(F.lit(1))


def is_clear(qa: Column, settings: Settings) -> Column:
    """True where none of the masked bits is set; null for a null word."""
    return qa.bitwiseAND(F.lit(settings.qa_mask)) == 0


def masked(value: Column, clear: Column) -> Column:
    return F.when(clear, value)


def within(value: Column, low: float | Column, high: float | Column) -> Column:
    return F.when(value.between(low, high), value)


def reflectance(dn: Column, scale: Column | float = SR_SCALE, offset: Column | float = SR_OFFSET) -> Column:
    """Surface reflectance in 0 to 1; a digital number of 0 is fill."""
    scale, offset = _col(scale), _col(offset)
    return within(F.nullif(dn, F.lit(0)) * scale + offset, 0.0, 1.0)


def ndvi_raw(red: Column, nir: Column) -> Column:
    return F.try_divide(nir - red, nir + red)


def ndvi(red: Column, nir: Column, settings: Settings) -> Column:
    return within(ndvi_raw(red, nir), settings.ndvi_min, settings.ndvi_max)


def sentinel_dn(settings: Settings, scale: Column | float = ST_SCALE, offset: Column | float = ST_OFFSET) -> Column:
    """The digital number of the lowest accepted temperature, from the scene's own factors."""
    return (F.lit(settings.lst_min) + KELVIN - _col(offset)) / _col(scale)


def celsius(dn: Column, scale: Column | float = ST_SCALE, offset: Column | float = ST_OFFSET) -> Column:
    return dn * _col(scale) + _col(offset) - KELVIN


def lst(dn: Column, settings: Settings, scale: Column | float = ST_SCALE, offset: Column | float = ST_OFFSET) -> Column:
    """Surface temperature: numbers below the sentinel are dropped, then values outside the bounds."""
    kept = F.when(dn >= sentinel_dn(settings, scale, offset), dn)
    return within(celsius(kept, scale, offset), settings.lst_min, settings.lst_max)


def at_bound(value: Column, settings: Settings) -> Column:
    near_low = F.abs(value - settings.lst_min) < settings.bound_width
    return near_low | (F.abs(value - settings.lst_max) < settings.bound_width)


def deviates(value: Column, expected: float) -> Column:
    """A metadata factor that differs from the collection's constant."""
    return F.abs(value - expected) > 1e-8


def resolution_differs(resolution: Column, settings: Settings) -> Column:
    return F.abs(F.round(resolution, 0) - settings.expected_resolution) > 0.5


def _col(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(x)
