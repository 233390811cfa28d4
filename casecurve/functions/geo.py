"""Map placement expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from casecurve.functions.numbers import half_up

# Map extent in degrees, canvas size and padding in pixels.
LON_RANGE = (60.5, 77.8)
LAT_RANGE = (23.4, 37.4)
CANVAS = (900, 800)
PADDING = (40, 35)
# Marker radius by grade, and the bound of the case bonus.
RADIUS_CRITICAL, RADIUS_ALERT, RADIUS_OTHER, RADIUS_BONUS_MAX = 15, 12, 9, 8


def map_x(lon: Column) -> Column:
    low, high = LON_RANGE
    width = CANVAS[0] - 2 * PADDING[0]
    return half_up(PADDING[0] + (lon - low) / (high - low) * width, 1)


def map_y(lat: Column) -> Column:
    low, high = LAT_RANGE
    height = CANVAS[1] - 2 * PADDING[1]
    return half_up(PADDING[1] + (high - lat) / (high - low) * height, 1)


def marker_radius(grade: Column, cases: Column) -> Column:
    """Base size by grade plus three pixels per decade of cases, within a bound."""
    base = F.when(grade == "Critical", RADIUS_CRITICAL).when(grade == "Alert", RADIUS_ALERT).otherwise(RADIUS_OTHER)
    shown = F.coalesce(F.nullif(cases, F.lit(0)), F.lit(10))
    bonus = F.least(F.lit(float(RADIUS_BONUS_MAX)), F.greatest(F.lit(0.0), F.log10(shown) * 3.0))
    return base + bonus
