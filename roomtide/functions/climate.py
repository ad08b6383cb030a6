"""Indoor-climate scalars."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def voc_co2_ratio(voc: Column | str = "VOC", co2: Column | str = "CO2") -> Column:
    """VOC / CO2 to four digits; VOC itself where the ratio is undefined."""
    voc = F.col(voc) if isinstance(voc, str) else voc
    co2 = F.col(co2) if isinstance(co2, str) else co2
    return F.coalesce(F.bround(F.try_divide(voc, co2), 4), voc.cast("double"))


def air_quality_level(co2: Column | str = "CO2") -> Column:
    """Traffic-light level of a CO2 concentration in ppm."""
    co2 = F.col(co2) if isinstance(co2, str) else co2
    return (
        F.when(co2 < 850, "green")
        .when(co2 < 1200, "yellow")
        .when(co2 < 1600, "red")
        .when(co2 >= 1600, "red_blinking")
    )
