"""Area units."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col, trim_upper


def area_km2(area, unit) -> Column:
    """Area in square kilometres from KM2, HA or M2; null for any other unit."""
    area, unit = _col(area), trim_upper(unit)
    return (
        F.when(unit == "KM2", area)
        .when(unit == "HA", area / 100)
        .when(unit == "M2", area / 1_000_000)
    )
