"""Weather flag and predicate expressions.

Flags are INT 0/1 because the warehouse SQL compares them with ``= 1``. A
NULL measurement gives a NULL flag (three-valued), never a silent 0."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from railpulse.constants import PRECIP_HIGH_MM, TEMP_HIGH_C, TEMP_LOW_C, WIND_HIGH_KMH


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def high_temp(t: Column | str = "temperature_mean_c", low: float = TEMP_LOW_C,
              high: float = TEMP_HIGH_C) -> Column:
    c = _col(t)
    return ((c < F.lit(low)) | (c > F.lit(high))).cast("int")


def high_wind(w: Column | str = "wind_gust_max_kmh", limit: float = WIND_HIGH_KMH) -> Column:
    return (_col(w) > F.lit(limit)).cast("int")


def high_precip(p: Column | str = "precipitation_sum_mm", limit: float = PRECIP_HIGH_MM) -> Column:
    return (_col(p) > F.lit(limit)).cast("int")


def any_extreme(prefix: str = "high_") -> Column:
    """At least one flag set; NULL when no flag is 1 and some flag is NULL."""
    return ((F.col(f"{prefix}temp") == 1) | (F.col(f"{prefix}wind") == 1)
            | (F.col(f"{prefix}precip") == 1))


def calm(prefix: str = "high_") -> Column:
    """All three flags are 0; rows without weather (NULL flags) are not calm."""
    return ((F.col(f"{prefix}temp") == 0) & (F.col(f"{prefix}wind") == 0)
            & (F.col(f"{prefix}precip") == 0))


def parse_decimal_comma(c: Column | str) -> Column:
    """Text such as ' 38,2' -> 38.2; malformed text -> NULL."""
    return F.regexp_replace(F.trim(_col(c)), ",", ".").try_cast("double")
