"""Station-name expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from railpulse.constants import RECORD_TYPE_TERMINAL, RECORD_TYPES_ORIGIN

# Records that name a station.
STATION_RECORD_TYPES = (*RECORD_TYPES_ORIGIN, RECORD_TYPE_TERMINAL)

# Leading or trailing white space. (?U) switches Java's \s to Unicode white
# space, so tabs, newlines and no-break spaces go too, not only blanks.
_EDGE_SPACE = r"(?U)^\s+|\s+$"


def clean_name(name: Column | str) -> Column:
    """Remove every double quote, then strip surrounding white space.

    A name made only of quotes and blanks becomes the empty string; it is
    not turned into NULL (callers decide what to do with it)."""
    c = F.col(name) if isinstance(name, str) else name
    return F.regexp_replace(F.regexp_replace(c, '"', ""), _EDGE_SPACE, "")


def station_of_record(record_type: Column | str = "record_type",
                      origin: Column | str = "origin",
                      destination: Column | str = "destination") -> Column:
    """The station a raw record reports on: departure and intermediate stops
    name their origin, the final section names its destination, plain
    sections and unknown types name none (NULL)."""
    rt = F.col(record_type) if isinstance(record_type, str) else record_type
    o = F.col(origin) if isinstance(origin, str) else origin
    d = F.col(destination) if isinstance(destination, str) else destination
    return (F.when(rt.isin(*RECORD_TYPES_ORIGIN), o)
             .when(rt == F.lit(RECORD_TYPE_TERMINAL), d))
