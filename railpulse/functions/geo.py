"""Location expressions: point-in-box county, county -> region -> id.

The first-match box search is a CASE chain over the 20 constant boxes: it is
evaluated per row inside codegen with no join and no shuffle. The equivalent
range-join form lives in ``railpulse.operators.stations.assign_county_by_join``.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from railpulse.constants import COUNTY_BOXES, COUNTY_REGION, REGION_COORDINATES, REGION_ID


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def county_of(lat: Column | str, lon: Column | str, boxes=COUNTY_BOXES) -> Column:
    """First county whose closed box contains (lat, lon); NULL outside all."""
    la, lo = _col(lat), _col(lon)
    expr = None
    for name, lat_min, lat_max, lon_min, lon_max in boxes:
        cond = la.between(F.lit(float(lat_min)), F.lit(float(lat_max))) & \
            lo.between(F.lit(float(lon_min)), F.lit(float(lon_max)))
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def _lookup(mapping: dict, key: Column) -> Column:
    m = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(m, key)


def region_of(county: Column | str) -> Column:
    """County -> region; unknown or NULL county gives NULL."""
    return _lookup(COUNTY_REGION, _col(county))


def region_id_of(region: Column | str) -> Column:
    """Region -> id 0..7; unknown or NULL region gives NULL."""
    return _lookup(REGION_ID, _col(region)).cast("int")


def region_name_of(region_id: Column | str) -> Column:
    """Region id (position in the region configuration) -> region name."""
    return _lookup({i: r[0] for i, r in enumerate(REGION_COORDINATES)}, _col(region_id))
