"""Roles of coordinates and the shape of extents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fathom.functions.units import of_pressure, with_dimension

# Names and units that tell a coordinate's role.
NAMED_ROLES = ("latitude", "longitude", "depth", "time")
LATITUDE_UNITS = (
    "degrees_north", "degree_north", "degree_N", "degrees_N", "degreeN", "degreesN",
)
LONGITUDE_UNITS = (
    "degrees_east", "degree_east", "degree_E", "degrees_E", "degreeE", "degreesE",
)
TIME_REFERENCE = (
    r"(?i)^\s*(microsecond|millisecond|second|sec|s|minute|min|hour|hr|h|day|d|week|month|year)s?"
    r"\s+since\s+\S"
)
# End of fixed values.


def attribute(attrs: Column, name: str) -> Column:
    position = F.nullif(F.array_position(attrs["name"], name), F.lit(0).cast("bigint"))
    return F.get(attrs["value"], (position - 1).cast("int"))


def classify_coord(
    standard_name: Column, units: Column, positive: Column, dtype: Column
) -> Column:
    """``latitude``, ``longitude``, ``time``, ``depth`` or ``other``.

    The standard name decides; then angular units; then a time type or ``... since ...``
    units; then any unit of pressure or a vertical direction, except for air and stress. A text
    that is no unit makes the role ``other``, whatever the direction.
    """
    name = F.lower(F.coalesce(standard_name, F.lit("")))
    foreign = name.contains("air") | name.contains("stress")
    vertical = F.coalesce(F.lower(positive).isin("up", "down"), F.lit(False))

    def measured(powers: Column) -> Column:
        return F.when(powers.isNotNull() & (vertical | of_pressure(powers)) & ~foreign, "depth").otherwise("other")

    return (
        F.when(name.isin(*NAMED_ROLES), name)
        .when(units.isin(*LATITUDE_UNITS), "latitude")
        .when(units.isin(*LONGITUDE_UNITS), "longitude")
        .when(dtype.startswith("datetime64") | units.rlike(TIME_REFERENCE), "time")
        .when(units.isNull(), F.when(vertical & ~foreign, "depth").otherwise("other"))
        .otherwise(with_dimension(units, measured))
    )


def variable_role(variable: Column) -> Column:
    attrs = variable["attrs"]
    return classify_coord(
        attribute(attrs, "standard_name"),
        attribute(attrs, "units"),
        attribute(attrs, "positive"),
        variable["dtype"],
    )


def bbox(west: Column, south: Column, east: Column, north: Column) -> Column:
    """``[west, south, east, north]``; null when a side is unknown."""
    known = west.isNotNull() & south.isNotNull() & east.isNotNull() & north.isNotNull()
    return F.when(known, F.array(west, south, east, north))


def geometry(west: Column, south: Column, east: Column, north: Column) -> Column:
    """Point where the box is one place, else its closed ring, as type and coordinates."""
    at = F.array(west, south)
    ring = F.array(
        at, F.array(east, south), F.array(east, north), F.array(west, north), F.array(west, south)
    )
    is_point = (west == east) & (south == north)
    return F.struct(
        F.when(is_point, "Point").when(~is_point, "Polygon").alias("type"),
        F.when(is_point, F.array(at)).when(~is_point, ring).alias("coordinates"),
    )


def time_range(start: Column, end: Column) -> Column:
    """A single instant, or a start and an end."""
    single = start == end
    return F.struct(
        F.when(single, start).alias("datetime"),
        F.when(~single, start).alias("start_datetime"),
        F.when(~single, end).alias("end_datetime"),
    )
