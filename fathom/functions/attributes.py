"""Rules over header attributes: name resolution, safe casts, payload text."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fathom.functions.identity import strip


@dataclass(frozen=True)
class MappedField:
    """One structured field: the attribute names it may come from, and whether it is a number."""

    name: str
    aliases: tuple[str, ...]
    numeric: bool = False


# Structured fields taken from global attributes, names by priority.
MAPPED_FIELDS = (
    MappedField("geospatial_lat_min", ("geospatial_lat_min",), True),
    MappedField("geospatial_lat_max", ("geospatial_lat_max",), True),
    MappedField("geospatial_lon_min", ("geospatial_lon_min",), True),
    MappedField("geospatial_lon_max", ("geospatial_lon_max",), True),
    MappedField("geospatial_vertical_min", ("geospatial_vertical_min",), True),
    MappedField("geospatial_vertical_max", ("geospatial_vertical_max",), True),
    MappedField("geospatial_vertical_positive", ("geospatial_vertical_positive",)),
    MappedField("time_coverage_start", ("time_coverage_start",)),
    MappedField("time_coverage_end", ("time_coverage_end",)),
    MappedField("date_created", ("date_created",)),
    MappedField("keywords", ("keywords",)),
    MappedField("conventions", ("Conventions", "conventions")),
    MappedField("file_version", ("file_version",)),
    MappedField("metadata_uuid", ("metadata_uuid",)),
    MappedField("platform_code", ("platform_code",)),
    MappedField("site_code", ("site_code",)),
    MappedField("deployment_code", ("deployment_code",)),
    MappedField("instrument", ("instrument",)),
    MappedField("instrument_nominal_depth", ("instrument_nominal_depth",), True),
    MappedField("feature_type", ("featureType", "feature_type")),
    MappedField(
        "instrument_serial_number", ("instrument_serial_number", "instrumentSerialNumber")
    ),
)
# End of fixed values.

# What reads as a number: digits may be grouped by single underscores, and the special
# values are spelled out. A Spark cast alone would also take suffixed text such as "12d".
_NUMBER = (
    r"(?i)^[+-]?(?:(?:\d+(?:_\d+)*\.?(?:\d+(?:_\d+)*)?|\.\d+(?:_\d+)*)(?:e[+-]?\d+(?:_\d+)*)?"
    r"|inf(?:inity)?|nan)$"
)


def normalize_name(name: Column) -> Column:
    """Lower case without underscores and hyphens."""
    return F.translate(F.lower(name), "_-", "")


def _spelling(field: MappedField) -> str:
    """The normalized name that all names of a field share."""
    forms = {a.lower().replace("_", "").replace("-", "") for a in field.aliases}
    if len(forms) != 1:
        raise ValueError(f"names of {field.name} differ in more than case and separators")
    return forms.pop()


def best_by_name(attrs: Column) -> Column:
    """Map from normalized name to the value of the attribute that counts.

    An exact name of a mapped field wins, in order of priority; otherwise the first attribute
    of the file does. Only files in which two names are alike need that order; for the others
    the names already are the keys. One map serves all fields with one look-up each.
    """
    names = F.transform(attrs, lambda a: F.coalesce(normalize_name(a["name"]), F.lit("")))
    rank = F.create_map(
        *[F.lit(x) for f in MAPPED_FIELDS for i, a in enumerate(f.aliases) for x in (a, i)]
    )
    last = max(len(f.aliases) for f in MAPPED_FIELDS)

    def candidate(a: Column, i: Column) -> Column:
        return F.struct(
            F.coalesce(normalize_name(a["name"]), F.lit("")).alias("key"),
            F.coalesce(F.element_at(rank, F.coalesce(a["name"], F.lit(""))), F.lit(last)),
            i,
            a["value"].alias("value"),
        )

    ordered = F.sort_array(F.transform(attrs, candidate))
    first = F.filter(
        ordered, lambda c, i: (i == 0) | (F.get(ordered["key"], i - 1) != c["key"])
    )
    chosen = F.map_from_arrays(first["key"], first["value"])
    return F.when(repeats(names), chosen).otherwise(F.map_from_arrays(names, attrs["value"]))


def mapped_value(by_name: Column, field: MappedField) -> Column:
    """Value of a structured field out of ``best_by_name``; null when there is none."""
    return by_name[_spelling(field)]


def to_number(text: Column) -> Column:
    """Double, or null where the text is not a number."""
    cleaned = strip(text)
    plain = F.when(cleaned.rlike(_NUMBER), F.translate(cleaned, "_", ""))
    signless = F.regexp_replace(plain, r"(?i)^[+-](?=nan$)", "")
    return signless.try_cast("double")


def repeats(names: Column) -> Column:
    """Whether an array holds a value twice."""
    return F.size(F.array_distinct(names)) < F.size(names)


def as_map_or_null(entries: Column) -> Column:
    """Map of entries sorted by key; null instead of an empty map."""
    return F.when(F.size(entries) > 0, F.map_from_entries(F.sort_array(entries)))


def json_text(value: Column) -> Column:
    """JSON string literal of a text column.

    Written as an array of one text; the quotes keep the trim from reaching the text itself.
    """
    return F.trim(F.to_json(F.array(value)), F.lit("[]"))


def _json_value(attr: Column) -> Column:
    """Text is quoted; numbers, booleans and arrays already are JSON text."""
    raw = attr["value"]
    is_text = attr["vtype"] == "str"
    return F.coalesce(F.when(is_text, json_text(raw)).otherwise(raw), F.lit("null"))


def _json_object(entries: Column, render) -> Column:
    body = F.array_join(
        F.transform(
            entries, lambda e: F.concat(json_text(e["name"]), F.lit(":"), render(e))
        ),
        ",",
    )
    return F.concat(F.lit("{"), body, F.lit("}"))


def attrs_json(attrs: Column) -> Column:
    return _json_object(attrs, _json_value)


def variables_json(variables: Column) -> Column:
    def one(v: Column) -> Column:
        return F.concat(
            F.lit('{"attrs":'),
            attrs_json(v["attrs"]),
            F.lit(',"dims":'),
            F.to_json(v["dims"]),
            F.lit("}"),
        )

    return _json_object(variables, one)


@F.pandas_udf(T.StringType())
def _escape_bytes(values: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for series in values:
        yield series.map(
            lambda b: None if b is None else bytes(b).decode("utf-8", "backslashreplace")
        )


def text_from_bytes(data: Column) -> Column:
    r"""Text of a bytes attribute; bytes that are not UTF-8 become ``\xNN``.

    Valid bytes never leave the JVM: Python gets nulls in their place.
    """
    valid = F.is_valid_utf8(data.cast("string"))
    return F.coalesce(F.when(valid, data.cast("string")), _escape_bytes(F.when(~valid, data)))


def number_is_lost(raw: Column) -> Column:
    """A value is there, yet it does not read as a number."""
    return raw.isNotNull() & to_number(raw).isNull()

