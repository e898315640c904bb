"""Units of measurement as expressions: whether a text is a unit, and of what dimension.

A unit is a product of factors such as ``kg m-1 s-2``, ``N/m^2`` or ``1e-3 hPa``. A factor is a
number or a name with an optional power; a slash turns the sign of the power behind it. A name is
a unit, its plural, or a unit with a decimal prefix: symbols take symbols, words take words.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Prefixes, and units by dimension as powers of (length, mass, time, temperature,
# current, amount, luminous intensity, angle).
PREFIX_SYMBOLS = "da|[YZEPTGMkhdcmuµnpfazy]"
PREFIX_WORDS = (
    "yotta|zetta|exa|peta|tera|giga|mega|kilo|hecto|deca|deka|deci|centi|milli|micro|nano|pico"
    "|femto|atto|zepto|yocto"
)
LENGTH = (1, 0, 0, 0, 0, 0, 0, 0)
MASS = (0, 1, 0, 0, 0, 0, 0, 0)
TIME = (0, 0, 1, 0, 0, 0, 0, 0)
TEMPERATURE = (0, 0, 0, 1, 0, 0, 0, 0)
CURRENT = (0, 0, 0, 0, 1, 0, 0, 0)
AMOUNT = (0, 0, 0, 0, 0, 1, 0, 0)
LIGHT = (0, 0, 0, 0, 0, 0, 1, 0)
ANGLE = (0, 0, 0, 0, 0, 0, 0, 1)
PRESSURE = (-1, 1, -2, 0, 0, 0, 0, 0)
NONE = (0, 0, 0, 0, 0, 0, 0, 0)
SYMBOLS = {
    "m": LENGTH, "g": MASS, "s": TIME, "K": TEMPERATURE, "A": CURRENT, "mol": AMOUNT, "cd": LIGHT, "rad": ANGLE,
    "Pa": PRESSURE, "bar": PRESSURE, "N": (1, 1, -2, 0, 0, 0, 0, 0), "J": (2, 1, -2, 0, 0, 0, 0, 0),
    "W": (2, 1, -3, 0, 0, 0, 0, 0), "Hz": (0, 0, -1, 0, 0, 0, 0, 0), "V": (2, 1, -3, 0, -1, 0, 0, 0),
    "C": (0, 0, 1, 0, 1, 0, 0, 0), "S": (-2, -1, 3, 0, 2, 0, 0, 0), "l": (3, 0, 0, 0, 0, 0, 0, 0),
    "L": (3, 0, 0, 0, 0, 0, 0, 0), "lm": LIGHT, "lx": (-2, 0, 0, 0, 0, 0, 1, 0),
}
WORDS = {
    "meter": LENGTH, "metre": LENGTH, "gram": MASS, "second": TIME, "kelvin": TEMPERATURE, "ampere": CURRENT,
    "mole": AMOUNT, "candela": LIGHT, "radian": ANGLE, "pascal": PRESSURE, "bar": PRESSURE,
    "newton": SYMBOLS["N"], "joule": SYMBOLS["J"], "watt": SYMBOLS["W"], "hertz": SYMBOLS["Hz"],
    "volt": SYMBOLS["V"], "coulomb": SYMBOLS["C"], "siemens": SYMBOLS["S"], "liter": SYMBOLS["L"], "litre": SYMBOLS["L"],
}
# These take no prefix.
ALONE = {
    "atm": PRESSURE, "atmosphere": PRESSURE, "psi": PRESSURE, "mmHg": PRESSURE, "inHg": PRESSURE, "torr": PRESSURE,
    "mm_Hg": PRESSURE, "min": TIME, "minute": TIME, "h": TIME, "hr": TIME, "hour": TIME, "d": TIME, "day": TIME,
    "week": TIME, "month": TIME, "yr": TIME, "year": TIME, "sec": TIME, "knot": (1, 0, -1, 0, 0, 0, 0, 0),
    "kt": (1, 0, -1, 0, 0, 0, 0, 0), "mile": LENGTH, "nautical_mile": LENGTH, "inch": LENGTH, "in": LENGTH,
    "foot": LENGTH, "feet": LENGTH, "ft": LENGTH, "fathom": LENGTH, "yard": LENGTH, "micron": LENGTH, "pound": MASS, "lb": MASS,
    "tonne": MASS, "t": MASS, "lbf": SYMBOLS["N"], "kgf": SYMBOLS["N"], "dyn": SYMBOLS["N"], "dyne": SYMBOLS["N"],
    "degree": ANGLE, "deg": ANGLE, "°": ANGLE, "degree_north": ANGLE, "degree_east": ANGLE, "degree_true": ANGLE,
    "degrees_north": ANGLE, "degrees_east": ANGLE, "degrees_true": ANGLE, "celsius": TEMPERATURE, "Celsius": TEMPERATURE,
    "degC": TEMPERATURE, "deg_C": TEMPERATURE, "degree_C": TEMPERATURE, "degrees_C": TEMPERATURE, "°C": TEMPERATURE,
    "degree_Celsius": TEMPERATURE, "degrees_Celsius": TEMPERATURE, "degreeC": TEMPERATURE, "degreesC": TEMPERATURE,
    "fahrenheit": TEMPERATURE, "degF": TEMPERATURE, "%": NONE, "percent": NONE, "ppm": NONE, "ppb": NONE, "ppt": NONE,
    "ppv": NONE, "count": NONE, "unknown": NONE, "no_unit": NONE,
}
# End of fixed values.

_FACTOR = r"(/?)\s*([A-Za-zµ°%_][A-Za-zµ°%_]*(?<!_)|[0-9]*\.?[0-9]+(?:[eE][+-]?[0-9]+)?)(?:(?:\^|\*\*)?([+-]?[0-9]+))?"
_UNIT = rf"^\s*(?:{_FACTOR}(?:\s*[.*·]\s*|\s+|(?=/)|\s*$))*$"


def _entries(table: Mapping[str, tuple[int, ...]]) -> Column:
    """A literal map from names to their powers as text."""
    lines = [f"{name}={' '.join(map(str, powers))}" for name, powers in table.items()]
    return F.str_to_map(F.lit("|".join(lines)), F.lit("\\|"), F.lit("="))


def _powers_of_name(name: Column) -> Column:
    """Dimension of one name: as it stands, as a plural, or behind a prefix; null if it is no unit."""
    long_ones = {n: p for n, p in ALONE.items() if len(n) > 2}
    symbol = F.regexp_extract(name, rf"^(?:{PREFIX_SYMBOLS})(.+)$", 1)
    word = F.regexp_extract(name, rf"^(?:{PREFIX_WORDS})(.+?)s?$", 1)
    found = F.coalesce(
        F.try_element_at(_entries(SYMBOLS | WORDS | ALONE), name),
        F.try_element_at(_entries(WORDS | long_ones), F.regexp_extract(name, r"^(.+)s$", 1)),
        F.try_element_at(_entries(SYMBOLS), symbol),
        F.try_element_at(_entries(WORDS), word),
    )
    return F.split(found, " ").cast("array<int>")


def dimension(units: Column) -> Column:
    """Powers of the base dimensions as an array; null if the text is no unit.

    An empty text has no dimension. Numbers count as factors without one.
    """
    factors = F.regexp_extract_all(units, F.lit(_FACTOR), F.lit(0))
    none = F.array(*map(F.lit, NONE))

    def one(factor: Column) -> Column:
        name = F.regexp_extract(factor, _FACTOR, 2)
        sign = F.when(factor.startswith("/"), -1).otherwise(1)
        exponent = sign * F.coalesce(F.nullif(F.regexp_extract(factor, _FACTOR, 3), F.lit("")).cast("int"), F.lit(1))
        powers = F.when(name.rlike(r"^[0-9.]"), none).otherwise(_powers_of_name(name))
        # Both are found before the powers are gone through.
        return F.transform(F.arrays_zip(powers.alias("p"), F.array_repeat(exponent, len(NONE)).alias("e")), lambda x: x["p"] * x["e"])

    total = F.aggregate(
        F.transform(factors, one), none, lambda a, b: F.when(b.isNotNull(), F.zip_with(a, b, lambda x, y: x + y))
    )
    return F.when(units.rlike(_UNIT), total)


def with_dimension(units: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the dimension, which is worked out once however often it stands in it."""
    return F.get(F.transform(F.array(dimension(units)), use), F.lit(0))


def of_pressure(powers: Column) -> Column:
    return F.coalesce(powers == F.array(*map(F.lit, PRESSURE)), F.lit(False))
