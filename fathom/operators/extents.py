"""Space and time extents of files, from headers and coordinate values.

Coordinate values come as long rows ``(hash, var, idx, value)``; files differ in length by
orders of magnitude, so everything here is an aggregate with a partial step, or a window over
one dimension of one file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fathom.functions.coordinates import attribute, geometry, time_range, variable_role
from fathom.session import tasks_for

# What a file without a needed axis is reported as.
AXIS_ERRORS = (
    ("latitude", "Latitude coordinate not found"),
    ("longitude", "Longitude coordinate not found"),
    ("time", "Time coordinate not found"),
)
# End of fixed values.


def variable_roles(headers: DataFrame, keys: Sequence[str] = ("hash",)) -> DataFrame:
    """One row per variable of a header with its place in the file and its role."""
    v = F.col("variable")
    return headers.select(*keys, F.posexplode("variables").alias("pos", "variable")).select(
        *keys,
        "pos",
        v["name"].alias("name"),
        v["is_coord"].alias("is_coord"),
        variable_role(v).alias("role"),
    )


def pick_axes(headers: DataFrame, keys: Sequence[str] = ("hash",)) -> DataFrame:
    """Per file the variable of each axis, and the error where a needed one is missing.

    The first coordinate of a role wins; latitude, longitude and time fall back to the first
    of all variables. Variables are ranked inside their row, so there is no shuffle.
    """

    # Each variable's role is worked out once.
    known = F.transform(
        "variables", lambda v: F.struct(v["name"].alias("name"), v["is_coord"].alias("is_coord"), variable_role(v).alias("role"))
    )
    headers = headers.withColumn("_roles", known)

    def named(role: str, keep) -> Column:
        hit = F.filter(F.col("_roles"), lambda v: keep(v) & (v["role"] == role))
        return F.get(hit, F.lit(0))["name"]

    axes = {}
    for role in ("latitude", "longitude", "time", "depth"):
        first = named(role, lambda v: v["is_coord"])
        anywhere = named(role, lambda v: F.lit(True))
        axes[role] = first if role == "depth" else F.coalesce(first, anywhere)
    found = headers.select(*keys, *[c.alias(n) for n, c in axes.items()])
    error = F.lit(None).cast("string")
    for role, message in reversed(AXIS_ERRORS):
        error = F.when(F.col(role).isNull(), message).otherwise(error)
    return found.withColumn("error", error)


def file_extents(
    coords: DataFrame, lat: str = "LATITUDE", lon: str = "LONGITUDE", time: str = "TIME"
) -> DataFrame:
    """Per file the box, its geometry and the time range, from long coordinate rows."""

    def end(agg, var: str) -> Column:
        return agg(F.when(F.col("var") == var, F.col("value")))

    ends = coords.groupBy("hash").agg(
        end(F.min, lon).alias("west"),
        end(F.min, lat).alias("south"),
        end(F.max, lon).alias("east"),
        end(F.max, lat).alias("north"),
        end(F.min, time).alias("t_min"),
        end(F.max, time).alias("t_max"),
    )
    sides = [F.col(c) for c in ("west", "south", "east", "north")]
    return ends.withColumn("geometry", geometry(*sides)).withColumn(
        "time", time_range(F.col("t_min"), F.col("t_max"))
    )


def item_properties(attrs: Column) -> Column:
    """Global attributes with ``abstract`` renamed to ``description``, which it replaces."""
    has_abstract = F.array_contains(attrs["name"], "abstract")
    kept = F.filter(attrs, lambda a: ~(has_abstract & (a["name"] == "description")))
    return F.transform(
        kept,
        lambda a: F.struct(
            F.when(a["name"] == "abstract", "description").otherwise(a["name"]).alias("name"),
            a["value"].alias("value"),
            a["vtype"].alias("vtype"),
        ),
    )


def dim_steps(
    coords: DataFrame,
    keys: Sequence[str] = ("hash", "var"),
    order: Sequence[str] = ("idx",),
    stretch: int = 1_000_000,
) -> DataFrame:
    """Per dimension of a file: ends, length, and the step when all differences agree.

    ``order`` starts with the index and must order the values totally. A step needs at least
    two differences. Values are compared inside stretches of the index, and the stretches by
    their first and last values, so that one huge dimension is spread over many tasks.
    """
    placed = coords.withColumn("_stretch", F.floor(F.col(order[0]) / stretch))
    ends = placed.agg(F.min("_stretch"), F.max("_stretch")).first()
    if ends[0] == ends[1]:
        return _whole_steps(coords, keys, order)
    return _stretched_steps(placed, keys, order)


def _whole_steps(coords: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Steps where no dimension is longer than a stretch: one shuffle, one sort."""
    line = Window.partitionBy(*keys).orderBy(*order)
    dealt = coords.repartition(tasks_for(coords), *keys)
    gaps = dealt.withColumn("_gap", F.col("value") - F.lag("value").over(line))
    regular = (F.count("_gap") > 1) & (F.min("_gap") == F.max("_gap"))
    return gaps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_values"),
        F.min("value").alias("extent_min"),
        F.max("value").alias("extent_max"),
        F.when(regular, F.min("_gap")).alias("step"),
    )


def _stretched_steps(placed: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Steps by stretches of the index, which meet by their first and last values."""
    place = F.struct(*order)
    part = [*keys, "_stretch"]
    line = Window.partitionBy(*part).orderBy(*order)
    inner = (
        placed.repartition(tasks_for(placed), *part)
        .withColumn("_gap", F.col("value") - F.lag("value").over(line))
        .groupBy(*part)
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.min("value").alias("extent_min"),
            F.max("value").alias("extent_max"),
            F.count("_gap").alias("_n"),
            F.min("_gap").alias("_low"),
            F.max("_gap").alias("_high"),
            F.min_by("value", place).alias("_first"),
            F.max_by("value", place).alias("_last"),
        )
    )
    between = F.col("_first") - F.lag("_last").over(Window.partitionBy(*keys).orderBy("_stretch"))
    gaps = inner.withColumn("_between", between)
    low = F.least(F.min("_low"), F.min("_between"))
    high = F.greatest(F.max("_high"), F.max("_between"))
    regular = (F.sum("_n") + F.count("_between") > 1) & (low == high)
    return gaps.groupBy(*keys).agg(
        F.sum("n_values").alias("n_values"),
        F.min("extent_min").alias("extent_min"),
        F.max("extent_max").alias("extent_max"),
        F.when(regular, low).alias("step"),
    )


def _first_text(attrs: Column, *names: str) -> Column:
    """First of the attributes that is there and not empty."""
    return F.coalesce(*[F.nullif(attribute(attrs, n), F.lit("")) for n in names])


def dim_profile(
    headers: DataFrame, coords: DataFrame, order: Sequence[str] = ("idx",)
) -> DataFrame:
    """Per dimension of a file: type, axis, ends, step, description and unit."""
    names, texts = F.col("variables.name"), F.col("variables.attrs")
    # All that a header says of its dimensions is in its row, so nothing is shuffled for it.
    dims = pick_axes(headers.withColumn("_names", names).withColumn("_attrs", texts), ("hash", "dims", "_names", "_attrs"))
    dims = dims.select("*", F.explode("dims.name").alias("var"))
    attrs = F.get("_attrs", (F.array_position("_names", F.col("var")) - 1).cast("int"))
    dims = dims.withColumn("_own", attrs)
    role = (
        F.when(F.col("var") == F.col("time"), "temporal")
        .when(F.col("var").isin(F.col("longitude"), F.col("latitude"), F.col("depth")), "spatial")
        .otherwise("other")
    )
    axis = (
        F.when(F.col("var") == F.col("time"), None)
        .when(F.col("var") == F.col("longitude"), "x")
        .when(F.col("var") == F.col("latitude"), "y")
        .when(F.col("var") == F.col("depth"), "z")
    )
    described = dims.select(
        "hash",
        "var",
        F.coalesce(role, F.lit("other")).alias("type"),
        axis.alias("axis"),
        _first_text(F.col("_own"), "long_name", "description").alias("description"),
        _first_text(F.col("_own"), "units", "unit").alias("unit"),
    )
    return described.join(dim_steps(coords, order=order), ["hash", "var"], "left").select(
        "hash", "var", "type", "axis", "extent_min", "extent_max", "step", "description", "unit"
    )


def var_profile(headers: DataFrame, keys: Sequence[str] = ("hash",)) -> DataFrame:
    """Per data variable and auxiliary coordinate: dimensions, type, texts and shape."""
    v = F.col("variable")
    sizes, names = F.col("dims.size"), F.col("dims.name")
    shape = F.transform(
        v["dims"], lambda d: F.get(sizes, (F.array_position(names, d) - 1).cast("int"))
    )
    rows = headers.select(*keys, "dims", F.explode("variables").alias("variable"))
    return rows.filter(~v["is_coord"] | ~F.array_contains(names, v["name"])).select(
        *keys,
        v["name"].alias("name"),
        v["dims"].alias("dimensions"),
        F.when(v["is_coord"], "auxiliary").otherwise("data").alias("type"),
        _first_text(v["attrs"], "description", "long_name").alias("description"),
        _first_text(v["attrs"], "units", "unit").alias("unit"),
        v["attrs"].alias("attrs"),
        shape.alias("shape"),
    )


SIDES = ("west", "south", "east", "north", "t_min", "t_max")


def _union(agg_min, agg_max) -> list[Column]:
    """The union of extents: outermost sides."""
    pick = {"west": agg_min, "south": agg_min, "east": agg_max, "north": agg_max,
            "t_min": agg_min, "t_max": agg_max}
    return [pick[s](s).alias(s) for s in SIDES]


def join_extents(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Union of two tables of extents by key; an extent on one side only is kept."""
    both = left.select(key, *SIDES).unionByName(right.select(key, *SIDES))
    return both.groupBy(key).agg(*_union(F.min, F.max))


def collection_extent(items: DataFrame, key: str = "collection_id") -> DataFrame:
    """Extent of each collection from its items."""
    return items.groupBy(key).agg(*_union(F.min, F.max), F.count(F.lit(1)).alias("n_items"))
