"""The shapes the operators work on, derived from the given tables.

Each view has a counterpart of the same name in ``oracle_views``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.functions.identity import derive_facility, object_hash
from fathom.session import materialize

BUCKET = "corpus"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choose(subject: Column, values: dict, default) -> Column:
    chosen = F.lit(default)
    for value, result in reversed(values.items()):
        chosen = F.when(subject == value, result).otherwise(chosen)
    return chosen


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _concat(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def identity_hash() -> Column:
    return object_hash(F.col("bucket"), F.col("key"), F.col("version_id"))


FACILITY_OF_TYPE = {"signup": "SOOP", "error": "ANMN", "click": "AATAMS", "view": "SRS"}


def inv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory of object versions: one per event. Large values have no version, small no size."""
    value = F.col("value")
    facility = _choose(F.col("event_type"), FACILITY_OF_TYPE, "ANFOG")
    return table(spark, sf_dir, "events").select(
        F.lit(BUCKET).alias("bucket"),
        _concat("IMOS/", facility, "/", _text("user_id"), "/", _text("event_id"), ".nc").alias(
            "key"
        ),
        F.when(value <= 400, _text("event_id")).alias("version_id"),
        F.when(value >= 0.5, F.floor(value * 100).cast("bigint") * 65536).alias("size"),
        F.col("ts").alias("last_modified_date"),
    )


def sink_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a first index run wrote: everything up to a day, except one facility."""
    early = F.col("last_modified_date") < F.lit("2024-01-20").cast("timestamp_ntz")
    rows = inv(spark, sf_dir).filter(early & ~F.col("key").startswith("IMOS/SRS/"))
    return rows.select("bucket", "key", "version_id", "size")


def sink_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second sink holds: one whole facility."""
    rows = inv(spark, sf_dir).filter(F.col("key").startswith("IMOS/ANFOG/"))
    return rows.select("bucket", "key", "version_id", "size")


def inv_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory with one object per document."""
    return table(spark, sf_dir, "documents").select(
        F.lit(BUCKET).alias("bucket"),
        _concat("IMOS/", F.col("source"), "/", F.col("lang"), "/", _text("doc_id"), ".nc").alias(
            "key"
        ),
        _text("doc_id").alias("version_id"),
        F.col("n_chars").alias("size"),
    )


def inv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest inventory: one object per order line."""
    group = F.concat("l_returnflag", "l_linestatus")
    name = F.concat_ws("_", _text("l_orderkey"), _text("l_linenumber"), _text("l_suppkey"))
    return table(spark, sf_dir, "lineitem").select(
        F.lit(BUCKET).alias("bucket"),
        _concat("IMOS/", group, "/", _text("l_partkey"), "/", name, ".nc").alias("key"),
        _text(F.floor(F.col("l_quantity"))).alias("version_id"),
        (F.floor(F.col("l_extendedprice")).cast("bigint") * 1024).alias("size"),
        group.alias("facility"),
    )


def url_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of odd shapes: page URLs without scheme, some with empty or blank segments."""
    url = F.regexp_replace("url", "^https?://", "")
    page = F.col("page_id")
    key = (
        F.when(page % 5 == 0, F.regexp_replace(url, "/[^/]*$", "/"))
        .when(page % 5 == 1, _concat("/", url, "//x.nc"))
        .when(page % 5 == 2, _concat("a/ ", F.regexp_replace(url, "/", "."), " /b.csv"))
        .when(page % 5 == 3, _concat("a/  /", url))
        .otherwise(url)
    )
    return table(spark, sf_dir, "pages").select(
        F.lit(BUCKET).alias("bucket"),
        key.alias("key"),
        F.when(page % 3 > 0, _text("page_id")).alias("version_id"),
        F.col("page_id").alias("size"),
    )


VARIABLE_BITS = {1: "TEMP", 2: "PSAL", 4: "UCUR", 8: "PRES", 16: "DEPTH"}
SUBFACILITY = {"1-URGENT": "ANMN/NSW", "2-HIGH": "ANMN/QLD", "3-MEDIUM": "ANMN/SA",
               "5-LOW": "SOOP/SOOP-ASF"}
CATEGORY = {"MACHINERY": "Temperature", "AUTOMOBILE": "CTD_profiles", "BUILDING": "Velocity",
            "HOUSEHOLD": "hourly_timeseries"}
LEVEL = {"F": "Level 1 - Quality Controlled", "O": "Level 0 - Raw", "P": "Level 2 - Derived"}


def idx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Structured index rows: one per order, its site from the customer's nation."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            F.max("l_suppkey").alias("last_supp"),
        )
    )
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    k = F.col("o_orderkey")
    rows = (
        table(spark, sf_dir, "orders")
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(lines, k == F.col("l_orderkey"), "left")
    )
    folder = _choose(F.col("o_orderpriority"), SUBFACILITY, "ANMN/WA")
    category = _choose(F.col("c_mktsegment"), CATEGORY, "aggregated_timeseries")
    suffix = F.when(F.col("o_orderstatus") == "P", "_Real-Time").otherwise("")
    level = _choose(F.col("o_orderstatus"), LEVEL, "Unknown")
    names = F.filter(
        F.array(*[F.when(k.bitwiseAND(b) > 0, n) for b, n in VARIABLE_BITS.items()]),
        lambda n: n.isNotNull(),
    )
    entries = F.transform(
        names, lambda n: F.struct(n.alias("key"), F.lit("float32").alias("value"))
    )
    key = _concat(
        "IMOS/", folder, "/SITE", _text("c_nationkey"), "/", category, "/IMOS_", _text(k),
        "_FV01_SBE", suffix, "_END-1.nc",
    )
    price = F.col("o_totalprice")
    balance = F.col("c_acctbal")

    def day(c: str) -> Column:
        return _concat(_text(F.col(c).cast("date")), "T00:00:00Z")

    made = rows.select(
        k.alias("orderkey"),
        F.lit(BUCKET).alias("bucket"),
        key.alias("key"),
        _text(k).alias("version_id"),
        F.lit("NETCDF4").alias("file_format"),
        derive_facility(key).alias("facility"),
        F.lit(6).cast("bigint").alias("schema_version"),
        F.when(balance >= -900, _concat("SITE", _text("c_nationkey"))).alias("site_code"),
        _concat("PLAT", _text("last_supp")).alias("platform_code"),
        F.when(price >= 20000, _concat("DEP", _text(k % 40))).alias("deployment_code"),
        F.col("c_mktsegment").alias("instrument"),
        F.when(price >= 5000, level).alias("file_version"),
        day("first_ship").alias("time_coverage_start"),
        day("last_ship").alias("time_coverage_end"),
        F.when(price >= 100000, price).alias("geospatial_lat_min"),
        F.when(F.size(entries) > 0, F.map_from_entries(entries)).alias("variable_schema"),
        F.col("o_orderdate").alias("changed"),
    )
    return made.withColumn("hash", identity_hash())


def _attr(name, value, vtype="str") -> Column:
    def lit(x):
        return x if isinstance(x, Column) else F.lit(x)

    return F.struct(
        lit(name).alias("name"), lit(value).cast("string").alias("value"), lit(vtype).alias("vtype")
    )


def _present(*items: Column) -> Column:
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def _variable(name, dtype, dims, is_coord, *attrs) -> Column:
    is_coord = is_coord if isinstance(is_coord, Column) else F.lit(is_coord)
    return F.struct(
        F.lit(name).alias("name"),
        F.lit(dtype).alias("dtype"),
        F.array(*[F.lit(d) for d in dims]).alias("dims"),
        is_coord.alias("is_coord"),
        (_present(*attrs)).alias("attrs"),
    )


_STORED: dict[tuple[str, str], DataFrame] = {}


def header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header table, written once per session as a reader's run would leave it: by many tasks.

    The orders are dealt to the tasks, by key, and not the wide rows made of them: so neither a
    shuffle nor a sort (which dealing in turn needs) has headers in it.
    """
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _STORED:
        orders = table(spark, sf_dir, "orders").repartition(2 * spark.sparkContext.defaultParallelism, "o_orderkey")
        _STORED[place] = materialize(_header_rows(orders))
    return _STORED[place]


def _header_rows(orders: DataFrame) -> DataFrame:
    """Header rows: one per order, with varied attribute names, bad numbers and bad files."""
    k = F.col("o_orderkey")

    def is_mod(n: int, r: int = 0) -> Column:
        return k % n == r

    price = F.col("o_totalprice").cast("decimal(12,2)").cast("string")
    lat = F.when(is_mod(11), "n/a").when(is_mod(13), "12d").when(is_mod(17), "1_0").otherwise(price)
    attrs = _present(
        _attr("title", _concat(F.col("o_orderstatus"), ' "quoted" title')),
        _attr(
            F.when(is_mod(3), "Conventions").when(is_mod(3, 1), "conventions").otherwise("CON-VENTIONS"),
            _concat("CF-1.", _text(k % 4 + 4)),
        ),
        _attr(
            F.when(is_mod(2), "featureType").otherwise("feature-type"), F.lower("o_orderpriority")
        ),
        _attr(
            "geospatial_lat_min", lat,
            F.when(is_mod(11) | is_mod(13) | is_mod(17), "str").otherwise("float"),
        ),
        _attr("geospatial_lat_max", _concat("  ", _text("o_custkey"), " ")),
        _attr("time_coverage_start", _concat(_text(F.col("o_orderdate").cast("date")), "T00:00:00Z")),
        F.when(~is_mod(9), _attr("site_code", _concat("SITE", _text(F.col("o_custkey") % 25)))),
        F.when(is_mod(5), _attr("abstract", _concat("About ", _text(k)))),
        F.when(is_mod(10), _attr("description", "old text")),
        F.when(is_mod(4), _attr("InstrumentSerial-Number", _concat("S", _text(k)))),
        F.when(is_mod(4, 1), _attr("instrumentSerialNumber", _concat("T", _text(k)))),
        F.when(
            is_mod(6), _attr("instrument_nominal_depth", F.when(is_mod(12), "1e2").otherwise("deep"))
        ),
        F.when(is_mod(8), _attr("Keywords", "sea, water")),
        F.when(
            is_mod(2),
            _attr("geospatial_vertical_max", F.when(is_mod(100), "12.5").otherwise("unknown")),
        ),
    )
    lon_units = F.when(is_mod(2), "degrees_east").otherwise("degreeE")
    variables = F.when(
        is_mod(23), F.array().cast("array<struct<name:string,dtype:string,dims:array<string>,"
                                   "is_coord:boolean,attrs:array<struct<name:string,value:string,vtype:string>>>>")
    ).otherwise(
        _present(
            _variable("TIME", "float64", ["TIME"], True,
                      _attr("units", "days since 1950-01-01 00:00:00"),
                      F.when(is_mod(2), _attr("standard_name", "time"))),
            _variable("LATITUDE", "float64", ["LATITUDE"], ~is_mod(7),
                      _attr("standard_name", "latitude"), _attr("long_name", "site latitude")),
            F.when(~is_mod(19), _variable("LONGITUDE", "float64", ["LONGITUDE"], True,
                                          _attr("units", lon_units))),
            F.when(is_mod(3), _variable("NOMINAL_DEPTH", "float32", [], True,
                                        _attr("positive", "Down"), _attr("units", "m"))),
            _variable("TEMP", "float32", ["TIME", "LATITUDE"], False,
                      _attr("standard_name", "sea_water_temperature"),
                      _attr("valid_max", "40.0", "float")),
            F.when(is_mod(3, 1), _variable("PRES", "float32", ["TIME"], False,
                                           _attr("units", "dbar"), _attr("standard_name", ""))),
            F.when(is_mod(29), _variable("TEMP", "int16", ["TIME"], False)),
        )
    )
    dims = F.when(is_mod(23), F.array().cast("array<struct<name:string,size:bigint>>")).otherwise(
        F.array(
            F.struct(F.lit("TIME").alias("name"), (k % 100 + 1).cast("bigint").alias("size")),
            F.struct(F.lit("LATITUDE").alias("name"), F.lit(1).cast("bigint").alias("size")),
            F.struct(F.lit("LONGITUDE").alias("name"), F.lit(1).cast("bigint").alias("size")),
        )
    )
    magic = (
        F.when(is_mod(31), F.unhex(F.lit("504B0304")))
        .when(is_mod(5), F.unhex(F.lit("43444601AA")))
        .when(is_mod(5, 1), F.unhex(F.lit("43444602BB")))
        .when(is_mod(5, 2), F.unhex(F.lit("43444605")))
        .otherwise(F.unhex(F.lit("894844460D0A1A0ACC")))
    )
    key = F.when(is_mod(37), _concat("IMOS/", _text(k), ".nc")).otherwise(
        _concat("IMOS/ANMN/P", F.substring("o_orderpriority", 1, 1), "/", _text(k), ".nc")
    )
    return orders.select(
        F.lit(BUCKET).alias("bucket"),
        key.alias("key"),
        F.when(~is_mod(41), _text(k)).alias("version_id"),
        (k * 10).alias("size"),
        magic.alias("magic"),
        attrs.alias("global_attrs"),
        variables.alias("variables"),
        dims.alias("dims"),
    )


def coords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Coordinate values: three variables per order, one value of each per order line."""
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    cells = F.array(
        F.struct(F.lit("LATITUDE").alias("var"), (F.col("l_quantity") - 50.0).alias("value")),
        F.struct(F.lit("LONGITUDE").alias("var"),
                 (F.floor(F.col("l_tax") * 100 + 0.5) + 110).cast("double").alias("value")),
        F.struct(F.lit("TIME").alias("var"), day.cast("double").alias("value")),
    )
    return table(spark, sf_dir, "lineitem").select(
        _text("l_orderkey").alias("hash"),
        F.col("l_linenumber").cast("bigint").alias("idx"),
        F.col("l_extendedprice").alias("tie"),
        F.inline(cells),
    )


def collections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collection tree: regions, their nations, the nations' customers."""
    region = table(spark, sf_dir, "region").select(
        _concat("R", _text("r_regionkey")).alias("id"),
        F.col("r_name").alias("title"),
        F.lit(None).cast("string").alias("parent_id"),
    )
    nation = table(spark, sf_dir, "nation").select(
        _concat("N", _text("n_nationkey")).alias("id"),
        F.lit("").alias("title"),
        _concat("R", _text("n_regionkey")).alias("parent_id"),
    )
    customer = table(spark, sf_dir, "customer").select(
        _concat("C", _text("c_custkey")).alias("id"),
        F.col("c_name").alias("title"),
        _concat("N", _text("c_nationkey")).alias("parent_id"),
    )
    every = region.unionByName(nation).unionByName(customer)
    return every.withColumn("description", _concat("about ", F.col("id")))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items with extents: one per order line, its collection the order's customer."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    day = F.datediff(F.col("l_shipdate").cast("date"), F.lit("1995-01-01").cast("date"))
    lon = (F.floor(F.col("l_tax") * 100 + 0.5) + 110).cast("double")
    return (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            _concat("C", _text("o_custkey")).alias("collection_id"),
            lon.alias("west"),
            (F.col("l_quantity") - 50.0).alias("south"),
            (lon + 1.0).alias("east"),
            (F.col("l_quantity") - 49.0).alias("north"),
            day.cast("double").alias("t_min"),
            (day + 1).cast("double").alias("t_max"),
        )
    )
