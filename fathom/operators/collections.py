"""The collection tree: which collection a file belongs to, ancestors, and what changed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathom.functions.attributes import attrs_json
from fathom.functions.identity import media_type, object_uri
from fathom.operators.extents import SIDES, _union, item_properties
from fathom.operators.store import spreading
from fathom.session import materialize

# Rules from key to collection, first match wins, and the name for no match.
UNKNOWN_COLLECTION = "unknown_collection"
COLLECTION_RULES = (
    (r"^IMOS/ANMN/.*/Wave/.*_FV01_.*(ADCP|AWAC).*\.nc", "aaebf991-b79d-4670-a1c5-a0de9bf649ce"),
    (r"^IMOS/ANMN/.*/Temperature/.*_FV01_.*\.nc$", "7e13b5f3-4a70-4e31-9e95-335efa491c5c"),
    (
        r"^IMOS/ANMN/.*/CTD_timeseries/.*_FV01_.*(SBE|XR-420).*_END-.*\.nc$",
        "7e13b5f3-4a70-4e31-9e95-335efa491c5c",
    ),
    (r"^IMOS/ANMN/.*/Wave/.*_FV00_.*realtime.*\.nc", "72dbe843-2fb1-4b2e-8b7e-4661d857affb"),
    (r"^IMOS/ANMN/.*/Meteorology/.*_FV00_.*realtime.*\.nc", "f3910f5c-c568-4af0-b773-13c0e57ada6b"),
    (
        r"^IMOS/ANMN/.*/Biogeochem_timeseries/.*_FV00_.*realtime.*\.nc",
        "13b3900f-2623-463c-98a7-ea60ac8e61ae",
    ),
    (
        r"^IMOS/ANMN/NRS/.*/aggregated_products/IMOS_ANMN-NRS_.*_FV02_.*\.nc",
        "d3feff71-ebe1-4b66-91c6-149beceef205",
    ),
    (
        r"^IMOS/ANMN/NRS/REAL_TIME/.*_channel_.*/IMOS_ANMN_.*_FV0.*",
        "006bb7dc-860b-4b89-bf4c-6bd930bd35b7",
    ),
    (
        r"^AIMS/Marine_Monitoring_Program/CTD_profiles/.*/.*_FV01_.*\.nc",
        "acad78d1-e235-45e6-8f27-0a00184e2ca9",
    ),
    (r"^IMOS/ANMN/.*/Biogeochem_profiles/.*_FV01_.*\.nc", "7b901002-b1dc-46c3-89f2-b4951cedca48"),
    (r"^NSW-OEH/Manly_Hydraulics_Laboratory/Wave/.*", "bb7e9d82-3b9c-44c6-8e93-1ee9fd30bf21"),
    (r"^IMOS/ANMN/.*_FV02_.*-burst-averaged.*\.nc$", "8964658c-6ee1-4015-9bae-2937dfcc6ab9"),
    (r"^IMOS/ANMN/AM/.*-delayed_.*\.nc$", "89b495cc-7382-43c0-abef-d1e66738a924"),
    (r"^IMOS/ANMN/AM/.*-realtime\.nc$", "4d3d4aca-472e-4616-88a5-df0f5ab401ba"),
    (r"^IMOS/ANMN/.*/Velocity/.*FV01.*\.nc$", "ae86e2f5-eaaf-459e-a405-e654d85adb9c"),
    (r"^IMOS/ANMN/Acoustic/metadata/update.*\.csv$", "e850651b-d65d-495b-8182-5dde35919616"),
    (r"^IMOS/ANMN/.*/hourly_timeseries/.*", "efd8201c-1eca-412e-9ad2-0534e96cea14"),
    (r"^IMOS/ANMN/.*/gridded_timeseries/.*", "279a50e3-21a5-4590-85a0-71f963efab82"),
    (r"^IMOS/ANMN/.*/aggregated_timeseries/.*", "moorings-aggregated-timeseries-product"),
    (r"^IMOS/SOOP/SOOP-ASF/.*/IMOS_SOOP-ASF_FMT_.*\.nc$", "07818819-2e5c-4a12-9395-0082b57b2fe8"),
    (r"^IMOS/AATAMS/satellite_tagging/MEOP_QC_CTD/.*\.nc$", "95d6314c-cfc7-40ae-b439-85f14541db71"),
    (r"^IMOS/SRS/SST/ghrsst/L4/GAMSSA/.*", "2d496463-600c-465a-84a1-8a4ab76bd505"),
    (r"^IMOS/SRS/SST/ghrsst/L4/RAMSSA/.*", "a4170ca8-0942-4d13-bdb8-ad4718ce14bb"),
)
# End of fixed values.


def collection_id(key: Column, default: str | None = UNKNOWN_COLLECTION) -> Column:
    """Collection of the first rule that matches the key."""
    found = F.lit(default).cast("string")
    for pattern, name in reversed(COLLECTION_RULES):
        found = F.when(key.rlike(pattern), name).otherwise(found)
    return found


def ancestors(collections: DataFrame) -> DataFrame:
    """Rows ``(id, ancestor, depth)`` for every collection, itself included at depth 0.

    ``collections`` holds ``(id, parent_id)``. A step joins the newest level to its parents;
    the number of steps is the depth of the tree. A cycle fails instead of running on.
    """
    edges = materialize(collections.select("id", "parent_id").distinct())
    parents = edges.filter(F.col("parent_id").isNotNull()).select(
        F.col("id").alias("ancestor"), F.col("parent_id").alias("next")
    )
    level = edges.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("depth")).distinct()
    closure, depth = level, 0
    while True:
        depth += 1
        level = materialize(
            level.join(parents, "ancestor").select(
                "id", F.col("next").alias("ancestor"), F.lit(depth).alias("depth")
            )
        )
        if level.isEmpty():
            return closure
        if not level.filter(F.col("id") == F.col("ancestor")).isEmpty():
            raise ValueError("the collection tree has a cycle")
        closure = closure.unionByName(level)


def extent_rollup(extents: DataFrame, collections: DataFrame) -> DataFrame:
    """Extents of collections pushed up to every ancestor.

    ``extents`` has one row per collection, so items are reduced before they meet the tree.
    """
    up = extents.join(ancestors(collections), extents["collection_id"] == F.col("id"))
    return up.groupBy(F.col("ancestor").alias("collection_id")).agg(
        *_union(F.min, F.max), F.sum("n_items").alias("n_items")
    )


def collection_tree(wanted: DataFrame, info: DataFrame) -> DataFrame:
    """The wanted collections and all their parents, with title (or id) and description.

    ``info`` is the table ``(id, title, description, parent_id)``; a collection it does not
    know becomes a root of its own.
    """
    ids = wanted.select("id").distinct()
    known = info.select("id", "parent_id")
    every = ids.join(known, "id", "left").unionByName(
        known.join(ids, "id", "left_anti")
    )
    needed = (
        ancestors(every)
        .join(ids, "id", "left_semi")
        .select(F.col("ancestor").alias("id"))
        .distinct()
    )
    return needed.join(info, "id", "left").select(
        "id",
        F.coalesce(F.nullif("title", F.lit("")), "id").alias("title"),
        "description",
        "parent_id",
    )


def changed_objects(found: DataFrame, indexed: DataFrame) -> DataFrame:
    """Found objects ``(item_id, checksum)`` with what to do: add, replace or skip."""
    old = indexed.select(
        F.col("item_id").alias("_item"), F.col("checksum").alias("_checksum")
    )
    joined = found.join(old, found["item_id"] == old["_item"], "left")
    action = (
        F.when(F.col("_item").isNull(), "add")
        .when(F.col("checksum").eqNullSafe(F.col("_checksum")), "skip")
        .otherwise("replace")
    )
    return joined.select(found["*"], action.alias("action"))


def work_list(found: DataFrame, indexed: DataFrame) -> DataFrame:
    """Found objects that are new or differ."""
    return changed_objects(found, indexed).filter(F.col("action") != "skip").drop("action")


def items_by_collection(items: DataFrame) -> DataFrame:
    """Items and bytes per collection."""
    return items.groupBy("collection_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.sum(F.coalesce("size", F.lit(0))).alias("total_bytes"),
    )


def item_documents(items: DataFrame) -> DataFrame:
    """One JSON document per item: extent, properties, and the asset with size and checksum.

    ``items`` has the object's columns, its extent (``file_extents``) and ``global_attrs``.
    """
    asset = F.struct(
        object_uri(F.col("bucket"), F.col("key")).alias("href"),
        media_type(F.col("key")).alias("type"),
        F.col("size").alias("file:size"),
        F.col("checksum").alias("file:checksum"),
    )
    core = F.struct(
        F.col("item_id").alias("id"),
        F.col("collection_id").alias("collection"),
        F.array(*[F.col(s) for s in SIDES[:4]]).alias("bbox"),
        F.col("geometry"),
        F.col("time"),
        F.col("created"),
        F.struct(asset.alias("data")).alias("assets"),
    )
    text = F.to_json(core)
    # Properties keep the file's attribute order and value types.
    properties = attrs_json(item_properties(F.col("global_attrs")))
    document = F.concat(
        F.substring(text, F.lit(1), F.length(text) - 1),
        F.lit(',"properties":'),
        properties,
        F.lit("}"),
    )
    return items.select("collection_id", "item_id", document.alias("document"))


def write_documents(documents: DataFrame, path: str) -> None:
    """Documents as gzipped JSON lines, one folder per collection; every task writes its own."""
    rows = documents.select("collection_id", "document")
    with spreading(documents.sparkSession):
        rows.write.partitionBy("collection_id").option("compression", "gzip").text(path)
