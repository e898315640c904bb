"""Identity and path columns. All are built-in expressions and stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space at the ends of a name, the unknown marker, the identity text layout, the format names and their
# leading bytes, and the size from which a file is read by range.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
UNKNOWN_FACILITY = "UNKNOWN"
MISSING_VERSION = "None"
MAGIC_FORMATS = (
    (b"CDF\x01", "NETCDF3_CLASSIC"),
    (b"CDF\x02", "NETCDF3_64BIT_OFFSET"),
    (b"CDF\x05", "NETCDF5"),
    (b"\x89HDF\r\n\x1a\n", "NETCDF4"),
)
RANGE_READ_BYTES = 100 * 1024**2
# End of fixed values.


def _version_text(version_id: Column) -> Column:
    return F.coalesce(version_id, F.lit(MISSING_VERSION))


def object_hash(bucket: Column, key: Column, version_id: Column) -> Column:
    """Hex SHA-256 of the object version's identity."""
    text = F.concat(
        F.lit("bucket:"), bucket, F.lit("|key:"), key, F.lit("|version:"), _version_text(version_id)
    )
    return F.sha2(text, 256)


def object_uri(bucket: Column, key: Column) -> Column:
    return F.concat(F.lit("s3://"), bucket, F.lit("/"), key)


def versioned_uri(bucket: Column, key: Column, version_id: Column) -> Column:
    return F.concat(object_uri(bucket, key), F.lit("?versionId="), _version_text(version_id))


def _clean_path(path: Column) -> Column:
    """File-system form: no empty or ``.`` segments and no trailing slash."""
    return F.rtrim(F.regexp_replace(path, r"/(?:\.?(?:/|$))+", "/"), F.lit("/"))


def object_path(bucket: Column, key: Column, version_id: Column) -> Column:
    """``bucket/key/version``."""
    return _clean_path(F.concat_ws("/", bucket, key, _version_text(version_id)))


def version_path(bucket: Column, key: Column, version_id: Column) -> Column:
    """``bucket/key:version``, or ``bucket/key`` without a version."""
    suffix = F.when(
        version_id.isNotNull() & (version_id != ""), F.concat(F.lit(":"), version_id)
    ).otherwise("")
    return _clean_path(F.concat(bucket, F.lit("/"), key, suffix))


def strip(text: Column) -> Column:
    """Text without white space at its ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def derive_facility(key: Column) -> Column:
    """Second non-empty segment of a key with at least three; ``UNKNOWN`` otherwise.

    One regular expression instead of split and filter, so it does not leave generated code.
    """
    segment = F.regexp_extract(key, r"^/*[^/]+/+([^/]+)/+[^/]", 1)
    return F.coalesce(F.nullif(strip(segment), F.lit("")), F.lit(UNKNOWN_FACILITY))


def derive_collection(uri: Column) -> Column:
    """Facility of a full URI, null where unknown."""
    key = F.regexp_extract(uri, r"(?s)^[^/]*/[^/]*/[^/]*/(.*)$", 1)
    return F.nullif(derive_facility(key), F.lit(UNKNOWN_FACILITY))


def dir_prefix(key: Column) -> Column:
    """Key without its file name."""
    return F.regexp_replace(key, r"/[^/]*$", "/")


def extract_year(value: Column) -> Column:
    """First stand-alone run of four digits as an integer."""
    return F.nullif(F.regexp_extract(value, r"\b(\d{4})\b", 1), F.lit("")).try_cast("int")


def format_from_magic(magic: Column) -> Column:
    """Array-file format by leading bytes; null when none is known."""
    found = F.lit(None).cast("string")
    for signature, name in reversed(MAGIC_FORMATS):
        head = F.substring(magic, 1, len(signature))
        found = F.when(head == F.lit(signature), name).otherwise(found)
    return found


def route_by_size(size: Column, threshold: int = RANGE_READ_BYTES) -> Column:
    """``disk`` for files up to the threshold, ``cloud`` for larger or unknown sizes."""
    return F.when(size <= threshold, "disk").otherwise("cloud")


def item_id(key: Column) -> Column:
    return F.translate(key, "/.", "__")


def file_type(path: Column) -> Column:
    """Text behind the last dot; the whole path when there is none."""
    return F.substring_index(path, ".", -1)


def item_reader(path: Column) -> Column:
    """Which reader takes the file; null when no reader does."""
    kind = file_type(path)
    return F.when(kind.isin("nc", "csv"), kind)


def media_type(path: Column) -> Column:
    """Media type of the file by its reader; of other files that of plain bytes."""
    kind = item_reader(path)
    return (
        F.when(kind == "nc", "application/netcdf")
        .when(kind == "csv", "text/csv")
        .otherwise("application/octet-stream")
    )
