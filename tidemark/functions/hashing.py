"""Framed hashes: every field stands behind its length, so no two field lists give the same bytes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.times import iso_ticks

NO_GRANTS = "(no grants)"
UNIT_SEPARATOR = "\x1f"
HASH_VERSION = 1


def frame(text: Column) -> Column:
    """Four bytes, little-endian, of the UTF-8 length, then the bytes."""
    size = F.lpad(F.hex(F.octet_length(text)), 8, "0")
    return F.concat(F.unhex(F.concat(*(F.substring(size, i, 2) for i in (7, 5, 3, 1)))), text.cast("binary"))


def rendered(col: Column, kind: T.DataType) -> Column:
    """The text of a value that is hashed. Types that a target schema can't hold are refused."""
    if isinstance(kind, (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType)):
        return col.cast("string")
    if isinstance(kind, T.TimestampType):
        return iso_ticks(col)
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return F.array_join(col, UNIT_SEPARATOR)
    raise TypeError(f"values of type {kind.simpleString()} have no hash rendering")


def content_hash(items: DataFrame, properties: Sequence[str], item_id: str = "item_id", item_type: str = "item_type", content: str = "content") -> Column:
    """SHA-256, in hex, of id, type, the properties by name and the content; a null property is absent."""
    kinds = {f.name: f.dataType for f in items.schema.fields}
    none = F.lit(b"")
    parts = [frame(F.col(item_id)), frame(F.col(item_type))]
    for name in sorted(properties):
        pair = F.concat(frame(F.lit(name)), frame(rendered(F.col(name), kinds[name])))
        parts.append(F.when(F.col(name).isNull(), none).otherwise(pair))
    parts.append(frame(F.coalesce(F.col(content), F.lit(""))))
    return F.sha2(F.concat(*parts), 256)


def acl_hash(acl: Column) -> Column:
    """SHA-256, in hex, of an array of struct(type, value, access), whatever its order."""
    lines = F.array_sort(F.transform(acl, lambda g: F.concat_ws("|", g["type"], g["value"], g["access"])))
    framed = F.aggregate(F.transform(lines, frame), F.lit(b""), lambda a, b: F.concat(a, b))
    return F.sha2(F.when(F.coalesce(F.size(acl), F.lit(0)) > 0, framed).otherwise(frame(F.lit(NO_GRANTS))), 256)


def row_fingerprint(*cols: str) -> Column:
    """SHA-256, in hex, of columns joined by |, with a word for null."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols)), 256)


def path_id(path: Column) -> Column:
    return F.concat(F.lit("h"), F.sha2(path, 256))


def view_row_id(view: Column, key: Column) -> Column:
    return F.concat(F.lit("t"), F.sha2(F.concat(view, F.lit(UNIT_SEPARATOR), key.cast("string")), 256))


def guid_id(guid: Column) -> Column:
    return F.substring(F.concat(F.lit("a"), F.regexp_replace(guid, "[^A-Za-z0-9]", "")), 1, 128)
