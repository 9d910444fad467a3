"""Reconciliation of source, inventory and index, by full outer joins on the item's id."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import row_fingerprint
from tidemark.operators.inventory import LIVE

DRIFT_SECONDS = 2


def source_index(source: DataFrame, index: DataFrame, inventory: DataFrame | None = None) -> DataFrame:
    """item_id and verdict. source: item_id, last_modified, is_deleted; index: item_id, last_modified.

    ORPHAN is deleted at the source and still indexed, MISSING is live and not indexed, STALE is
    indexed more than DRIFT_SECONDS before its last change. With an inventory, its live items that the
    source doesn't have at all are INVENTORY-ONLY.
    """
    s = source.select("item_id", F.col("last_modified").alias("s"), "is_deleted")
    d = s.join(index.select("item_id", F.col("last_modified").alias("i"), F.lit(True).alias("indexed")), "item_id", "left")
    drift = F.unix_micros("s") - F.unix_micros("i") > DRIFT_SECONDS * 1_000_000
    there = F.coalesce("indexed", F.lit(False))
    verdict = F.when(F.col("is_deleted") & there, "ORPHAN").when(F.col("is_deleted"), "OK").when(~there, "MISSING").when(F.coalesce(drift, F.lit(False)), "STALE").otherwise("OK")
    out = d.select("item_id", verdict.alias("verdict"))
    if inventory is None:
        return out
    only = inventory.where(F.col("state") == LIVE).select("item_id").join(source.select("item_id"), "item_id", "left_anti")
    return out.unionByName(only.select("item_id", F.lit("INVENTORY-ONLY").alias("verdict")))


def inventory_index(inventory: DataFrame, index: DataFrame, unanswered: DataFrame | None = None) -> DataFrame:
    """item_id and verdict: LOST is live and not indexed, ORPHAN is not live and still indexed, ERROR is one
    of the unanswered (item_id), for which the index gave neither yes nor no."""
    d = inventory.select("item_id", "state").join(index.select("item_id", F.lit(True).alias("indexed")), "item_id", "left")
    there, live = F.coalesce("indexed", F.lit(False)), F.col("state") == LIVE
    verdict = F.when(live & ~there, "LOST").when(~live & there, "ORPHAN").otherwise("OK")
    if unanswered is not None:
        d = d.join(unanswered.select("item_id", F.lit(True).alias("unanswered")).distinct(), "item_id", "left")
        verdict = F.when(F.col("unanswered"), "ERROR").otherwise(verdict)
    return d.select("item_id", verdict.alias("verdict"))


def source_inventory(source: DataFrame, inventory: DataFrame) -> DataFrame:
    """item_id and verdict: NEVER-WRITTEN source rows, and RESURRECTED ones whose inventory row is dead."""
    live = source.where(~F.col("is_deleted")).select("item_id")
    never = live.join(inventory.select("item_id"), "item_id", "left_anti").select("item_id", F.lit("NEVER-WRITTEN").alias("verdict"))
    dead = live.join(inventory.where(F.col("state") != LIVE).select("item_id"), "item_id", "left_semi").select("item_id", F.lit("RESURRECTED").alias("verdict"))
    return never.unionByName(dead)


def view_parity(a: DataFrame, b: DataFrame, columns: list[str], key: str = "item_id") -> DataFrame:
    """Ids that only one of two views has or whose rows differ."""
    left = a.select(F.col(key), row_fingerprint(*columns).alias("a"))
    right = b.select(F.col(key), row_fingerprint(*columns).alias("b"))
    d = left.join(right, key, "full_outer")
    verdict = F.when(F.col("a").isNull(), "only in second").when(F.col("b").isNull(), "only in first").when(F.col("a") != F.col("b"), "differs")
    return d.select(key, verdict.alias("verdict")).where("verdict is not null")


def foreign_properties(expected: DataFrame, registered: DataFrame) -> DataFrame:
    """name and verdict of properties that only one of two schemas (one name a row) has."""
    e, r = expected.select("name").distinct(), registered.select("name").distinct()
    return r.join(e, "name", "left_anti").withColumn("verdict", F.lit("foreign")).unionByName(e.join(r, "name", "left_anti").withColumn("verdict", F.lit("pending")))
