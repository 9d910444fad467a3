"""Who a group name is: look-ups in order of authority, with provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant

RUN, MAP, STORE, DIRECTORY, NOBODY = "run", "map", "store", "directory", "none"
KEY = ["connection_id", "name"]


def canonical_id(value: Column) -> Column:
    """An object id as 8-4-4-4-12 lower-case hex digits; null if the text isn't one, in any of its usual forms."""
    hex_ = F.lower(F.regexp_extract(value, r"^\s*[{(]?([0-9A-Fa-f]{8}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{4}-?[0-9A-Fa-f]{12})[)}]?\s*$", 1))
    bare = F.regexp_replace(hex_, "-", "")
    parts = [F.substring(bare, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.when(F.length(bare) == 32, F.concat_ws("-", *parts))


def _named(df: DataFrame, source: str, *keys: str) -> DataFrame:
    """One row per name without case, with where it is from."""
    d = df.select(*(F.col(k) for k in keys if k != "name"), F.lower("name").alias("name"), "object_id")
    return d.groupBy(*keys).agg(F.max("object_id").alias(f"{source}_id")).withColumn(f"{source}_hit", F.lit(True))


def resolve_in_order(wanted: DataFrame, run_cache: DataFrame, explicit: DataFrame, store: DataFrame, directory: DataFrame | None, as_of) -> DataFrame:
    """connection_id, name, object_id, provenance of each wanted (connection_id, name); blank names are skipped
    and names alike but for case are one, in lower case.

    The first that answers decides: what this run has found before (run_cache: connection_id, name,
    object_id), the operator's own map (explicit: name, object_id; a value that is no object id is no
    answer), the store's unexpired rows (connection_id, source_key, object_id, expires_utc), and the
    directory (name, object_id), which always answers if there is one, be it with an absence. A null
    object_id is a known absence and an answer, but in the map. Each source is joined by an equi-join on the
    name, the directory only with the names that are left.
    """
    w = wanted.where(F.trim(F.coalesce("name", F.lit(""))) != "").select("connection_id", F.lower("name").alias("name")).distinct()
    told = explicit.select("name", canonical_id(F.col("object_id")).alias("object_id")).where("object_id is not null")
    kept = store.where(F.col("expires_utc") > instant(as_of)).select("connection_id", F.col("source_key").alias("name"), "object_id")
    d = w.join(_named(run_cache, RUN, *KEY), KEY, "left").join(_named(told, MAP, "name"), "name", "left").join(_named(kept, STORE, *KEY), KEY, "left")
    first = F.when(F.col("run_hit"), RUN).when(F.col("map_hit"), MAP).when(F.col("store_hit"), STORE)
    d = d.withColumn("provenance", first)
    known = F.when(F.col("run_hit"), F.col("run_id")).when(F.col("map_hit"), F.col("map_id")).otherwise(F.col("store_id"))
    done = d.where("provenance is not null").select(*KEY, known.alias("object_id"), "provenance")
    rest = d.where("provenance is null").select(*KEY)
    if directory is None:
        return done.unionByName(rest.select(*KEY, F.lit(None).cast("string").alias("object_id"), F.lit(NOBODY).alias("provenance")))
    asked = rest.join(_named(directory, DIRECTORY, "name"), "name", "left")
    return done.unionByName(asked.select(*KEY, F.col("directory_id").alias("object_id"), F.lit(DIRECTORY).alias("provenance")))


def to_store(answers: DataFrame, source_type: str = "group") -> DataFrame:
    """The answers that are written back: those of the directory alone, absences included. What the map says is
    configuration, and what nobody was asked is no answer."""
    d = answers.where(F.col("provenance") == DIRECTORY)
    return d.select("connection_id", F.lit(source_type).alias("source_type"), F.col("name").alias("source_key"), "object_id")
