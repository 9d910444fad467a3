"""Scans of records with soft deletes, from any table: Parquet, JDBC or a metastore."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.text import item_key, joined, tags
from tidemark.operators.changes import incremental


class SourceRefused(RuntimeError):
    """The source has rules that a copy of its rows can't carry."""


def jdbc(spark: SparkSession, url: str, query: str, **options: str) -> DataFrame:
    """A JDBC query; filters that follow are pushed down to the database."""
    return spark.read.format("jdbc").option("url", url).option("query", query).options(**options).load()


def full_scan(df: DataFrame, time: str, key: str, soft_delete: str | None = None, **resume) -> DataFrame:
    """Live rows after a marker in its order; without one, all. A full read can be resumed, too."""
    if soft_delete:
        df = df.where(~F.coalesce(F.col(soft_delete), F.lit(False)))
    return incremental(df, time, key, **resume)


def incremental_scan(df: DataFrame, time: str, key: str, soft_delete: str | None = None, **resume) -> DataFrame:
    """All rows after a marker, deleted ones included, with is_delete: those become deletes."""
    gone = F.coalesce(F.col(soft_delete), F.lit(False)) if soft_delete else F.lit(False)
    return incremental(df, time, key, **resume).withColumn("is_delete", gone)


def by_key(df: DataFrame, key: str, soft_delete: str | None = None, most: int | None = None) -> DataFrame:
    if soft_delete:
        df = df.where(~F.coalesce(F.col(soft_delete), F.lit(False)))
    df = df.orderBy(key)
    return df if most is None else df.limit(most)


def validated(df: DataFrame, needed: list[str]) -> DataFrame:
    """df, if it has the needed columns, whatever their case."""
    missing = {c.lower() for c in needed} - {c.lower() for c in df.columns}
    if missing:
        raise SourceRefused(f"columns are missing: {', '.join(sorted(missing))}")
    return df


def without_table_prefix(df: DataFrame) -> DataFrame:
    """Columns named table.column as column."""
    return df.toDF(*(c.rsplit(".", 1)[-1] for c in df.columns))


def guarded(df: DataFrame, rules: dict[str, int | None]) -> DataFrame:
    """df, if none of the named security rules (row policies, label policies, redactions) applies to its
    table; a count that could not be read (None) refuses as well."""
    found = [name for name, n in rules.items() if n is None or n > 0]
    if found:
        raise SourceRefused(f"rules apply: {', '.join(sorted(found))}")
    return df


def within_budget(df: DataFrame, most: int) -> DataFrame:
    if df.limit(most + 1).count() > most:
        raise SourceRefused(f"more than {most} items")
    return df


def error_budget(results: DataFrame, most_percent: int = 10, least: int = 50) -> DataFrame:
    """One row: examined, failures, percent, and whether the failures exceed the budget, which counts
    only once enough were examined."""
    d = results.agg(F.count("*").alias("examined"), F.count_if(~F.col("ok")).alias("failures"))
    d = d.withColumn("percent", F.floor(F.col("failures") * 100 / F.greatest("examined", F.lit(1))).cast("int"))
    return d.withColumn("exceeded", (F.col("examined") >= least) & (F.col("percent") > most_percent))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table with file and ordinal: the name of a row's file and its number there, from 1. They are
    where the row lies, so they hold for every read, and nothing is sorted for them."""
    d = spark.read.parquet(path)
    return d.select("*", F.col("_metadata.file_name").alias("file"), (F.col("_metadata.row_index") + 1).alias("ordinal"))


def numbered_through(spark: SparkSession, path: str) -> DataFrame:
    """numbered() whose ordinal goes on from file to file, in the order of their paths, so a table in many
    files has the numbers that it would have in one.

    Only how many rows each file has is counted, from its last row's place, which no column is read for.
    """
    d = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_name").alias("file"), (F.col("_metadata.row_index") + 1).alias("_row"))
    files = d.groupBy("_path").agg(F.max("_row").alias("_rows"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_path").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    d = d.join(F.broadcast(files.select("_path", before.alias("_before"))), "_path")
    return d.withColumn("ordinal", F.col("_row") + F.col("_before")).drop("_path", "_row", "_before")


def mapped(df: DataFrame, columns: dict[str, tuple[str, str]], key: str) -> DataFrame:
    """Rows of numbered() under new names and types, in one pass with three outcomes: mapped, skipped (no key)
    or bad. columns: new name to (column, type).

    A value that can't be cast makes its row bad: error names the first such column and its type, never
    what it held, and all values of the row are null. Whole rows stay, with file and ordinal, so that what is
    made of the outcomes reads the source once.
    """
    cast = {new: F.expr(f"try_cast(`{old}` AS {kind})") for new, (old, kind) in columns.items()}
    bad = F.coalesce(*(F.when(F.col(old).isNotNull() & cast[new].isNull(), F.lit(f"{new}: not a {kind}")) for new, (old, kind) in columns.items()))
    blank = F.trim(F.coalesce(F.col(columns[key][0]).cast("string"), F.lit(""))) == ""
    d = df.withColumn("_bad", F.when(~blank, bad)).withColumn("_outcome", F.when(blank, "skipped").when(F.col("_bad").isNotNull(), "bad").otherwise("mapped"))
    whole = F.col("_outcome") == "mapped"
    return d.select("file", "ordinal", F.col("_outcome").alias("outcome"), F.col("_bad").alias("error"), *(F.when(whole, v).alias(new) for new, v in cast.items()))


def refuse_bad_rows(rows: DataFrame, most: int = 20) -> DataFrame:
    """The mapped rows, unless some are bad: then refused, with the places and errors of the first few."""
    first = rows.where("outcome = 'bad'").select("file", "ordinal", "error").orderBy("file", "ordinal").limit(most).collect()
    if first:
        raise SourceRefused("rows could not be mapped: " + "; ".join(f"{r['file']} row {r['ordinal']} ({r['error']})" for r in first))
    return rows.where("outcome = 'mapped'").drop("file", "ordinal", "outcome", "error")


def record_items(df: DataFrame, prefix: str, *, key: str = "record_id", title: str = "title", body: str = "body", time: str = "last_modified", classifications: str | None = None, properties: tuple[str, ...] = ()) -> DataFrame:
    """Items of records; a null or blank key is skipped, classifications are a comma list."""
    has = F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))) != ""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    return df.where(has).select(
        joined(prefix, F.col(key)).alias("item_id"), F.lit(prefix).alias("item_type"), text(title).alias("title"), text(body).alias("content"), F.col(time).alias("last_modified"),
        (tags(F.col(classifications)) if classifications else F.lit(None).cast("array<string>")).alias("classifications"), *(F.nullif(text(c), F.lit("")).alias(c) for c in properties),
    )


def document_items(df: DataFrame, prefix: str) -> DataFrame:
    """Items of nested documents (_id, title, status, owner, body, updatedAt, classifications, isDeleted).

    Deleted ones and those without an id are skipped. An id of 24 hex digits gives the time where
    updatedAt is null.
    """
    made = F.timestamp_seconds(F.conv(F.substring("_id", 1, 8), 16, 10).cast("long"))
    time = F.coalesce("updatedAt", F.when(F.col("_id").rlike("^[0-9a-fA-F]{24}$"), made))
    d = df.where(~F.coalesce("isDeleted", F.lit(False)) & F.col("_id").isNotNull())
    kinds = F.filter("classifications", lambda x: F.trim(x) != "")
    return d.select(item_key(prefix, F.col("_id")).alias("item_id"), "title", "status", "owner", F.col("body").alias("content"), time.alias("last_modified"), F.when(F.size(kinds) > 0, kinds).alias("classifications")).orderBy("item_id")


def present(value: Column) -> Column:
    """Null for empty text: an absent property."""
    return F.nullif(value, F.lit(""))
