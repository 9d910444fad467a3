"""Catalogue entities from JSON pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.hashing import guid_id
from tidemark.functions.text import joined, qualified_name

ENTITY = "guid string, typeName string, status string, attributes struct<name: string, qualifiedName: string, owner: string, description: string, comment: string, updateTime: long, columns: array<string>>, classificationNames array<string>, meanings array<struct<displayText: string>>"


def parse_entities(raw: DataFrame, column: str = "value") -> DataFrame:
    """Active entities, one row per guid."""
    d = raw.select(F.from_json(column, ENTITY).alias("e")).where("e.guid is not null").select("e.*")
    d = d.where(F.coalesce("status", F.lit("ACTIVE")) == "ACTIVE").dropDuplicates(["guid"])
    a = F.col("attributes")
    return d.select(
        "guid", F.col("typeName").alias("type_name"), a["name"].alias("name"), a["qualifiedName"].alias("qualified_name"), a["owner"].alias("owner"), a["description"].alias("description"),
        a["comment"].alias("comment"), F.timestamp_millis(a["updateTime"]).alias("updated_utc"), a["columns"].alias("columns"), F.col("classificationNames").alias("classifications"),
        F.transform("meanings", lambda m: m["displayText"]).alias("terms"),
    )


def described(entities: DataFrame) -> DataFrame:
    """Items of entities with a description of what they are."""
    q = qualified_name(F.col("qualified_name"))
    line = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", joined(label, ": ", c))
    content = F.concat_ws(
        "\n", joined(F.col("type_name"), " ", q["database"], F.when(q["object"] != "", joined(".", q["object"]))), line("Owner", F.col("owner")), line("Description", F.col("description")),
        line("Comment", F.col("comment")), line("Columns", F.array_join("columns", ", ")), line("Terms", F.array_join("terms", ", ")), line("Tags", F.array_join("classifications", ", ")),
    )
    return entities.select(guid_id(F.col("guid")).alias("item_id"), F.col("type_name").alias("item_type"), F.col("name").alias("title"), content.alias("content"), F.col("updated_utc").alias("last_modified"), "classifications")
