"""The corpus pipeline: five stages from documents to packed windows of token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the columns of
documents and carry out their decision: what a stage rejects is not in its result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_copies, packing, quality_model, substring_dedup
from tidemark.llm.common import WORD, checked, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't predict to be of quality 0. It learns from all labelled
    documents, up to its bounded sample."""
    model = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality_model.score(docs, model, *COLUMNS).where("score >= 0.5").select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the first by doc_id (null last), then by the hash of
    the text. Two are alike if their 5-word shingles have a Jaccard index of 0.8 or more.

    Documents are told apart by doc_id and text, so rows that share an id, or have none, are judged by
    themselves. Rows alike in both are one document, of which the smallest row stays. Null, empty and
    blank texts are alike. Only ids and hashes are shuffled to find it; the texts meet them in one join,
    for which they are shuffled only if the documents that stay are too many to be broadcast.
    """
    stays = near_copies.kept(docs)
    d = docs.select(*COLUMNS).withColumn("_th", near_copies.text_key(F.col("text").cast("string"))).alias("d")
    same = F.expr("d.doc_id <=> k.doc_id and d._th = k.th")
    out = d.join(checked(stays).alias("k"), same).select("d.*", "n")
    if stays.where("n > 1").isEmpty():
        return out.select(*COLUMNS)
    single = out.where("n = 1").select(*COLUMNS)
    twice = out.where("n > 1").groupBy("doc_id", "_th").agg(F.min(F.struct(*COLUMNS)).alias("r")).select("r.*")
    return single.unionByName(twice)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the paragraphs and passages that stand in an earlier document."""
    return substring_dedup.dedup(docs.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, repeated as it repeats them.

    Each row is mixed by itself, also if it has no id or shares it. One of which taken is k times its
    size and r words more gives k whole rows and, if r is over 0, one row of its first r words.
    """
    rows = mixing.sized(docs.select(*COLUMNS)).withColumns({"_hash": F.xxhash64("text", "lang", "n_chars"), "_row": F.monotonically_increasing_id()})
    rows = table(rows, "mix-rows")  # written, so that a row keeps its number
    taken = mixing.mix(rows.select("doc_id", "size", mixing.single_source().alias("sources"), "_hash", "_row"), carry=("_hash", "_row"))
    d = rows.join(taken.where("taken > 0").select("_row", "taken"), "_row")
    rounds = F.floor(F.col("taken") / F.col("size")).cast("int")
    rest = (F.col("taken") % F.col("size")).cast("int")
    words = F.concat(F.array_repeat(F.lit(0), rounds), F.when(rest > 0, F.array(rest)).otherwise(F.array().cast("array<int>")))
    d = d.withColumn("_words", F.explode(words))
    pieces = F.regexp_extract_all("text", F.lit(f"([\\x20\\x09-\\x0D]*{WORD})"), F.lit(1))  # each word with the spaces before it
    cut = F.array_join(F.slice(pieces, F.lit(1), F.col("_words")), "")
    text = F.when(F.col("_words") > 0, cut).otherwise(F.col("text"))
    return d.select("doc_id", text.alias("text"), "lang", "source", F.length(text).cast("long").alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of near-equal windows; see packing.pack."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing to target weights", mixture),
    ("packing", packed),
]

#: SQL can express neither the classifier nor the fingerprints; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = table(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
