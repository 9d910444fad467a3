"""Shared pieces of the training-data operators: words, shared tables, components."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Rows of keys that are broadcast at most.
BROADCAST_ROWS = 1 << 20


def text_of(col: str | Column = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def word_array(text: Column) -> Column:
    """The words of a non-null text, in order, inside the JVM."""
    return F.array_remove(F.split(text, SPACE), "")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master (tests on one machine) uses a folder of its warehouse; a cluster
    has no folder that is safe to assume, so there the setting is asked for.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        at = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    return at.rstrip("/")


def table(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back.

    The result has no lineage but its files, so a lost executor costs no recomputation, and every
    reader sees the same rows even if the plan that made them isn't deterministic.
    """
    path = f"{shared_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Deletes tables that table() wrote and nothing reads any more."""
    for df in tables:
        files = df.inputFiles()
        if not files:
            continue
        jvm = df.sparkSession.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear_tables(spark: SparkSession) -> None:
    """Deletes all tables that table() wrote; results that still read them are then lost."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tidemark")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def checked(df: DataFrame) -> DataFrame:
    """A written table of a few longs a row, to be joined: its size is checked. Up to BROADCAST_ROWS rows
    are broadcast and the other side stays where it is; beyond that both are shuffled, and a skewed key is
    split."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def within(df: DataFrame, keys: DataFrame, on: str | list[str]) -> DataFrame:
    """The rows of df whose long columns ``on`` are among keys, a written table of those columns; see
    checked."""
    return df.join(checked(keys), on, "left_semi")


def components(edges: DataFrame, name: str = "components", max_rounds: int = 64) -> DataFrame:
    """Connected components of (a, b) long pairs: columns node, component (its smallest node).

    Alternating large-star and small-star rounds; each round is written to the shared folder, and
    the rounds end when every node but the smallest of its component hangs from that one alone. Nothing
    but a number a round reaches the driver. Minima are aggregated before the shuffle, so a node with
    very many neighbours is combined where its rows lie; they are written before the join, so that a
    skewed join can split that node's rows. Self-loops and repeated pairs are harmless; no pairs, no rows.
    """

    def settle(df: DataFrame, k: int) -> tuple[DataFrame, bool]:
        df = table(df.where("a > b").distinct(), f"{name}-{k}")
        ends = df.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(df.select("b", F.lit(0), F.lit(1)))
        ends = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
        return df, ends.where("up > 1 or up + down > 1").agg(F.count("*")).first()[0] == 0

    made = []
    pair = F.struct(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e, stars = settle(edges.where("a <> b").select(pair.alias("p")).select("p.a", "p.b"), 0)
    k = 0
    while not stars:
        if (k := k + 1) > max_rounds:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
        both = e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = table(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-low-{k}")
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = table(large, f"{name}-large-{k}")
        made += [e, low, large]
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("p")
        )
        e, stars = settle(small.select("p.a", "p.b"), k)
    drop(*made)
    roots = e.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return e.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
