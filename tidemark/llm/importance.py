"""Target-distribution importance resampling over hashed n-grams, in DataFrame functions alone.

Every word position is exploded into the runs of one to three words that begin there, each hashed to
one of ``BUCKETS`` places by crc32. Counts of the corpus and of the target by bucket make a gain table of
at most ``BUCKETS`` rows, which is broadcast; a document's weight is the sum of its features' gains.
Scores are perturbed by Gumbel noise, so that the highest ones are a draw without replacement in
proportion to exp(weight / 1000). Ranks come from a distributed sort: a row's place in its partition
and the rows of the partitions before it.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop, table, text_of

BUCKETS = 10_000
#: Characters of the ASCII range that part words, once A-Z are lower-cased.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SEED = 42
MIN_WORDS = 20
PERCENT = 5
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: monotonically_increasing_id() holds the partition above, the row within it below.
_ROW_BITS = 33


def words(text: Column) -> Column:
    """The words of a non-null text, in order."""
    return F.array_remove(F.split(F.translate(text, _UPPER, _LOWER), NO_WORD), "")


def features(rows: DataFrame, *carry: str) -> DataFrame:
    """A row per feature of the column ``words``: bucket (an int), beside the columns to carry. A row
    without words stays, with a null bucket."""
    at = rows.select(*carry, F.explode_outer(F.arrays_zip(F.col("words").alias("a"), F.expr("slice(words, 2, size(words))").alias("b"), F.expr("slice(words, 3, size(words))").alias("c"))).alias("w"))
    a, b, c = F.col("w.a"), F.col("w.b"), F.col("w.c")
    two = F.concat(a, F.lit(" "), b)
    grams = F.when(c.isNotNull(), F.array(a, two, F.concat(two, F.lit(" "), c))).when(b.isNotNull(), F.array(a, two)).when(a.isNotNull(), F.array(a))
    return at.select(*carry, F.explode_outer(grams).alias("gram")).select(*carry, (F.crc32("gram") % BUCKETS).cast("int").alias("bucket"))


def bucket_counts(texts: DataFrame) -> DataFrame:
    """bucket, n: how many features of the column text fall in each bucket; counted before the shuffle."""
    d = features(texts.select(words(text_of(F.col("text").cast("string"))).alias("words")))
    return d.where("bucket is not null").groupBy("bucket").agg(F.count("*").alias("n"))


def gains(corpus: DataFrame, target: DataFrame) -> DataFrame:
    """bucket, gain for each bucket of the corpus, of two tables of bucket_counts."""
    s, t = corpus.select("bucket", F.col("n").alias("s")), target.select("bucket", F.col("n").alias("t"))
    total = lambda d, c, name: F.broadcast(d.agg(F.coalesce(F.sum(c), F.lit(0)).cast("double").alias(name)))  # noqa: E731  one row
    d = s.join(F.broadcast(t), "bucket", "left").crossJoin(total(s, "s", "all_s")).crossJoin(total(t, "t", "all_t"))
    ratio = (F.coalesce("t", F.lit(0)) + 1.0) * (F.col("all_s") + float(BUCKETS)) / ((F.col("s") + 1.0) * (F.col("all_t") + float(BUCKETS)))
    return d.select("bucket", F.floor(1000.0 * F.log(ratio)).cast("long").alias("gain"))


def weights(docs: DataFrame, gain: DataFrame) -> DataFrame:
    """doc_id, row, n_words, n_features, weight of every row of docs. gain: at most BUCKETS rows.

    Rows are told apart by their place in the scan, so a shared or missing doc_id joins no two of them,
    and each is summed where it lies before the shuffle, so a very long text costs one row there.
    """
    d = docs.select(F.col("doc_id").cast("long"), F.monotonically_increasing_id().alias("row"), words(text_of(F.col("text").cast("string"))).alias("words"))
    carry = ("doc_id", "row", "n_words")
    d = features(d.withColumn("n_words", F.size("words").cast("long")), *carry).join(F.broadcast(gain), "bucket", "left")
    return d.groupBy(*carry).agg(F.count("bucket").alias("n_features"), F.coalesce(F.sum("gain"), F.lit(0)).alias("weight"))


def noise(seed: int = SEED) -> Column:
    """floor(1000 g), g Gumbel noise drawn by the id; rows without an id share one draw."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000.0 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def ranked(scored: DataFrame, n: int) -> DataFrame:
    """The rows with their rank (1, 2, ...) by falling score, ties by rising doc_id (null last) and row;
    ranks beyond n are null.

    The sorted rows are written once, so that places hold; only the row count of each partition reaches
    the driver.
    """
    d = scored.orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row").withColumn("at", F.monotonically_increasing_id())
    d = table(d, "importance-sorted")
    part = F.shiftright("at", _ROW_BITS).cast("int")
    sizes = sorted(tuple(r) for r in d.groupBy(part.alias("part")).count().collect())
    before = zip((p for p, _ in sizes), accumulate((k for _, k in sizes), initial=0))
    first = d.sparkSession.createDataFrame(list(before), "part int, before long")
    rank = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)) + 1
    return d.withColumn("part", part).join(F.broadcast(first), "part").withColumn("rank", F.when(rank <= n, rank)).drop("part", "at", "before")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of docs (doc_id, text), all long.

    Of the N rows with at least min_words words the floor(percent * N / 100) of the highest score are
    drawn; rank is their place, null for the rest. Null, empty and wordless texts have no features and
    weight 0; they are never drawn but with min_words 0. Repeated rows are rows of their own, told apart
    in a tie by their place; a null doc_id sorts last. A very long text is one array of its words in one
    task. An empty docs gives no rows, an empty target has T = 0. Other columns are not read.
    """
    gain = table(gains(bucket_counts(docs), bucket_counts(target)), "importance-gains")
    d = table(weights(docs, gain).withColumn("score", F.col("weight") + noise(seed)), "importance-weights")
    drop(gain)
    fit = d.where(F.col("n_words") >= min_words)
    n = percent * fit.count() // 100
    none = d.where(F.col("n_words") < min_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked(fit, n).unionByName(none).select("doc_id", "n_features", "weight", "score", "rank")
