"""Winnowing fingerprints, with DataFrame functions only.

Units of a text are its words, of which long ones are cut every ``UNIT`` code points, and single code points
of scripts that are written without spaces. What is a unit depends on the code points of its own word alone,
so an edit elsewhere in a text changes no unit. Hashes of K successive units; of every WINDOW successive
hashes the smallest is chosen, of equal ones the rightmost, and its place is kept. A run of
K + WINDOW - 1 units that two texts share therefore leaves a common hash in both fingerprints: the match
guarantee, for texts of any length and script.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import text_of

K = 3
WINDOW = 3
UNIT = 16
#: Blocks of scripts without spaces: Thai to Myanmar, Khmer, Chinese, Japanese, Yi.
NO_SPACES = r"\u0E00-\u109F\u1780-\u17FF\u2E80-\uA4CF\uF900-\uFAFF\x{20000}-\x{3FFFF}"
UNITS = rf"[{NO_SPACES}]|[^\x20\x09-\x0D{NO_SPACES}]{{1,{UNIT}}}"
#: Rows that one slice of the order is meant to hold.
SLICE_ROWS = 2000
#: Slices of different ids at most; from then on they hold more rows each, which are sorted on disk.
MAX_SLICES = 50_000
_PRINTS = "array<struct<hash:bigint,place:int>>"
_PARTS = 1 << 20


def units(text: Column) -> Column:
    """The units of a non-null text, in order."""
    return F.regexp_extract_all(text, F.lit(UNITS), F.lit(0))


def gram_hashes(units: Column, k: int = K) -> Column:
    """The hash of every run of k units, by place. Fewer than k units: one hash of them all; none: no hash."""
    n = F.size(units)
    many = F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*(F.get(units, i + F.lit(j)) for j in range(k))))
    return F.when(n >= k, many).when(n > 0, F.array(F.xxhash64(units))).otherwise(F.array().cast("array<long>"))


def winnow(hashes: Column, window: int = WINDOW) -> Column:
    """hash and place of the rightmost smallest hash of each window, each once, in order of place; of
    fewer hashes than a window, one."""

    def place(i: Column, a: int, b: int) -> Column:
        """Of the hashes from i + a to i + b, the halves' smallest are compared. Past the end they are null."""
        if b - a == 1:
            return i + F.lit(a)
        least = lambda x, y: F.least(*(F.get(hashes, i + F.lit(j)) for j in range(x, y))) if y - x > 1 else F.get(hashes, i + F.lit(x))
        m = (a + b) // 2
        return F.when(least(m, b) <= least(a, m), place(i, m, b)).otherwise(place(i, a, m))

    last = F.greatest(F.size(hashes) - window, F.lit(0))
    at = F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: place(i, 0, window)))
    chosen = F.transform(at, lambda p: F.struct(F.get(hashes, p).alias("hash"), p.alias("place")))
    return F.when(F.size(hashes) > 0, chosen).otherwise(F.array().cast(_PRINTS))


def places(prints: Column) -> Column:
    """Places of chosen hashes, in units."""
    return prints.getField("place")


def hashes(prints: Column) -> Column:
    """The distinct chosen hashes without their places."""
    return F.array_distinct(prints.getField("hash"))


def as_string(prints: Column) -> Column:
    """hash@place, in hex, comma-separated, in order of place; empty for an empty text."""
    one = lambda x: F.concat(F.lpad(F.hex(x["hash"]), 16, "0"), F.lit("@"), F.hex(x["place"]))
    return F.lower(F.array_join(F.transform(prints, one), ","))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes; two empty ones are alike."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with prints, the hashes chosen from the text (null: empty). Each unit is hashed once."""
    d = docs.withColumn("_hashed", F.transform(units(text_of(text)), lambda u: F.xxhash64(u))).withColumn("_grams", gram_hashes(F.col("_hashed")))
    return d.withColumn("prints", winnow(F.col("_grams"))).drop("_hashed", "_grams")


def slice_tops(ids: DataFrame) -> Counter:
    """The largest id of each slice of about SLICE_ROWS ids (at most MAX_SLICES slices), and how many slices
    it tops: more than one if its rows are as many.

    They are values of the column (percentiles of all rows), so each slice's largest is known.
    """
    parts = max(1, min(MAX_SLICES, ids.count() // SLICE_ROWS))
    at = [i / parts for i in range(1, parts + 1)]
    return Counter(ids.agg(F.percentile_approx("doc_id", at, 10 * max(1000, parts))).first()[0] or [])


def _below(tops: list[int]) -> Column:
    """How many of the ascending tops are below doc_id, by halving: as many steps as their number has bits."""
    array = F.array(*(F.lit(t).cast("long") for t in tops)) if tops else F.array().cast("array<long>")
    n = len(tops)

    def step(found: Column, jump: Column) -> Column:
        further = F.get(array, found + jump - 1) < F.col("doc_id")
        return F.when((found + jump <= n) & F.coalesce(further, F.lit(False)), found + jump).otherwise(found)

    jumps = F.array(*(F.lit(1 << k) for k in range(n.bit_length() - 1, -1, -1))) if n else F.array().cast("array<int>")
    return F.aggregate(jumps, F.lit(0), step)


def _sliced(d: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows of (doc_id, text) with n (copies that a row stands for), th (hash of the text) and slice; the
    first rows of each slice with the slice before it (h_id, h_th or null, before); the number of slices.

    Slices count down the order of ids, null last. An id that tops several slices, and null, is hot: its
    rows are combined where they are alike and cut into slices of their own by th, and the smaller ids of
    its slice follow them.
    """
    spark = d.sparkSession
    ids = d.select("doc_id")
    counted = slice_tops(ids.where("doc_id is not null"))
    tops = sorted(counted)
    hot = {t: k + 1 for t, k in counted.items() if k > 1}
    nulls = ids.where("doc_id is null").count()
    if nulls:
        hot[None] = min(MAX_SLICES, 1 + nulls // SLICE_ROWS)
    own = F.when(F.col("doc_id").isNull(), F.lit(len(tops))).otherwise(F.lit(len(tops) - 1) - _below(tops)).cast("long") * _PARTS
    rest = own + (_PARTS - 1)
    th = F.xxhash64("text").alias("th")
    cut = F.floor((F.lit(2.0**63) - F.col("th").cast("double")) / F.lit(2.0**64) * F.col("parts"))
    heads = [((len(tops) - i) * _PARTS - 1, t, None) for i, t in enumerate(tops) if t not in hot]
    if hot:
        h = F.broadcast(spark.createDataFrame(list(hot.items()), "h_id long, parts int"))
        met = F.col("doc_id").eqNullSafe(F.col("h_id"))
        few = d.join(h, met, "left_anti").select("doc_id", "text", F.lit(1).cast("long").alias("n"), th, rest.alias("slice"))
        many = d.join(h, met).select("doc_id", "text", "parts", th).withColumn("slice", own + F.least(cut, F.col("parts") - 1))
        heads += [(r["slice"], r["doc_id"], r["th"]) for r in many.groupBy("doc_id", "slice").agg(F.max("th").alias("th")).collect()]
        homes = {(len(tops) - i) * _PARTS - 1 for i, t in enumerate(tops) if t in hot}
        smaller = ids.join(h, met, "left_anti").select("doc_id", rest.alias("slice")).where(F.col("slice").isin(homes))
        heads += [(r["slice"], r["top"], None) for r in smaller.groupBy("slice").agg(F.max("doc_id").alias("top")).collect()]
        d = few.unionByName(many.groupBy("doc_id", "text", "th", "slice").agg(F.count("*").alias("n")))
    else:
        d = d.select("doc_id", "text", F.lit(1).cast("long").alias("n"), th, rest.alias("slice"))
    heads.sort(key=lambda x: x[0])
    firsts = [(i, x, heads[k - 1][0]) for k, (_, i, x) in enumerate(heads)]
    return d, spark.createDataFrame(firsts, "h_id long, h_th long, before long"), len(heads)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprint every text and its edited text; see op2 for the columns.

    The next document is the one with the next smaller doc_id, after the last the first; rows alike
    in doc_id follow by the hash of their texts, descending; null ids come last. A table of one row is its
    own next; an empty one gives no rows. A null text is empty. Columns but doc_id and text are not read.
    Each slice of the order gets the first row of the following slice as a guest, so the texts are shuffled
    once (those of hot ids once more, to combine rows alike) and no task holds more than a slice.
    """
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("text", text_of())
    d, firsts, n = _sliced(d)
    first = F.col("doc_id").eqNullSafe(F.col("h_id")) & F.coalesce(F.col("h_th") == F.col("th"), F.lit(True))
    at_home = F.struct("slice", F.lit(False).alias("guest"))
    homes = F.when(F.col("before").isNull(), F.array(at_home)).otherwise(F.array(at_home, F.struct(F.col("before").alias("slice"), F.lit(True).alias("guest"))))
    d = d.join(F.broadcast(firsts), first, "left").select("doc_id", "text", "n", "th", F.explode(homes).alias("home"))
    d = d.select("doc_id", "text", "n", "th", "home.slice", "home.guest").repartition(max(1, n), "slice")
    d = fingerprints(d)
    order = Window.partitionBy("slice").orderBy(F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("th").desc(), F.col("text").desc())
    d = d.select("*", F.lead(F.struct("text", "prints")).over(order).alias("next")).where(~F.col("guest"))
    # of n rows alike, all but the last are followed by their like
    last = F.struct("next", F.lit(1).cast("long").alias("times"))
    like = F.struct(F.struct("text", "prints").alias("next"), (F.col("n") - 1).alias("times"))
    d = d.withColumn("pair", F.explode(F.when(F.col("n") > 1, F.array(last, like)).otherwise(F.array(last))))
    d = d.select("doc_id", "text", "prints", F.col("pair.next.text").alias("next_text"), F.col("pair.next.prints").alias("next_prints"), "pair.times")
    size = F.length("text")
    third = F.floor(size / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), size - third), F.substring(F.col("next_text"), F.lit(1), third))
    d = d.select("doc_id", size.cast("long").alias("n_chars"), F.col("prints").alias("own"), "next_prints", edited.alias("edited"), "times")
    d = fingerprints(d, "edited")
    d = d.select("*", hashes(F.col("own")).alias("a"), hashes(F.col("prints")).alias("b"), hashes(F.col("next_prints")).alias("c"))
    out = d.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("own")).alias("fingerprint"), as_string(F.col("prints")).alias("edited_fingerprint"),
        likeness(F.col("a"), F.col("b")).alias("near_edited"), likeness(F.col("a"), F.col("c")).alias("near_next"), "times",
    )
    return out.withColumn("_", F.explode(F.sequence(F.lit(1).cast("long"), "times"))).drop("times", "_")
