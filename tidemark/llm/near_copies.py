"""Near copies of whole texts: those whose 5-word shingles have a Jaccard index of 0.8 or more.

Fingerprints of such pairs differ in up to a sixth of their bits, too many for the shards of BK-trees:
blocks that two of them must share would have five bits. So the trees give only the closest
candidates, within simhash.RADIUS, and MinHash bands the rest: BANDS bands of BAND_ROWS values let a
pair of similarity 0.8 collide with probability 0.9998. Every candidate is verified by its exact index.

Texts of the same words, A-Z in either case, are one wording; only distinct wordings meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import bands, simhash
from tidemark.llm.common import checked, drop, table

BANDS, BAND_ROWS = 16, 4


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _wording(words: list[bytes]) -> int:
    return int(np.uint64(xxhash.xxh3_64_intdigest(b" ".join(words))).astype(np.int64))


def text_key(text: str | Column = "text") -> Column:
    """Tells the texts of rows alike in doc_id apart; a null text has one, too."""
    return F.xxhash64(text)


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, th (text_key), node (hash of the wording), fp (SimHash of its 5-word shingles), keys (of
    its bands; none without words)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, bands.SLICE):
                own = b.slice(at, bands.SLICE)
                words = [_words(t) for t in own.column(2).to_pylist()]
                sets = [bands.shingles(w) for w in words]
                full = [s for s in sets if len(s)]
                keys = iter(bands.band_keys(np.concatenate([*full, np.zeros(0, np.uint64)]), bands.ends(full), BANDS, BAND_ROWS))
                keys = [next(keys) if len(s) else np.zeros(0, np.int64) for s in sets]
                fp = np.array([simhash.majority(s) for s in sets], np.uint64).view(np.int64)
                cols = [own.column(0), own.column(1), pa.array([_wording(w) for w in words], pa.int64()), pa.array(fp), bands.lists(keys, pa.array(np.concatenate(keys)))]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "th", "node", "fp", "keys"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return own.select("doc_id", text_key().alias("th"), "text").mapInArrow(run, "doc_id long, th long, node long, fp long, keys array<long>")


def wording_shingles(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """node, sh of the wanted (doc_id, th, node), a written table."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, bands.SLICE):
                own = b.slice(at, bands.SLICE)
                sh = [np.unique(bands.shingles(_words(t))).view(np.int64) for t in own.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), bands.lists(sh, pa.array(np.concatenate(sh)))], ["node", "sh"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    own = own.withColumn("th", text_key()).alias("d").join(checked(wanted).alias("w"), F.expr("d.doc_id <=> w.doc_id and d.th = w.th"))
    return own.select("node", "text").mapInArrow(hashed, "node long, sh array<long>").dropDuplicates(["node"])


def kept(docs: DataFrame) -> DataFrame:
    """doc_id, th (text_key), n: the one document of each group of near copies that stays.

    It is the first in the order of (doc_id, th), null ids last. Rows alike in doc_id and text are one
    document and n is their number. A null text has no words, like an empty or blank one. No rows, no rows.
    """
    rows = table(signatures(docs), "near-rows")
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th")
    own = table(rows.groupBy("doc_id", "th", "node").agg(F.count("*").alias("n"), F.min("fp").alias("fp")), "near-documents")
    # equal wordings have equal keys; their copies are combined before the shuffle
    one = table(own.groupBy("node").agg(F.min(place).alias("f"), F.min("fp").alias("fp")), "near-wordings")
    trees = simhash.links(one.select("fp").distinct())
    ends = trees.select(F.explode(F.array("a", "b")).alias("fp"), F.xxhash64("a", "b").alias("key"))
    same = one.select("node", F.xxhash64(F.lit("fp"), "fp").alias("key"))
    met = one.select("node", "fp").join(ends, "fp").select("node", "key").unionByName(same)
    met = bands.shared(met.unionByName(rows.select("node", F.explode("keys").alias("key")).distinct()), "near")
    wanted = table(met.select("node").distinct().join(one, "node").select("f.doc_id", "f.th", "node"), "near-wanted")
    sh = table(wording_shingles(docs, wanted), "near-shingles")
    comp = bands.linked(met, sh, "near")
    named = one.join(comp, "node", "left").select("f", F.coalesce("component", "node").alias("component"))
    first = named.groupBy("component").agg(F.min("f").alias("f")).select("f.doc_id", "f.th")
    out = own.alias("o").join(first.alias("f"), F.expr("o.doc_id <=> f.doc_id and o.th = f.th"), "left_semi").select("doc_id", "th", "n")
    out = table(out, "near-kept")
    drop(rows, own, one, met, wanted, sh, comp)
    return out
