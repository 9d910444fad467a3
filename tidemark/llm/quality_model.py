"""Quality classifier: histogram gradient-boosted trees over document statistics.

The statistics are computed on whole texts in Arrow batches. A model is trained with numpy on a
bounded sample of labelled rows and is a handful of flat arrays: all rows of a batch go down all
levels of a tree at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most: those of the smallest hashes of doc_id.
SAMPLE_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
LEAF_ROWS = 10
L2 = 1.0
SEED = 7

STATISTICS = ("log_words", "log_chars", "mean_word", "upper", "lower", "digit", "space", "newline", "ascii_punct", "symbol", "pipe", "exclaim", "comma_stop", "high", "distinct_words", "distinct_blocks", "line_repeat", "line_words", "gram_repeat", "entropy")

_CLASSES = np.zeros((256, 11), np.float64)
for _k, _bytes in enumerate((range(65, 91), range(97, 123), range(48, 58), b" \t\v\f\r", b"\n", b"!\"'()*+,-./:;=?@[\\]^_`{}~#$%&<>|", b"#*$%&<>", b"|", b"!", b",.", range(128, 256))):
    _CLASSES[list(_bytes), _k] = 1


def statistics(text: str | None) -> list[float]:
    """One number for each of STATISTICS; an empty text has zeros. No label, id, language or source."""
    raw = (text or "").encode()
    if not raw:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = (counts @ _CLASSES) / len(raw)
    p = counts[counts > 0] / len(raw)
    words = raw.split()
    n = len(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    blocks = [words[i : i + 200] for i in range(0, n, 200)]
    grams = len({hash(x) for x in zip(words, words[1:], words[2:])}) if n > 2 else 0
    return [
        np.log1p(n), np.log1p(len(raw)), sum(map(len, words)) / max(1, n), *share,
        len(set(words)) / max(1, n), sum(len(set(b)) / len(b) for b in blocks) / max(1, len(blocks)), 1 - len(set(lines)) / max(1, len(lines)),
        np.log1p(n / max(1, len(lines))), 1 - grams / (n - 2) if n > 2 else 0.0, float(-(p * np.log2(p)).sum()),
    ]


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns keep of docs, and stats, the statistics of its text, as array<double>."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            stats = pa.array([statistics(t) for t in b.column(len(keep)).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], stats], [*keep, "stats"])

    d = docs.select(*keep, F.col("text").cast("string").alias("text"))
    types = dict(d.dtypes)
    return d.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keep), "stats array<double>"]))


@dataclass
class Trees:
    """Flat arrays: node k of tree t has children 2k+1 and 2k+2; leaves are at the last level."""

    edges: list[np.ndarray]
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    base: float

    def binned(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(self.edges)], axis=1).astype(np.int16)

    def score(self, x: np.ndarray) -> np.ndarray:
        b, rows = self.binned(x), np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, cut, value in zip(self.feature, self.cut, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                node = 2 * node + 1 + (b[rows, feature[node]] > cut[node])
            total += value[node - len(feature)]
        return 1 / (1 + np.exp(-total))


def train(x: np.ndarray, y: np.ndarray) -> Trees:
    """Boosted trees of logistic loss. Rows of one label only, or no rows, give a constant score."""
    positives = float(y.sum())
    base = float(np.log((positives + 0.5) / (len(y) - positives + 0.5)))
    width = len(STATISTICS)
    x = x.reshape(-1, width)
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(x) else np.zeros(0) for j in range(width)]
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    model = Trees(edges, np.zeros((0, inner), np.int64), np.zeros((0, inner), np.int64), np.zeros((0, leaves)), base)
    if positives in (0, len(y)):
        return model
    b = model.binned(x).astype(np.int64)
    # where bin b of feature j counts for the node n: one row of a histogram for each node
    places = b + np.arange(width) * BINS
    total = np.full(len(y), base)
    kept = []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, BINS, np.int64)
        for level in range(DEPTH):
            first, n = 2**level - 1, 2**level
            at = ((node - first)[:, None] * (width * BINS) + places).ravel()
            hist = [np.bincount(at, np.repeat(w, width), n * width * BINS).reshape(n, width, BINS).cumsum(axis=2) for w in (g, h, np.ones(len(y)))]
            (gl, hl, nl), (gt, ht, nt) = hist, (a[:, :, -1:] for a in hist)
            gain = gl**2 / (hl + L2) + (gt - gl) ** 2 / (ht - hl + L2) - gt**2 / (ht + L2)
            gain = np.where((nl >= LEAF_ROWS) & (nt - nl >= LEAF_ROWS), gain, 0).reshape(n, -1)
            best = gain.argmax(axis=1)
            use = gain[np.arange(n), best] > 1e-9
            feature[first : first + n] = np.where(use, best // BINS, 0)
            cut[first : first + n] = np.where(use, best % BINS, BINS)
            node = 2 * node + 1 + (b[np.arange(len(y)), feature[node]] > cut[node])
        leaf = node - inner
        value = -RATE * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + L2)
        total += value[leaf]
        kept.append((feature, cut, value))
    model.feature, model.cut, model.value = (np.array(a) for a in zip(*kept))
    return model


def crc_mod(n: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo n."""
    return F.pmod(F.crc32(F.coalesce(F.col(col).cast("string"), F.lit("")).cast("binary")), F.lit(n))


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Trees:
    """A model of labels.quality on at most rows labelled rows, those of the smallest hashes of doc_id.

    Null ids and labels are left out; of an id's several labels the largest counts, and of its several
    texts each. The statistics of the sample are computed by the executors and sent to the driver.
    """
    own = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    own = own.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    d = docs.select("doc_id", "text").join(F.broadcast(own), "doc_id")  # at most rows pairs of numbers
    got = with_statistics(d, "doc_id", "quality").orderBy(F.xxhash64("doc_id"), "doc_id", "stats").limit(rows).toArrow()
    x = np.array(got.column("stats").to_pylist(), np.float64)
    return train(x, np.array(got.column("quality").to_pylist(), np.float64))


def score(docs: DataFrame, model: Trees, *keep: str) -> DataFrame:
    """The columns keep of docs, and score, how likely label 1 is. Each row of docs gives one row;
    a null text counts as empty and is scored, too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some 100 kB, whatever the input

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(len(keep)).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array(shared.value.score(x))], [*keep, "score"])

    d = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    types = dict(d.dtypes)
    return d.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keep), "score double"]))
