"""Language identification by string kernels.

Two texts are compared by a blended-spectrum presence kernel: how many n-grams of 1 to 3 code points
both contain, over the root of the product of their own numbers. Landmark texts give a Nyström map,
and one-versus-rest kernel ridge regression is solved in it. The landmarks are broadcast to the executors,
which map the sampled texts and add up what the regression needs, so of the sample only the landmarks and
sums whose size is that of the map reach the driver. As the kernel is an inner product of presence
vectors (hashed to DIMENSION places), a batch of texts is scored by one product of its presence rows with
the landmarks, or with landmarks and regression folded into one matrix where languages are fewer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import drop, table

DIMENSION = 1 << 15
LANDMARKS = 256
RIDGE = 1e-2
#: Landmarks at most: of more languages than LANDMARKS each has one, up to this number.
MOST_LANDMARKS = 1024
#: Tasks that add up the regression's sums.
PARTS = 16
#: Labelled texts of a language that a model is fitted on, in the mean.
SAMPLE_PER_LANG = 400
#: Labelled texts that a model is fitted on, in the mean; of very many languages each has fewer.
SAMPLE_ROWS = 50_000
UNKNOWN = "und"
_ODD = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))
_SHIFT = np.uint32(32 - 15)


def has_letter(text: str) -> bool:
    """Whether a code point is of Unicode's category L."""
    return any(map(str.isalpha, text))


def presence(text: str | None) -> np.ndarray:
    """Which of the hashed n-grams of the whole text, in lower case, are there."""
    out = np.zeros(DIMENSION, bool)
    c = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), np.uint32)
    h = np.zeros(len(c) + 1, np.uint32)
    for n, odd in enumerate(_ODD):
        if len(c) <= n:
            break
        h = (h[:-1] if n == 0 else h[:-1] * np.uint32(0x01000193)) + c[n:]  # of the n + 1 code points from each place
        mixed = (h ^ (h >> np.uint32(15))) * odd
        out[(mixed ^ (mixed >> np.uint32(13))) * np.uint32(0x27D4EB2F) >> _SHIFT] = True
    return out


def normed(bits: list[bytes]) -> np.ndarray:
    """Packed presence vectors as rows of length 1."""
    x = np.unpackbits(np.frombuffer(b"".join(bits), np.uint8).reshape(len(bits), -1), axis=1).astype(np.float32)
    return x / np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))


@dataclass
class Model:
    """A language's score is the text's presence row times first, times second if there is one: DIMENSION
    numbers a language, or a landmark's bits and a number for each landmark and language."""

    langs: list[str]
    first: np.ndarray  # DIMENSION x languages, or packed landmarks
    second: np.ndarray | None = None  # landmarks x languages

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """A language and a score of 0 to 1 for each text; UNKNOWN and 0 for null or without letters."""
        x = np.stack([presence(t) for t in texts]).astype(np.float32)
        size = np.sqrt(np.maximum(1, x.sum(axis=1, keepdims=True)))
        out = (x @ self.first if self.second is None else (x @ normed(list(self.first)).T) @ self.second) / size
        e = np.exp(6 * (out - out.max(axis=1, keepdims=True)))
        best = out.argmax(axis=1)
        known = [t is not None and has_letter(t) for t in texts]
        score = np.where(known, (1 / e.sum(axis=1)), 0.0)
        return [self.langs[k] if ok else UNKNOWN for k, ok in zip(best, known)], score.astype(np.float64)


def sample(docs: DataFrame, per_lang: int) -> DataFrame:
    """A written table of lang, unit (the hash that a row is chosen by), bits (packed presence) and n (rows
    alike in all three), of about per_lang rows of each language, SAMPLE_ROWS of all. Rows are chosen by id
    and text, so rows that share an id, or have none, are chosen one by one."""
    d = docs.where("lang is not null and text is not null").select("doc_id", "lang", "text")
    counts = table(d.groupBy("lang").count(), "languages")
    per_lang = max(1, min(per_lang, SAMPLE_ROWS // max(1, counts.count())))
    unit = F.pmod(F.xxhash64("doc_id", "text", F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    d = d.withColumn("unit", unit).join(counts, "lang").where(F.col("unit") < F.lit(float(per_lang)) / F.col("count")).select("lang", "unit", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                own = b.slice(at, 128)
                bits = [np.packbits(presence(t)).tobytes() if has_letter(t) else None for t in own.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), pa.array(bits, pa.binary())], ["lang", "unit", "bits"])

    found = d.mapInArrow(run, "lang string, unit double, bits binary").where("bits is not null")
    out = table(found.groupBy("lang", "unit", "bits").agg(F.count("*").alias("n")), "language-sample")
    drop(counts)
    return out


def sums(rows: DataFrame, z: np.ndarray, root: np.ndarray, langs: list[str], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Over the rows of a sample, mapped by landmarks z (packed) and root: the weighted sum of phi phi', and
    of phi by language. The tasks' own sums are added in order, so that reruns agree."""
    place = {name: k for k, name in enumerate(langs)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = normed(list(z))
        square, own = np.zeros((root.shape[1],) * 2), np.zeros((len(langs), root.shape[1]))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                s = b.slice(at, 256)
                phi = (normed(s.column(1).to_pylist()) @ marks.T).astype(np.float64) @ root
                lang = np.array([place[x] for x in s.column(0).to_pylist()])
                heavy = phi * (weights[lang] * s.column(2).to_numpy())[:, None]
                square += phi.T @ heavy
                np.add.at(own, lang, heavy)
        yield pa.RecordBatch.from_arrays([pa.array([square.tobytes()]), pa.array([own.tobytes()])], ["square", "own"])

    parts = rows.repartitionByRange(PARTS, "unit", "lang").sortWithinPartitions("unit", "lang", "bits").select("lang", "bits", "n")
    got = parts.mapInArrow(run, "square binary, own binary").collect()
    square = sum(np.frombuffer(r["square"]).reshape((root.shape[1],) * 2) for r in got)
    return square, sum(np.frombuffer(r["own"]).reshape(len(langs), -1) for r in got)


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """A model of docs.lang from a sample of its rows: about per_lang of each language, and SAMPLE_ROWS in
    the mean of all. Null languages and texts without letters are left out. Languages count alike,
    however many rows they have. Landmarks are dealt evenly over the languages, those of the smallest hash.

    The driver holds MOST_LANDMARKS presence vectors of 4 kB at most and matrices of landmarks by landmarks
    and by languages; the model has as many numbers as landmarks times languages at most, besides the
    landmarks. Repeated rows count as often as they are there; ties of the hash are ordered by vector. An
    empty table gives a model that predicts UNKNOWN. Columns but doc_id, text and lang are not read.
    """
    rows = sample(docs, per_lang)
    found = sorted((r["lang"], r["n"]) for r in rows.groupBy("lang").agg(F.sum("n").alias("n")).collect())
    langs = [lang for lang, _ in found]
    if not langs:
        return Model([UNKNOWN], np.zeros((DIMENSION, 1), np.float32))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("unit", "bits"))
    marks = rows.withColumn("rank", rank).where(F.col("rank") <= max(1, LANDMARKS // len(langs)))
    z = [bytes(r["bits"]) for r in marks.orderBy("rank", "unit", "lang").limit(MOST_LANDMARKS).select("bits").collect()]
    x = normed(z)
    value, vector = np.linalg.eigh((x @ x.T).astype(np.float64))
    good = value > 1e-6 * value.max()
    root = vector[:, good] / np.sqrt(value[good])  # K_mm ** -1/2
    square, own = sums(rows, np.array(z, object), root, langs, np.array([1 / n for _, n in found]))
    target = (2 * own - own.sum(axis=0)).T  # 1 for the own language, -1 for the rest
    w = root @ np.linalg.solve(square + RIDGE * np.eye(len(square)) / len(langs), target)
    drop(rows)
    if len(langs) <= len(z):
        return Model(langs, (x.T @ w).astype(np.float32))
    return Model(langs, np.array(z, object), w.astype(np.float32))


def predict(docs: DataFrame, model: Model, *keep: str) -> DataFrame:
    """The columns keep of docs, lang_pred and score; one row for each row of docs, repeated or not.

    A null text, and one without a letter, is UNKNOWN with score 0; whole texts count, however long; of
    equal scores the language that sorts first is taken; an empty table gives no rows. keep must not name
    a column lang_pred or score.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by fit

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                own = b.slice(at, 128)
                lang, score = shared.value.predict(own.column(len(keep)).to_pylist())
                yield pa.RecordBatch.from_arrays([*own.columns[: len(keep)], pa.array(lang), pa.array(score)], [*keep, "lang_pred", "score"])

    d = docs.select(*keep, F.col("text").cast("string").alias("_text"))
    types = dict(d.dtypes)
    return d.mapInArrow(run, ", ".join([*(f"`{k}` {types[k]}" for k in keep), "lang_pred string, score double"]))
