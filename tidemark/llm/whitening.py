"""Whitening of embeddings by an exact covariance: digit-slice GEMM, then eigenvectors.

Entries are fixed-point integers. Each is split into balanced limbs of ``LIMB`` bits, so that a float64
BLAS product of two limb matrices of up to ``BLOCK_ROWS`` rows has no rounding; the products are put
together again as big integers, cut into digits that Spark sums over all tasks, and merged. Only sums
by pairs of dimensions reach the driver, whatever the number of rows. The covariance of integers is then
known exactly, and its eigenvectors are refined against it until their residual is that of a double.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import drop, table

SCALE = 256.0
COMPONENTS = 4
LIMB = 16
#: A limb less another is below 2**16, a product below 2**32: so many of them stay below 2**53.
BLOCK_ROWS = 1 << 20
#: Entries of a block of rows, which bounds a task's memory.
BLOCK_ENTRIES = 1 << 20
#: Rows whose products a long can hold.
FLUSH_ROWS = 1 << 30
_DIGIT = 32
#: Bits of the fixed-point numbers in which eigenvectors are refined, and rounds at most.
_BITS, _ROUNDS = 192, 12


def rows_of(embeddings: DataFrame) -> DataFrame:
    """vec_id and x, the vector as longs floor(256 c), of the rows whose vector is whole: not null, no entry
    null, NaN or infinite. Entries beyond a long's range become its ends. Vectors of another width than
    most rows have (of equally many, the smaller) are dropped, since no covariance takes them."""
    d = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("c"))
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    d = d.where(F.col("c").isNotNull() & (F.size("c") > 0)).where(finite)
    widths = d.groupBy(F.size("c").alias("k")).count().orderBy(F.desc("count"), "k").limit(1).collect()
    d = d.where(F.size("c") == (widths[0][0] if widths else 0))
    return d.select("vec_id", F.transform("c", lambda c: F.floor(F.lit(SCALE) * c).cast("long")).alias("x"))


def limbs(x: np.ndarray) -> list[np.ndarray]:
    """Longs as balanced digits to the base 2**LIMB, as doubles, lowest first; the last is a carry."""
    out, half = [], 1 << (LIMB - 1)
    for _ in range(64 // LIMB):
        low = ((x + half) & ((1 << LIMB) - 1)) - half
        out.append(low.astype(np.float64))
        x = (x >> LIMB) + (low < 0)
    return [*out, x.astype(np.float64)]


def blocks(batches: Iterator[pa.RecordBatch], column: str = "x") -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of the batches with the vectors of each as a matrix."""
    for b in batches:
        if not b.num_rows:
            continue
        width = len(b.column(b.schema.get_field_index(column))[0])
        step = max(1, min(BLOCK_ROWS, BLOCK_ENTRIES // width))
        for at in range(0, b.num_rows, step):
            s = b.slice(at, step)
            yield s, s.column(s.schema.get_field_index(column)).flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(s.num_rows, width)


def digits(value: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of a whole number to the base 2**32; the last digit carries the sign."""
    k = 0
    while value not in (0, -1):
        if low := value & ((1 << _DIGIT) - 1):
            yield k, low
        value >>= _DIGIT
        k += 1
    if value:
        yield k, value


def merged(parts: DataFrame) -> dict[tuple[int, int], int]:
    """The sums by (i, j) of rows i, j, place, digit; a number of rows that only the width bounds."""
    out: dict[tuple[int, int], int] = {}
    for i, j, k, v in parts.groupBy("i", "j", "place").agg(F.sum("digit")).collect():
        out[i, j] = out.get((i, j), 0) + (v << (_DIGIT * k))
    return out


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums S and the matrix n * sum (x - m)(x - m)' - s s' (s: sums of x - m) of exact integers, for
    m the rounded mean: n * n times the covariance, centred before it is multiplied."""
    n = fit.count()

    def sums(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        for k, part in enumerate(limbs(x)):
            yield LIMB * k, part.sum(axis=0, keepdims=True)

    found = merged(_parts(fit, sums))
    total = [found.get((0, i), 0) for i in range(width)]
    mean = [s // n for s in total]
    centre = limbs(np.array([mean], dtype=np.int64))

    def gram(x: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        parts = [a - c for a, c in zip(limbs(x), centre)]
        used = [k for k, p in enumerate(parts) if p.any()]
        for a in used:
            for b in (b for b in used if b >= a):
                product = parts[a].T @ parts[b]
                yield LIMB * (a + b), np.triu(product + product.T if a != b else product)

    g = merged(_parts(fit, gram))
    rest = [s - n * m for s, m in zip(total, mean)]
    v = np.empty((width, width), dtype=object)
    for i in range(width):
        for j in range(i, width):
            v[i, j] = v[j, i] = n * g.get((i, j), 0) - rest[i] * rest[j]
    return n, total, v


def _parts(fit: DataFrame, of) -> DataFrame:
    """Each task's own sums of the (shift, matrix) that ``of`` gives for its blocks, as digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole: dict[tuple[int, int], int] = {}
        own: dict[int, np.ndarray] = {}
        rows = 0

        def flush() -> None:
            for shift, m in own.items():
                for i, j in zip(*np.nonzero(m)):
                    whole[i, j] = whole.get((i, j), 0) + (int(m[i, j]) << shift)
            own.clear()

        for _, x in blocks(batches):
            if (rows := rows + len(x)) > FLUSH_ROWS:
                flush()
                rows = len(x)
            for shift, m in of(x):
                m = m.astype(np.int64)
                own[shift] = own[shift] + m if shift in own else m
        flush()
        out = [(i, j, k, v) for (i, j), value in whole.items() for k, v in digits(value)]
        for at in range(0, len(out), 1 << 16):
            some = out[at : at + (1 << 16)]
            types = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in some], t) for c, t in enumerate(types)], ["i", "j", "place", "digit"])

    return fit.select("x").mapInArrow(run, "i int, j int, place int, digit long")


def exact_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two matrices of whole numbers of any size, by float64 products of their digits."""
    widest = max((abs(int(x)).bit_length() for x in (*a.ravel(), *b.ravel())), default=0)
    count = widest // 16 + 1

    def parts(m: np.ndarray) -> np.ndarray:
        raw = b"".join(abs(int(x)).to_bytes(2 * count, "little") for x in m.ravel())
        sign = np.array([-1.0 if x < 0 else 1.0 for x in m.ravel()]).reshape(m.shape)
        return np.moveaxis(np.frombuffer(raw, "<u2").reshape(*m.shape, count), 2, 0) * sign

    x, y = parts(a), parts(b)
    out = np.zeros((a.shape[0], b.shape[1]), dtype=object)
    for s in range(2 * count - 1):
        term = sum(x[k] @ y[s - k] for k in range(max(0, s - count + 1), min(count, s + 1)))
        out = out + (term.astype(np.int64).astype(object) << (16 * s))
    return out


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: tuple[int, ...]
    #: Of each component: eigenvalue, its share of the trace, unit vector.
    values: tuple[float, ...]
    shares: tuple[float, ...]
    vectors: tuple[tuple[float, ...], ...]


def eigen(v: np.ndarray, n: int, components: int = COMPONENTS) -> tuple[list[float], list[float], np.ndarray]:
    """Eigenvalues of v / n**2, their shares of the trace, and unit vectors as rows, by falling value.

    v holds exact integers. The vectors of a double-precision solver are corrected in fixed-point numbers of
    192 bits until they diagonalise v (each round squares the error), so that small values beside large ones
    are right too. Values that are exactly 0, or too small for those bits, count as 0.
    """
    width, one = len(v), 1 << _BITS
    top = max(max(abs(int(x)) for x in v.ravel()), 1)
    _, start = np.linalg.eigh(np.array([[int(x) / top for x in row] for row in v]))
    u = np.array([[int(x * 2**60) << (_BITS - 60) for x in row] for row in start[:, ::-1]], dtype=object)
    shift = max(0, _BITS - top.bit_length())
    scaled = v * (1 << shift) if shift else v // (1 << (top.bit_length() - _BITS))
    values = np.zeros(width, dtype=object)
    for _ in range(_ROUNDS):
        r = -(exact_product(u.T, u) >> _BITS)
        r[np.diag_indices(width)] += one
        s = exact_product(u.T, exact_product(scaled, u) >> _BITS) >> _BITS
        norm = one - r[np.diag_indices(width)]
        values = np.array([(int(a) << _BITS) // int(b) for a, b in zip(s.diagonal(), norm)], dtype=object)
        gap = values[None, :] - values[:, None]
        noise = max((abs(int(x)) for x in (s - np.diag(s.diagonal())).ravel()), default=0) + (max(abs(int(x)) for x in r.ravel()) * top >> _BITS)
        e = np.empty_like(r)
        for i in range(width):
            for j in range(width):
                lone = i != j and abs(gap[i, j]) > 2 * noise
                e[i, j] = ((int(s[i, j]) + (int(values[j]) * int(r[i, j]) >> _BITS)) << _BITS) // int(gap[i, j]) if lone else int(r[i, j]) >> 1
        u = u + (exact_product(u, e) >> _BITS)
        if max(abs(int(x)) for x in e.ravel()) < 1 << (_BITS - 64):
            break
    order = sorted(range(width), key=lambda i: -values[i])
    trace = max(int(sum(scaled.diagonal())), 1)
    floor = width << 16  # what fixed-point rounding leaves of a value of 0
    found = [int(values[i]) if values[i] > floor else 0 for i in order[:components]]
    unit = np.array([[int(x) / one for x in u[:, i]] for i in order[:components]]).reshape(-1, width)
    own = [k * (1 / n) / n for k in (f / (1 << shift) if shift else float(f << (top.bit_length() - _BITS)) for f in found)]
    return own, [k / trace for k in found], unit


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors of a column x of long arrays of one width; None without rows."""
    distinct = table(vectors.select("x").distinct(), "whitening-fit")
    first = distinct.limit(1).collect()
    if not first:
        return None
    n, total, v = moments(distinct, len(first[0][0]))
    values, shares, unit = eigen(v, n, components)
    drop(distinct)
    return Whitening(n, tuple(total), tuple(values), tuple(shares), tuple(map(tuple, unit)))


def project(vectors: DataFrame, model: Whitening, *carry: str) -> DataFrame:
    """The columns to carry, deviation and whitened (an array of doubles, one for each component; null for
    a component without variance) of each row. deviation is null where it is beyond a long."""
    total = model.sums
    scale = np.array([1 / np.sqrt(e) if e > 0 else np.nan for e in model.values])
    unit = np.array(model.vectors).T
    out = T.StructType([*vectors.select(*carry).schema, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.array(total, dtype=object), model.n
        bound = max((abs(s) for s in total), default=0)
        for b, x in blocks(batches):
            if n * max(int(x.max()), -int(x.min())) + bound < 1 << 53:
                far = n * x - sums.astype(np.int64)
                rough = (far.astype(np.float64) ** 2).sum(axis=1)
                exact = (far * far).sum(axis=1)
                deviation = [int(e) if q < 2.0**62 else None for e, q in zip(exact, rough)]
            else:
                far, deviation = n * x.astype(object) - sums, [None] * len(x)
            for i in (i for i, k in enumerate(deviation) if k is None):
                k = sum(int(c) ** 2 for c in far[i])
                deviation[i] = k if k < 1 << 63 else None
            centred = (far / n).astype(np.float64)
            w = (centred @ unit) * scale
            flat = pa.array(w.ravel(), pa.float64(), from_pandas=True)
            whitened = pa.ListArray.from_arrays(np.arange(0, w.size + 1, w.shape[1], dtype=np.int32), flat)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(carry))), pa.array(deviation, pa.int64()), whitened], [*carry, "deviation", "whitened"])

    return vectors.select(*carry, "x").mapInArrow(run, out)


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """The largest absolute entry of the covariance of the whitened distinct vectors less the identity,
    measured over them; components without variance are left out."""
    live = [k for k, e in enumerate(model.values) if e > 0]
    if not live:
        return 0.0
    w = project(vectors.select("x").distinct(), model)
    pairs = [(a, b) for a in live for b in live if a <= b]
    got = w.agg(*(F.covar_pop(F.get("whitened", a), F.get("whitened", b)) for a, b in pairs)).first()
    return max(abs(c - (a == b)) for (a, b), c in zip(pairs, got))


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row for each whole vector of embeddings (vec_id, embedding) and component up to ``components``
    or the width: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows without a whole vector are dropped (see rows_of). Repeated vectors count once in the fit and have
    rows of their own in the result, as have repeated or missing vec_ids. Components of equal values are any
    orthonormal basis, the same for all rows; one without variance has whitened null and explained 0. No
    whole vector, no rows. Other columns are not read.
    """
    d = rows_of(embeddings)
    model = fit(d, components)
    shape = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None:
        return embeddings.sparkSession.createDataFrame([], shape)
    error = identity_error(d, model)
    explained = F.array(*map(F.lit, model.shares))
    out = project(d, model, "vec_id").select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return out.select("vec_id", (F.col("k") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", F.get(explained, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))
