"""Removal of repeated byte strings by a suffix structure of the whole collection.

Suffixes of whole documents can't be inserted column by column: as many rounds as the longest text has
bytes would each pass over the corpus. Only strings of ``WIDTH`` bytes matter, so texts are first cut into
overlapping pieces by content: every string of WIDTH bytes lies in the piece of its minimizer (the
``KEY``-byte substring of least hash), equal strings have equal minimizers, and a piece has few bytes. Pieces
are dealt out by their minimizer. One that is alone there holds nothing that repeats; of equal pieces all
but the first go; the distinct ones that share a minimizer are inserted, column by column, into one
Burrows-Wheeler transform with its common prefixes for each stretch of minimizers (collection_bwt), in which
the first of every group of equal strings is found. The first strings stay, all others are removed.

Equal pieces are combined before the shuffle. A minimizer that very many distinct pieces share is taken
apart into its single strings, which are equal or not, so no group is larger than a task can hold.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import collection_bwt
from tidemark.llm.common import BROADCAST_ROWS, checked, drop, shared_dir, table, text_of

WIDTH = 100
#: Bytes of a minimizer, a power of two, and its places within a string of WIDTH bytes.
KEY = 32
REACH = WIDTH - KEY + 1
#: Into how many classes the places of a minimizer are parted to find the shared part of a piece.
CLASSES = 4
_EDGES = [REACH * k // CLASSES for k in range(CLASSES + 1)]
#: Keys whose longest pieces differ by fewer bytes share a transform.
LENGTHS = 12
#: Bytes of the pieces that are compared at a time.
COLLECTION_BYTES = 8 << 20
#: Distinct pieces of a minimizer above which it is taken apart.
CROWD = 1024
#: Distinct pieces of a minimizer in one batch from which it is counted for that.
CROWD_IN_BATCH = 4
#: Bytes of text whose pieces are combined before the shuffle.
BATCH_BYTES = 32 << 20
#: Bytes of text that are hashed at a time; places in them have 16 bits.
_STRETCH = 1 << 15
_PLACE = np.uint64(0xFFFF)
#: Odd numbers for the doublings, drawn once for all.
_ODD = np.random.Generator(np.random.PCG64(12)).integers(0, 1 << 63, KEY, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: A document is known by its id and the hash of its text.
DOC = ("doc_id", "th")
#: done: an equal piece stands earlier in the batch, so key is only where the row is dealt to.
PIECE = "key long, content long, doc_id long, th long, start long, n int, twice boolean, done boolean"
#: gone: the strings that begin at start, start + 1, ... (n of them) are removed; else they are to be compared.
SETTLED = "gone boolean, key long, crowded boolean, doc_id long, th long, start long, n int, twice boolean"
GONE = "doc_id long, th long, start long, n int"
SPANS = "spans array<struct<start: bigint, stop: bigint>>"


def documents(docs: DataFrame) -> DataFrame:
    """doc_id, th and the bytes of the text (null: empty) of every row."""
    text = text_of(F.col("text").cast("string"))
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("th"), text.cast("binary").alias("bytes"))


def _gram_hashes(text: np.ndarray) -> np.ndarray:
    """A hash of the KEY bytes from each place, by doubling from words of four."""
    if len(text) < KEY:
        return np.empty(0, np.uint64)
    words = np.ndarray(len(text) - 3, "<u4", np.ascontiguousarray(text), strides=(1,))
    x, k = words.astype(np.uint64) * _ODD[0], 4
    x ^= x >> np.uint64(31)
    while k < KEY:
        y = x[:-k] * _ODD[k]
        y += x[k:]
        x, k = y, 2 * k
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def _least(x: np.ndarray) -> np.ndarray:
    """The least of each REACH values in a row."""
    k = 1
    while 2 * k <= REACH:
        x, k = np.minimum(x[:-k], x[k:]), 2 * k
    return np.minimum(x[: len(x) - (REACH - k)], x[REACH - k :]) if k < REACH else x


def _digest(h: np.ndarray, start: np.ndarray, last: np.ndarray, n: np.ndarray, seed: int) -> np.ndarray:
    """A hash of the bytes from start to the KEY bytes at last, from hashes that cover them."""
    out = n.astype(np.uint64) ^ np.uint64(seed)
    for k in range(0, 2 * WIDTH, KEY):
        out = (out ^ h[np.minimum(start + k, last)]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return out


def _repeat(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of counts[i] copies of i: i, and which copy it is."""
    of = np.repeat(np.arange(len(counts)), counts)
    return of, np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)


def cut(text: np.ndarray, bounds: np.ndarray, apart: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Pieces of concatenated texts, text k at bounds[k]:bounds[k + 1]: key, content (hashes of the minimizer
    and of all bytes), text number, start within it, n (strings of WIDTH bytes that begin in it), twice
    (whether the minimizer's hash stands elsewhere in the piece too). Of keys in apart (sorted) each string is
    a piece with a key of its own. A stretch of text at a time; a piece that crosses its end is cut there."""
    for at in range(0, len(text) - WIDTH + 1, _STRETCH):
        own = text[at : at + _STRETCH + WIDTH - 1]
        h = _gram_hashes(own)
        best = _least((h & ~_PLACE) | np.arange(len(h), dtype=np.uint64))
        size = len(best)
        lo, hi = np.searchsorted(bounds, (at, at + size))
        inside = bounds[lo:hi] - at
        mark = np.append(True, best[1:] != best[:-1])
        mark[inside[inside < size]] = True
        begin = np.flatnonzero(mark)
        key = h[(best[begin] & _PLACE).astype(np.int64)]
        doc = np.searchsorted(bounds, begin + at, side="right") - 1
        new = np.ones(len(begin), bool)  # runs of one hash in one text are a piece, cut at REACH strings
        new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        first = np.flatnonzero(new)
        twice = np.diff(np.append(first, len(begin))) > 1
        start, key, doc = begin[first], key[first], doc[first]
        end = np.minimum(np.append(start[1:], size), bounds[doc + 1] - WIDTH + 1 - at)
        ok = end > start
        start, end, key, doc, twice = start[ok], end[ok], key[ok], doc[ok], twice[ok]
        single = apart[np.minimum(np.searchsorted(apart, key), len(apart) - 1)] == key if len(apart) else np.zeros(len(key), bool)
        step = np.where(single, 1, REACH)
        of, k = _repeat(-(-(end - start) // step))
        start = start[of] + step[of] * k
        end = np.minimum(start + step[of], end[of])
        key, doc, single, twice = key[of], doc[of], single[of], twice[of] & ~single[of]
        n, last = end - start, end - 1 + WIDTH - KEY
        content = _digest(h, start, last, n, 0)
        if single.any():
            key[single] = _digest(h, start[single], last[single], n[single], 0x5851F42D4C957F2D)
        yield key.view(np.int64), content.view(np.int64), doc, start + at - bounds[doc], n, twice


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column in a row, and where each value begins and the last ends."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8))[at[0] : at[-1]], at - at[0]


def _stretches(batches: Iterator[pa.RecordBatch], apart: np.ndarray) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the rows of documents(), of about BATCH_BYTES, with their pieces."""
    for b in batches:
        if not b.num_rows:
            continue
        _, bounds = _flat(b.column(2))
        cuts = np.unique(np.searchsorted(bounds, np.arange(0, bounds[-1] + BATCH_BYTES, BATCH_BYTES)))
        cuts = [0, *(int(c) for c in cuts if 0 < c < b.num_rows), b.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            s = b.slice(lo, hi - lo)
            text, own = _flat(s.column(2))
            if parts := list(cut(text, own, apart)):
                yield s, [np.concatenate(c) for c in zip(*parts)]


def _in_groups(values: np.ndarray, least: int) -> np.ndarray:
    """Where the values are that occur so often at least."""
    by = np.argsort(values)
    begin = np.flatnonzero(np.append(True, values[by][1:] != values[by][:-1]))[: len(values)]
    counts = np.diff(np.append(begin, len(values)))
    return by[np.repeat(counts >= least, counts)]


def _order(b: pa.RecordBatch) -> np.ndarray:
    """The rank of each row's document in its batch: by id (null last), then by the hash of the text."""
    none = b.column(0).is_null().to_numpy(zero_copy_only=False)
    by = np.lexsort((b.column(1).to_numpy(), b.column(0).fill_null(0).to_numpy(), none))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return rank


def crowded_keys(docs: DataFrame) -> np.ndarray:
    """Keys of more than CROWD distinct pieces, sorted, the most frequent BROADCAST_ROWS at most: whatever
    is not among them is taken apart after the shuffle instead. Counted by batch, from CROWD_IN_BATCH on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (key, content, *_) in _stretches(batches, np.empty(0, np.uint64)):
            often = _in_groups(key, CROWD_IN_BATCH)
            key, content = key[often], content[often]
            by = np.lexsort((content, key))
            key, content = key[by], content[by]
            new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1]))[: len(key)]
            keys, counts = np.unique(key[new], return_counts=True)
            many = counts >= CROWD_IN_BATCH
            yield pa.RecordBatch.from_arrays([pa.array(keys[many]), pa.array(counts[many])], ["key", "n"])

    found = docs.mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") > CROWD)
    rows = found.orderBy(F.desc("n"), "key").limit(BROADCAST_ROWS).collect()
    return np.sort(np.array([r.key for r in rows], np.int64).view(np.uint64))


def pieces(docs: DataFrame, apart: np.ndarray) -> DataFrame:
    """The pieces of documents(); see cut and PIECE."""
    sent = docs.sparkSession.sparkContext.broadcast(apart)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, (key, content, doc, start, n, twice) in _stretches(batches, sent.value):
            place = _order(b)[doc]
            often = _in_groups(key ^ content, 2)
            by = often[np.lexsort((start[often], place[often], content[often], key[often]))]
            k, c = key[by], content[by]
            done = np.zeros(len(key), bool)
            done[by[1:]] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
            dealt = np.where(done, (key.view(np.uint64) + np.arange(len(key), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).view(np.int64), key)
            for at in range(0, len(key), 1 << 16):
                i = slice(at, at + (1 << 16))
                of = pa.array(doc[i])
                cols = [pa.array(dealt[i]), pa.array(content[i]), b.column(0).take(of), b.column(1).take(of), pa.array(start[i]), pa.array(n[i].astype(np.int32)), pa.array(twice[i]), pa.array(done[i])]
                yield pa.RecordBatch.from_arrays(cols, ["key", "content", *DOC, "start", "n", "twice", "done"])

    return docs.mapInArrow(run, PIECE)


def settle(found: DataFrame) -> DataFrame:
    """SETTLED rows of PIECE rows: gone are all pieces but the first of equal ones; first ones that share
    their key with others, or hold their minimizer twice, are to be compared; others need no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def settled(t: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            key, content, twice = (t.column(c).to_numpy() for c in ("key", "content", "twice"))
            fresh = np.append(True, key[1:] != key[:-1])
            first = np.append(True, fresh[1:] | (content[1:] != content[:-1]))
            group = np.cumsum(fresh) - 1
            members = np.bincount(group[first])
            more = (members > 1) | (np.bincount(group, twice) > 0)
            whole = group < group[-1] if not last else np.ones(len(group), bool)  # of the last key more may come
            held[:] = [] if last else t.filter(pa.array(first & ~whole)).combine_chunks().to_batches()
            take = ~first | (whole & more[group])
            names = ("key", *DOC, "start", "n", "twice")
            out = t.select(names).filter(pa.array(take)).append_column("gone", pa.array(~first[take])).append_column("crowded", pa.array(members[group][take] > CROWD))
            yield from out.select(["gone", "key", "crowded", *DOC, "start", "n", "twice"]).combine_chunks().to_batches()

        for b in batches:
            done = b.column(b.schema.get_field_index("done"))
            t = pa.Table.from_batches([b])
            direct = t.filter(done)
            if len(direct):
                yes = pa.array(np.ones(len(direct), bool))
                yield from direct.select(["key", *DOC, "start", "n", "twice"]).append_column("gone", yes).append_column("crowded", yes).select(["gone", "key", "crowded", *DOC, "start", "n", "twice"]).combine_chunks().to_batches()
            t = pa.concat_tables([pa.Table.from_batches(held, t.schema), t.filter(pa.compute.invert(done))])
            if len(t):
                yield from settled(t, False)
        if held:
            yield from settled(pa.Table.from_batches(held), True)

    dealt = found.repartition("key").sortWithinPartitions("key", "content", F.col("doc_id").isNull(), *DOC, "start")
    return dealt.mapInArrow(run, SETTLED)


def _same(a: str, b: str) -> Column:
    """Whether two rows are of one document."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))


def with_bytes(members: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pieces with their bytes (column s), cut from the texts, and a written table that they read. Pieces
    follow their text in one array, so a long text is not copied for each; texts without any take no part in
    the shuffle while the others are few enough to be broadcast by id."""
    own = table(members.groupBy(*DOC).agg(F.collect_list(F.struct("key", "start", "n", "twice")).alias("own")), "suffix-own")
    here = docs.alias("d").join(checked(own.select(*DOC)).alias("k"), _same("d", "k"), "left_semi")
    d = here.alias("d").join(own.alias("o"), _same("d", "o")).select("d.doc_id", "d.th", "d.bytes", "o.own")
    bytes_ = lambda o: F.substring(F.col("bytes"), (o["start"] + 1).cast("int"), o["n"] + (WIDTH - 1))
    d = d.select(*DOC, F.explode(F.transform("own", lambda o: F.struct(o["key"].alias("key"), o["start"].alias("start"), o["n"].alias("n"), o["twice"].alias("twice"), bytes_(o).alias("s")))).alias("p"))
    return d.select(*DOC, "p.*"), own


def compare(members: DataFrame) -> DataFrame:
    """GONE rows: the strings in pieces with bytes that stand in an earlier one of the same key, or earlier in
    the piece. Every task takes the keys of its partition in stretches of COLLECTION_BYTES and builds the
    transform of each in the shared folder."""
    folder = f"{shared_dir(members.sparkSession)}/tidemark/suffixes-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for b in batches:
            while b.num_rows:
                key, ends = b.column(0).to_numpy(), _flat(b.column(1))[1]
                new = np.flatnonzero(np.append(bool(held) and held[-1].column(0)[-1].as_py() != key[0], key[1:] != key[:-1]))
                full = new[size + ends[new] >= COLLECTION_BYTES]
                if not len(full):
                    held.append(b)
                    size += int(ends[-1])
                    break
                yield _repeats(pa.Table.from_batches([*held, b.slice(0, full[0])]), folder)
                held, size, b = [], 0, b.slice(full[0])
        if held:
            yield _repeats(pa.Table.from_batches(held), folder)

    dealt = members.select("key", "s", *DOC, "start", "twice").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, GONE)


def _shared(symbols: np.ndarray, starts: np.ndarray, key: np.ndarray, twice: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the part of each piece begins and ends (in symbols) that may hold a string of another of its key;
    equal where there is none.

    A string is told by the place of the minimizer in it. The places are parted into ``CLASSES``; all strings
    of a class have bytes around the minimizer in common, so a class whose bytes no other piece of the key
    has is left out. Single strings, and all pieces of a key that one of them holds twice, stay whole.
    """
    m = len(starts) - 1
    lo, hi = starts[:-1].copy(), starts[1:].copy()
    h = _gram_hashes(symbols)
    of = np.repeat(np.arange(m), np.diff(starts))[: len(h)]
    hit = np.flatnonzero(h.view(np.int64) == key[of])
    hit = hit[hit + KEY <= starts[of[hit] + 1]]
    mine, first = np.unique(of[hit], return_index=True)
    at = np.full(m, -1)
    at[mine] = hit[first]
    group = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
    whole = (np.bincount(group, twice) > 0)[group] | (at < 0)
    far, near = np.full(m, -1), np.full(m, REACH)  # the places of a minimizer that are shared, from near to far
    for a, b in zip(_EDGES, _EDGES[1:]):
        u, v = at - a, at - b + 1 + WIDTH
        rows = np.flatnonzero(~whole & (u >= starts[:-1]) & (v <= starts[1:]))
        u, v = u[rows], v[rows]
        seen = key[rows].view(np.uint64)
        for place in (u, (u + v - KEY) // 2, v - KEY):  # three grams cover a class's bytes
            seen = (seen ^ h[place]) * np.uint64(0xD6E8FEB86659FD93)
            seen ^= seen >> np.uint64(32)
        _, inverse, counts = np.unique(seen, return_inverse=True, return_counts=True)
        rows = rows[counts[inverse] > 1]
        far[rows], near[rows] = np.maximum(far[rows], b - 1), np.minimum(near[rows], a)
    none = ~whole & (far < 0)
    part = ~whole & ~none
    lo[part] = np.maximum(lo[part], at[part] - far[part])
    hi[part] = np.minimum(hi[part], at[part] - near[part] + WIDTH)
    hi[none] = lo[none]
    return lo, hi


def _repeats(t: pa.Table, folder: str) -> pa.RecordBatch:
    """GONE rows of whole keys."""
    key, twice = t.column("key").to_numpy(), t.column("twice").to_numpy()
    fresh = np.append(True, key[1:] != key[:-1])
    group = np.cumsum(fresh) - 1
    t = t.filter(pa.array((np.bincount(group) > 1)[group] | twice)).combine_chunks()
    of, offset, first = (np.empty(0, np.int64) for _ in range(3))
    if len(t):
        symbols, starts = _flat(t.column("s").chunk(0))
        key = t.column("key").to_numpy()
        lo, hi = _shared(symbols, starts, key, t.column("twice").to_numpy())
        group = np.cumsum(np.append(True, key[1:] != key[:-1])) - 1
        longest = np.zeros(group[-1] + 1, np.int64)
        np.maximum.at(longest, group, hi - lo)
        kind = np.where(hi > lo, (longest[group] - WIDTH) // LENGTHS, -1)
        found, so_far = [], 0
        for c in np.unique(kind[kind >= 0]):  # keys of about one length, since there are as many rounds as the longest piece has bytes
            rows = np.flatnonzero(kind == c)
            at, k = _repeat(hi[rows] - lo[rows])
            part, own = symbols[lo[rows][at] + k], np.append(0, np.cumsum(hi[rows] - lo[rows]))
            bwt, lcp = collection_bwt.build(part, own, folder)
            for string, place, same in collection_bwt.suffix_groups(bwt, lcp, np.diff(own), WIDTH):
                found.append((rows[string], place + (lo - starts[:-1])[rows[string]], same + so_far))
            so_far += len(bwt) + 1
    if len(t) and found:
        of, offset, same = (np.concatenate(c) for c in zip(*found))
        none = t.column("doc_id").is_null().to_numpy()
        doc, th = t.column("doc_id").fill_null(0).to_numpy(), t.column("th").to_numpy()
        by = np.lexsort((th, doc, none))
        new = np.append(True, (th[by][1:] != th[by][:-1]) | (doc[by][1:] != doc[by][:-1]) | (none[by][1:] != none[by][:-1]))
        rank = np.empty(len(by), np.int64)
        rank[by] = np.cumsum(new)
        by = np.lexsort((t.column("start").to_numpy()[of] + offset, rank[of], same))
        later = by[~np.append(True, same[by][1:] != same[by][:-1])]
        later = later[np.lexsort((offset[later], of[later]))]
        of, offset = of[later], offset[later]
        first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (offset[1:] != offset[:-1] + 1))) if len(of) else first
    n = np.diff(np.append(first, len(of))).astype(np.int32)
    take = pa.array(of[first])
    start = t.column("start").to_numpy()[of[first]] + offset[first]
    cols = [t.column(c).combine_chunks().take(take) for c in DOC]
    cols = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]
    return pa.RecordBatch.from_arrays([*cols, pa.array(start, pa.int64()), pa.array(n)], [*DOC, "start", "n"])


def strings_of(members: DataFrame) -> DataFrame:
    """PIECE rows of the single strings of pieces with bytes."""
    d = members.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("i"))
    s = F.substring("s", F.col("i") + 1, F.lit(WIDTH))
    return d.select(F.xxhash64(s).alias("key"), F.xxhash64(F.lit(1), s).alias("content"), *DOC, (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n"), F.lit(False).alias("twice"), F.lit(False).alias("done"))


def repeats(docs: DataFrame) -> DataFrame:
    """A written table of the documents() from which bytes go: doc_id, th and spans, the maximal runs of
    removed bytes in order. No two rows of docs may be alike."""
    found = table(settle(pieces(docs, crowded_keys(docs))), "suffix-settled")
    rest = found.where("not gone")
    few, own = with_bytes(rest.where("not crowded"), docs)
    compared = table(compare(few), "suffix-compared")
    gone, made = [found.where("gone").select(*DOC, "start", "n"), compared], [found, own, compared]
    crowd = rest.where("crowded")
    if not crowd.isEmpty():
        many, own = with_bytes(crowd, docs)
        gone.append(settle(strings_of(many)).where("gone").select(*DOC, "start", "n"))
        made.append(own)
    every = gone[0]
    for g in gone[1:]:
        every = every.unionByName(g)
    own = every.groupBy(*DOC).agg(F.collect_list(F.struct("start", "n")).alias("own"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            runs = b.column(2)
            at = runs.offsets.to_numpy()
            start, n = (runs.values.field(c).to_numpy() for c in (0, 1))
            row = np.repeat(np.arange(len(runs)), np.diff(at))
            start, n = start[at[0] : at[-1]], n[at[0] : at[-1]]
            by = np.lexsort((start, row))
            row, start, stop = row[by], start[by], start[by] + n[by] + (WIDTH - 1)  # ends rise with starts within a row, or nearly
            reach = np.maximum.accumulate(stop + row * (1 << 40)) - row * (1 << 40)
            new = np.append(True, (row[1:] != row[:-1]) | (start[1:] > reach[:-1])) if len(row) else np.empty(0, bool)
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(row)) - 1
            spans = pa.StructArray.from_arrays([pa.array(start[first]), pa.array(reach[last])], ["start", "stop"])
            offsets = np.searchsorted(row[first], np.arange(len(runs) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.ListArray.from_arrays(offsets, spans)], [*DOC, "spans"])

    out = table(own.mapInArrow(run, f"doc_id long, th long, {SPANS}"), "suffix-spans")
    drop(*made)
    return out


def dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans and kept of every row of docs (doc_id, text): every byte that a WIDTH-byte
    string covers which also starts earlier (in a document before this one, or further up in it) is removed;
    kept are the other bytes, in order, and spans the maximal runs of removed ones (start, stop).

    Strings are judged on the input, not on what is left, and never cross documents. Documents are ordered by
    doc_id (null last), of one id by the hash of the text; of rows alike in both, all but one are repeats.
    Null and empty texts have no bytes; one of fewer than WIDTH bytes loses none. A very long text is hashed
    in stretches and cut in one task. No rows, no result. Other columns are not read.
    """
    d = documents(docs)
    short = F.when(F.octet_length("bytes") < WIDTH, F.col("bytes"))
    alike = table(d.groupBy(*DOC).agg(F.count("*").alias("n"), F.max(F.octet_length("bytes")).cast("long").alias("n_bytes"), F.max(short).alias("short")).where("n > 1"), "suffix-alike")
    copies = None
    if not alike.isEmpty():
        ids = checked(alike.select(*DOC)).alias("k")
        one = d.alias("d").join(ids, _same("d", "k"), "left_semi").groupBy(*DOC).agg(F.min("bytes").alias("bytes"))
        d = d.alias("d").join(ids, _same("d", "k"), "left_anti").unionByName(one)
        c = alike.withColumn("copy", F.explode(F.sequence(F.lit(2).cast("long"), "n")))
        span = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_bytes").alias("stop")))
        spans = F.when(F.col("n_bytes") >= WIDTH, span).otherwise(F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)"))
        copies = c.select("doc_id", "n_bytes", spans.alias("spans"), F.coalesce("short", F.lit("").cast("binary")).alias("kept"))
    found = repeats(d)
    ids = checked(found.select(*DOC)).alias("k")
    whole = d.alias("d").join(ids, _same("d", "k"), "left_anti")
    whole = whole.select("doc_id", F.octet_length("bytes").cast("long").alias("n_bytes"), F.expr("cast(array() as array<struct<start: bigint, stop: bigint>>)").alias("spans"), F.col("bytes").alias("kept"))
    part = d.alias("d").join(ids, _same("d", "k"), "left_semi").alias("d").join(found.alias("s"), _same("d", "s")).select("d.doc_id", "d.bytes", "s.spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, kept = [], []
            for text, spans in zip(b.column(1), b.column(2)):
                text, out, at = text.as_buffer(), [], 0
                for start, stop in ((int(x["start"]), int(x["stop"])) for x in spans.as_py()):
                    out.append(text.slice(at, start - at))
                    at = stop
                size.append(text.size)
                kept.append(b"".join([*out, text.slice(at)]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(size, pa.int64()), b.column(2), pa.array(kept, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    out = whole.unionByName(part.mapInArrow(run, f"doc_id long, n_bytes long, {SPANS}, kept binary"))
    return out if copies is None else out.unionByName(copies)
