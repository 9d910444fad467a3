"""Packing into windows of token ids by Karmarkar-Karp multiway differencing.

A document's ids are cut into full windows and a tail. Tails are dealt by hash into groups of about
GROUP_ROWS; in each, differencing keeps partial partitions and always merges the two of the largest
imbalance so that the heavy windows of one meet the light ones of the other. The windows come out
near-equal; if the fullest exceeds the capacity, the group gets one window more and is dealt again.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

CAPACITY = 4096
END_ID = 2
GROUP_ROWS = 384
TOKENIZER = "word_bpe_49k.json"
#: Words of a generation of a tokenizer's kept parts: some 30 MB, of parts of 64 code points at most.
_CACHE_WORDS = 150_000
#: Runs of signs, of 64 code points at most, whose ids a tokenizer keeps.
_STOPS = 10_000
_MARK = "\x01"
_STOPPED = re.compile("([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]{1,64})([!-/:-@\\[-`{-~]*)")


def _latin(text: str) -> bool:
    """Of Latin-1 alone, whose letters the tokenizer lower-cases as str.lower does (its special tokens,
    which begin with <|, aside)."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class WordTokenizer:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer's rules never look across a blank or a line feed and take a run of letters for one piece,
    so the parts between those are encoded on their own and their ids are kept. Of kept parts there are two generations of at most
    _CACHE_WORDS each; once the younger is full it becomes the older, and what is met again moves on. A task
    forgets them at its end, so a worker that goes on to other work holds none.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.forget()
        self.stops: dict[str, bytes] = {}
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes_of = {k: level.pre_tokenize_str(chr(k))[0][0] for k in range(0xC0, 0x100)}

    def forget(self) -> None:
        self.older: dict[str, bytes] = {}
        self.kept: dict[str, bytes] = {"": b""}

    def encode(self, texts: list[str]) -> list[bytes]:
        texts = [t.lower() if _latin(t) and "<|" not in t else t for t in texts]
        parted = [t.replace("\n", " ").split(" ") for t in texts]
        if len(self.kept) > _CACHE_WORDS:
            self.older, self.kept = self.kept, {"": b""}
        new = set(chain.from_iterable(parted)).difference(self.kept)
        self._learn(new)
        out = [b"".join(map(self.kept.__getitem__, parts)) for parts in parted]
        for p in new:
            if len(p) > 64:
                self.kept.pop(p, None)
        return out

    def _learn(self, new: set[str]) -> None:
        """Parts of Latin letters and then ASCII signs have the ids of the letters, then those of the signs;
        small letters alone are one piece of the tokenizer's rules, which its model takes as it is."""
        kept, older, stops = self.kept, self.older, self.stops
        stopped, heads, signs, words, rest = [], [], [], set(), []
        for p in new:
            if p in older:
                kept[p] = older[p]
            elif not (m := _STOPPED.fullmatch(p)):
                rest.append(p)
            elif not m[2]:
                words.add(p)
            else:
                stopped.append(p)
                heads.append(head := m[1])
                signs.append(m[2])
                if head in older:
                    kept[head] = older[head]
                elif head not in kept:
                    words.add(head)
        kept.update(self._pieces([w for w in words if w.islower()]))
        kept.update(self._parts([w for w in words if not w.islower()]))
        kept.update(self._parts([p for p in rest if _MARK not in p]))
        kept.update((p, self._ids([p])[0]) for p in rest if _MARK in p)
        if strange := set(signs).difference(stops):
            found = self._parts(list(strange))
            stops = stops | found
            if len(stops) <= _STOPS:
                self.stops |= {s: ids for s, ids in found.items() if len(s) <= 64}
        kept.update(zip(stopped, [kept[head] + stops[s] for head, s in zip(heads, signs)]))

    def _pieces(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of small Latin letters, by the model alone."""
        tokenize, out = self.tokenizer.model.tokenize, {}
        for at in range(0, len(words), 500):
            own = words[at : at + 500]
            found = [tokenize(w if w.isascii() else w.translate(self.bytes_of)) for w in own]
            ids = np.array([x.id for f in found for x in f], "<u4").tobytes()
            ends = (np.cumsum([len(f) for f in found]) * 4).tolist()
            out.update(zip(own, (ids[i:j] for i, j in zip([0, *ends], ends))))
        return out

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _parts(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of each part: many at once, with a part of one known id between any two."""
        (mark,) = np.frombuffer(self._ids([_MARK])[0], "<u4")
        out = {}
        for at in range(0, len(parts), 4000):
            own = parts[at : at + 4000]
            ids = self._ids([f" {_MARK} ".join(own)])[0]
            cuts = np.flatnonzero(np.frombuffer(ids, "<u4") == mark) * 4
            out.update(zip(own, (ids[i:j] for i, j in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(ids)]))))
        return out


@lru_cache(maxsize=2)
def word_tokenizer(path: str) -> WordTokenizer:
    """One for each Python worker."""
    return WordTokenizer(path)


def tokenized(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, tokens (with the end id) and crcs, the CRC-32 of each cut of the ids.

    Cuts are every capacity ids; the last may be shorter. A null text is empty: the end id alone. The
    tokenizer's default path is looked up where the task runs.
    """
    end = END_ID.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path or public_tokenizers.path(TOKENIZER))
        for b in batches:
            for at in range(0, b.num_rows, 256):
                own = b.slice(at, 256)
                tokens, crcs = [], []
                for ids in tokenizer.encode([t or "" for t in own.column(1).to_pylist()]):
                    ids += end
                    tokens.append(len(ids) // 4)
                    view = memoryview(ids)
                    crcs.append([zlib.crc32(view[i : i + 4 * capacity]) for i in range(0, len(ids), 4 * capacity)])
                yield pa.RecordBatch.from_arrays([own.column(0), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))], ["doc_id", "tokens", "crcs"])
        tokenizer.forget()
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, tokens long, crcs array<long>")


def karmarkar_karp(sizes: list[int] | np.ndarray, bins: int) -> list[list[int]]:
    """Places of the sizes in each of the bins, dealt by multiway differencing."""
    if bins == 1:
        return [list(range(len(sizes)))]
    kids: list[tuple[int, int]] = [(0, 0)] * (len(sizes) + 1)  # of the places' trees: 0 is none, i + 1 the size i
    heap = []
    for i, size in enumerate(sizes):
        loads, trees = np.zeros(bins, np.int64), np.zeros(bins, np.int64)
        loads[0], trees[0] = size, i + 1
        heap.append((-int(size), i, loads, trees))
    heapq.heapify(heap)
    made = len(sizes)
    while len(heap) > 1:
        _, _, a, x = heapq.heappop(heap)
        _, _, b, y = heapq.heappop(heap)
        loads, y = a + b[::-1], y[::-1]
        trees = x + y
        for k in np.flatnonzero((x > 0) & (y > 0)).tolist():
            kids.append((int(x[k]), int(y[k])))
            trees[k] = len(kids) - 1
        order = np.argsort(-loads, kind="stable")
        loads, trees = loads[order], trees[order]
        loads -= loads[-1]
        heapq.heappush(heap, (-int(loads[0]), made, loads, trees))
        made += 1
    out = []
    for top in heap[0][3].tolist() if heap else [0] * bins:
        own, todo = [], [top]
        while todo:
            node = todo.pop()
            if 0 < node <= len(sizes):
                own.append(node - 1)
            elif node:
                todo += kids[node]
        out.append(sorted(own))
    return out


def windows(sizes: list[int] | np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Near-equal windows of sizes up to the capacity; one more window whenever one would exceed it."""
    sizes = np.asarray(sizes, np.int64)
    if not len(sizes):
        return []
    bins = -(-int(sizes.sum()) // capacity)
    while True:
        dealt = karmarkar_karp(sizes, bins)
        if all(int(sizes[own].sum()) <= capacity for own in dealt):
            return [own for own in dealt if own]
        bins += 1


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every row of docs is packed once, repeated rows and rows with a null or repeated doc_id on their
    own; only (doc_id, text) matters. The pieces of a sequence lie from 0 without gaps. A very long text
    gives full windows and one tail, worked on as one text. A table without rows gives none.
    """
    d = table(tokenized(docs, path, capacity).withColumn("row", F.monotonically_increasing_id()), "packing")
    groups = max(1, round(d.count() / GROUP_ROWS))

    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("row")
        ids, tokens, crcs = g["doc_id"].tolist(), g["tokens"].to_numpy(), g["crcs"].tolist()
        first = int(g["bucket"].iloc[0]) << 32
        out, sequence = [], first
        for i, n in enumerate(tokens.tolist()):
            for k in range(n // capacity):
                out.append((ids[i], k * capacity, capacity, int(crcs[i][k]), n, sequence, 0))
                sequence += 1
        tails = np.flatnonzero(tokens % capacity)
        lengths = tokens[tails] % capacity
        for own in windows(lengths, capacity):
            offset = 0
            for j in own:
                i, length = tails[j], int(lengths[j])
                out.append((ids[i], int(tokens[i]) - length, length, int(crcs[i][-1]), int(tokens[i]), sequence, offset))
                offset += length
            sequence += 1
        out = pd.DataFrame(out, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        return out.assign(doc_id=pd.array([None if pd.isna(x) else int(x) for x in out["doc_id"]], dtype="Int64"))

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    return d.withColumn("bucket", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("long")).groupBy("bucket").applyInPandas(run, schema)
