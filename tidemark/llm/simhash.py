"""SimHash near-duplicates: BK-trees over shards that agree on half of the fingerprint.

Two fingerprints within Hamming distance 2 agree on at least two of four 16-bit blocks. Every
distinct fingerprint is therefore dealt to six shards, one for each pair of blocks, and the tree of
a shard (children keyed by their integer distance to the parent) is searched along the edges within
the radius only. A tree lives in the task that owns its shard: all trees together grow with the
data, so they are dealt out by a shuffle instead of being broadcast whole. A shard larger than
``TREE_ROWS`` is split again on thirds of the other 32 bits, one of which two members must share.

Only links of a spanning forest leave a shard, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, table

RADIUS = 2
SHINGLE = 3
SEED = 42
TREE_ROWS = 2048
_PAIRS = ((0, 1), (0, 2), (0, 3), (1, 2), (1, 3), (2, 3))


def majority(h: np.ndarray) -> int:
    """The bits that are set in over half of the hashes; 0 of none."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(h), 8192):
        ones += np.unpackbits(h[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.uint64)[0])


def simhash64(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The unsigned fingerprint of one text; 0 without words.

    bytes.lower() touches A-Z alone and bytes.split() parts at the six ASCII spaces alone.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    return majority(np.array([xxhash.xxh64_intdigest(g, seed) for g in grams], dtype=np.uint64))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint's bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([simhash64(t) for t in b.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


class BKTree:
    """Children keyed by integer Hamming distance to their parent."""

    def __init__(self) -> None:
        self.keys: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, key: int, radius: int) -> list[int]:
        """Places of the members within the radius; then the key is a member, too."""
        if not self.keys:
            self.keys.append(key)
            self.children.append({})
            return []
        found, todo = [], [0]
        while todo:
            node = todo.pop()
            d = (self.keys[node] ^ key).bit_count()
            if d <= radius:
                found.append(node)
            todo += [child for edge, child in self.children[node].items() if d - radius <= edge <= d + radius]
        node = 0
        while (d := (self.keys[node] ^ key).bit_count()) in self.children[node]:
            node = self.children[node][d]
        self.children[node][d] = len(self.keys)
        self.keys.append(key)
        self.children.append({})
        return found


def shard_links(keys: list[int], free: int, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Spanning links of the distinct keys of one shard. free: the bits in which its members may differ."""
    parent = list(range(len(keys)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def search(members: list[int]) -> None:
        tree = BKTree()
        for k, i in enumerate(members):
            for j in tree.add(keys[i], radius):
                a, b = root(members[j]), root(members[k])
                parent[max(a, b)] = min(a, b)

    def split(members: list[int], free: int) -> None:
        bits = [b for b in range(64) if free >> b & 1]
        if len(members) <= TREE_ROWS or len(bits) <= radius:
            return search(members)
        for part in range(radius + 1):
            mask = sum(1 << b for b in bits[part :: radius + 1])
            groups: dict[int, list[int]] = {}
            for i in members:
                groups.setdefault(keys[i] & mask, []).append(i)
            for own in groups.values():
                if len(own) > 1:
                    search(own) if len(own) == len(members) else split(own, free & ~mask)
        return None

    split(list(range(len(keys))), free)
    return [(keys[i], keys[root(i)]) for i in range(len(keys)) if root(i) != i]


def links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links between the distinct values of column fp within Hamming distance 2."""
    if radius > 2:
        raise ValueError("two of four blocks agree only up to a distance of 2")
    block = lambda i: F.shiftrightunsigned("fp", 16 * i).bitwiseAND(F.lit(0xFFFF))
    shards = [(F.lit(k) * F.lit(1 << 32) + block(i) * F.lit(65536) + block(j)) for k, (i, j) in enumerate(_PAIRS)]
    dealt = fps.select("fp", F.explode(F.array(*shards)).alias("shard")).repartition("shard").sortWithinPartitions("shard", "fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(shard: int, keys: np.ndarray) -> pa.RecordBatch | None:
            i, j = _PAIRS[shard >> 32]
            free = ~(0xFFFF << 16 * i | 0xFFFF << 16 * j) & (1 << 64) - 1
            found = np.array(shard_links(keys.view(np.uint64).tolist(), free, radius), dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"]) if len(found) else None

        shard, rest = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for b in batches:
            shard = np.concatenate([shard, b.column(1).to_numpy(zero_copy_only=False)])
            rest = np.concatenate([rest, b.column(0).to_numpy(zero_copy_only=False)])
            cuts = np.flatnonzero(np.diff(shard)) + 1
            if len(cuts):
                sizes = np.diff(np.concatenate([[0], cuts]))
                for k in np.flatnonzero(sizes > 1):
                    at = cuts[k] - sizes[k]
                    if (x := out(int(shard[at]), rest[at : cuts[k]])) is not None:
                        yield x
                shard, rest = shard[cuts[-1] :], rest[cuts[-1] :]
        if len(rest) > 1 and (x := out(int(shard[0]), rest)) is not None:
            yield x

    return dealt.select("fp", "shard").mapInArrow(run, "a long, b long")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id, fp, component_id (smallest doc_id reachable over links).

    A null or wordless text has fingerprint zero and is linked like any other. A null doc_id keeps
    its row and its component; only if a component has no other id is its component_id null.
    Repeated rows stay repeated. Other columns of docs are ignored; an empty table gives no rows.
    """
    docs = table(fingerprints(docs), "simhash-fp")
    first = table(docs.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "simhash-distinct")
    comp = components(links(first.select("fp")), "simhash")
    named = first.join(comp.select(F.col("node").alias("fp"), "component"), "fp", "left")
    named = named.select("fp", "least_id", F.coalesce("component", "fp").alias("component"))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    named = table(named.join(least, "component").select("fp", "component_id"), "simhash-named")
    return docs.join(named, "fp").select("doc_id", "fp", "component_id")
