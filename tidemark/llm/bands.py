"""MinHash bands of word shingles, and the pairs that meet in them.

Words are hashed once; hashes of all runs of words come from prefix hashes. Sets of shingle hashes get
bands of a few minima each. Sets with an equal band meet and are compared exactly (``linked``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, drop, table, within

SHINGLE = 5
SIMILARITY = 0.8
#: Rows of a batch that are worked on together.
SLICE = 128
#: Members outside the largest component of a key whose pairs are joined; of more, blocks are compared.
FEW = 32
#: Members and queries of a block, in the mean.
BLOCK = 1024
#: A key with more members is split by FINER_BANDS bands of FINER_ROWS values of its own, up to LEVELS times.
CROWD = 1 << 15
FINER_BANDS, FINER_ROWS, LEVELS = 16, 4, 4
#: Values before those of the finer bands: what an operator's own bands may take.
OWN_VALUES = 64
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_RNG = np.random.default_rng(11)
_N = OWN_VALUES + LEVELS * FINER_BANDS * FINER_ROWS
_ODDS = _RNG.integers(1, 1 << 63, _N, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_XORS = _RNG.integers(1, 1 << 63, _N, dtype=np.uint64)


def powers(n: int, base: np.uint64 = _BASE) -> np.ndarray:
    """base ** 0 to base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def prefixes(h: np.ndarray) -> np.ndarray:
    """p[i] hashes the first i words; p[b] - p[a] * base ** (b - a) hashes words a to b."""
    n = len(h)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * powers(n + 1, _INVERSE)[1:], dtype=np.uint64)])
    return sums * powers(n + 1)


def grams(p: np.ndarray, k: int) -> np.ndarray:
    """Mixed hashes of all runs of k words, from their prefixes."""
    return mixed(p[k:] - p[:-k] * powers(k + 1)[k]) if len(p) > k else np.zeros(0, np.uint64)


def shingles(words: list[bytes]) -> np.ndarray:
    """Hashes of the runs of SHINGLE words, in order; of fewer words, one; of none, none."""
    return grams(prefixes(word_hashes(words)), min(SHINGLE, len(words))) if words else np.zeros(0, np.uint64)


def band_keys(g: np.ndarray, cuts: np.ndarray, bands: int, rows: int, first: int = 0) -> np.ndarray:
    """Keys of the bands, a row for each set: set i is g[cuts[2i] : cuts[2i + 1]] and not empty.

    Values from ``first`` on are taken.
    """
    sets = len(cuts) // 2
    keys = np.tile(np.arange(first + 1, first + bands + 1, dtype=np.uint64)[:, None], (1, sets))
    if not sets:
        return keys.T.view(np.int64)
    cuts = cuts[:-1] if cuts[-1] >= len(g) else cuts
    for band in range(bands):
        for k in range(first + band * rows, first + (band + 1) * rows):
            keys[band] = mixed(keys[band] * np.uint64(31) + np.minimum.reduceat((g ^ _XORS[k]) * _ODDS[k], cuts)[::2])
    return np.ascontiguousarray(keys.T).view(np.int64)


def ends(sets: list[np.ndarray]) -> np.ndarray:
    """The cuts of sets that are put after one another."""
    stop = np.cumsum([len(s) for s in sets], dtype=np.int64)
    return np.stack([stop - [len(s) for s in sets], stop], axis=1).ravel() if len(sets) else np.zeros(0, np.int64)


def lists(arrays: list, values: pa.Array) -> pa.ListArray:
    """values, dealt to lists as long as the arrays."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(a) for a in arrays])]), pa.int32()), values)


def _verified(pairs: DataFrame, sh: DataFrame, similarity: float) -> DataFrame:
    both = pairs.join(sh.select(F.col("node").alias("a"), F.col("sh").alias("x")), "a").join(sh.select(F.col("node").alias("b"), F.col("sh").alias("y")), "b")
    common = F.size(F.array_intersect("x", "y"))
    return both.where(common >= similarity * (F.size("x") + F.size("y") - common)).select("a", "b")


def _compared(dealt: DataFrame, similarity: float) -> DataFrame:
    """(a, b) alike in different components. dealt: key, m, q (the block), query, node, c, sh; queries of a
    block are compared with its members by an inverted index, and only links that join components that the
    block has not joined yet come out: fewer than its members."""

    def run(t: pa.Table) -> pa.Table:
        query = t.column("query").to_numpy()
        node, c, sh = t.column("node").to_numpy(), t.column("c").to_numpy(), t.column("sh").combine_chunks()
        size = np.diff(sh.offsets.to_numpy())
        token, owner = sh.flatten().to_numpy(), np.repeat(np.arange(len(node)), size)
        own = ~query[owner]
        order = np.argsort(token[own], kind="stable")
        index, holder = token[own][order], owner[own][order]
        out, of = [], np.unique(c, return_inverse=True)[1]
        parent = np.arange(len(node))

        def root(k: int) -> int:
            while parent[k] != k:
                parent[k] = parent[parent[k]]
                k = parent[k]
            return k

        starts = np.cumsum([0, *size])
        for i in np.flatnonzero(query):
            mine = token[starts[i] : starts[i + 1]]
            low, high = np.searchsorted(index, mine), np.searchsorted(index, mine, "right")
            n = high - low
            hits = holder[np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            common = np.bincount(hits, minlength=len(node))
            alike = np.flatnonzero((common > 0) & (c != c[i]) & (common >= similarity * (size + size[i] - common)))
            for j in alike[np.unique(of[alike], return_index=True)[1]].tolist():
                x, y = root(of[i]), root(of[j])
                if x != y:
                    parent[x] = y
                    out.append((min(node[i], node[j]), max(node[i], node[j])))
        found = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    return dealt.groupBy("key", "m", "q").applyInArrow(run, "a long, b long").distinct()


def _blocks(own: DataFrame, crowded: DataFrame, sh: DataFrame, similarity: float) -> DataFrame:
    """Links between the members of crowded keys that are of different components: each member outside the
    key's largest component is a query against all its members."""
    d = own.join(crowded, "key").withColumns({"ms": F.ceil(F.col("n") / BLOCK), "qs": F.ceil(F.col("others") / BLOCK)})
    d = d.withColumns({"m": F.pmod(F.xxhash64("node"), "ms"), "q": F.pmod(F.xxhash64("node"), "qs")})
    members = d.select("key", "m", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qs") - 1)).alias("q"), F.lit(False).alias("query"), "node", "c")
    queries = d.where("c <> top").select("key", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ms") - 1)).alias("m"), "q", F.lit(True).alias("query"), "node", "c")
    return _compared(members.unionByName(queries).join(sh, "node").select("key", "m", "q", "query", "node", "c", "sh"), similarity)


def shared(met: DataFrame, name: str) -> DataFrame:
    """The rows of met (node, key) whose key has two nodes or more."""
    keys = table(met.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key"), f"{name}-keys")
    out = table(within(met, keys, "key").select("node", "key"), f"{name}-met")
    drop(keys)
    return out


def linked(met: DataFrame, sh: DataFrame, name: str, similarity: float = SIMILARITY) -> DataFrame:
    """node, component: components of the pairs that share a key and are alike. met: node, key; sh: node,
    sh (its distinct shingles). Nodes without a link are not in the result.

    A key's members first meet their smallest. Then, of a key that still holds several components, each
    member outside the largest meets all members of other components; with that every pair of the key is
    joined or was compared. Where those members are more than FEW, they are compared in blocks, from which
    only links come out. Keys of more than CROWD members are first split by bands of further values, in
    which pairs of 0.8 collide with probability 0.9998 again.
    """
    links, level, made = [], 0, []

    def kept(df: DataFrame, what: str) -> DataFrame:
        made.append(table(df, f"{name}-{what}"))
        return made[-1]

    def all_links() -> DataFrame:
        out = links[0]
        for x in links[1:]:
            out = out.unionByName(x)
        return out

    while True:
        first = met.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a <> z").select("key", "a")
        first = kept(first, "first")
        links.append(kept(_verified(met.join(first, "key").where("node <> a").select("a", F.col("node").alias("b")).distinct(), sh, similarity), "links"))
        comp = components(all_links(), f"{name}-met")
        own = met.join(first.select("key"), "key", "left_semi").join(comp, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c"))
        own = kept(own, "own")
        sizes = own.groupBy("key", "c").agg(F.count("*").alias("n"))
        open_ = sizes.groupBy("key").agg(F.max(F.struct("n", "c")).alias("top"), F.sum("n").alias("n")).where("n > top.n")
        open_ = kept(open_.select("key", "n", F.col("top.c").alias("top"), (F.col("n") - F.col("top.n")).alias("others")), "open")
        few, huge = F.col("others") <= FEW, (F.col("others") > FEW) & (F.col("n") > CROWD) & F.lit(level < LEVELS)
        others = own.join(open_.where(few), "key").where("c <> top").select("key", F.col("node").alias("a"), F.col("c").alias("ca"))
        cross = own.join(others, "key").where("c <> ca").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        more = kept(_verified(cross, sh, similarity), "cross")
        if not open_.where(~few & ~huge).isEmpty():
            more = more.unionByName(kept(_blocks(own, open_.where(~few & ~huge), sh, similarity), "blocks"))
        links.append(more)
        if open_.where(huge).isEmpty():
            comp = table(comp if more.isEmpty() else components(all_links(), name), f"{name}-components")
            drop(*made)
            return comp
        at = OWN_VALUES + level * FINER_BANDS * FINER_ROWS

        def finer(batches: Iterator[pa.RecordBatch], at: int = at) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for k in range(0, b.num_rows, SLICE):
                    sets = [np.array(x, np.int64).view(np.uint64) for x in b.column(1).slice(k, SLICE).to_pylist()]
                    keys = band_keys(np.concatenate(sets), ends(sets), FINER_BANDS, FINER_ROWS, at)
                    yield pa.RecordBatch.from_arrays([b.column(0).slice(k, SLICE), lists(keys, pa.array(keys.ravel()))], ["node", "finer"])

        again = own.join(open_.where(huge).select("key"), "key", "left_semi").select("key", "node")
        keys = sh.join(again.select("node").distinct(), "node", "left_semi").select("node", "sh").mapInArrow(finer, "node long, finer array<long>")
        met = again.join(keys, "node").select("node", F.explode("finer").alias("f"), "key").select("node", F.xxhash64("key", "f").alias("key"))
        met, level = kept(met, "finer"), level + 1
