"""Burrows-Wheeler transform and common prefixes of a collection of short strings, built column by column.

Round t inserts the suffix of length t of every string, that is one symbol a string: the symbol before the
suffix of length t - 1. Where it goes follows from the transform so far (how many equal symbols stand
before the place of the shorter suffix), and its common prefix with its neighbours from the least common
prefix between two such symbols. Transform and prefixes lie in two files, which each round reads once
from start to end and writes anew, block by block, while it counts for the next round. What stays in
memory is a block, the strings and a few numbers a string.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem

BLOCK = 1 << 17
_NONE = np.uint8(255)
_AFTER = np.arange(2, 514, 2, dtype=np.uint16)


class _Scan:
    """Counts of one pass over the list, block by block, for the suffixes that the next round inserts."""

    def __init__(self) -> None:
        self.count = np.zeros(256, np.int64)
        self.low = np.full(256, _NONE)  # the least common prefix since a symbol's last occurrence
        self.fresh = np.zeros(256, bool)  # whether that occurrence was inserted in this round
        self.new: list[tuple[np.ndarray, ...]] = []  # symbol, rank, string, common prefix
        self.old: list[tuple[np.ndarray, ...]] = []  # symbol, rank, common prefix of suffixes that have a new neighbour

    def block(self, bwt: np.ndarray, lcp: np.ndarray, at: np.ndarray, string: np.ndarray) -> None:
        """at, string: places in the block, ascending, of the suffixes that this round inserted."""
        size = len(bwt)
        flag = np.zeros(size, bool)
        flag[at] = True
        order = pc.array_sort_indices(pa.array(bwt)).to_numpy().view(np.int64)  # stable, by counting
        sorted_ = ((bwt.astype(np.uint16) << 1) | flag)[order]
        ends = np.searchsorted(sorted_, _AFTER)
        begins = np.append(0, ends[:-1])
        counts = ends - begins
        here = np.flatnonzero(counts)
        head, last = order[begins[here]], order[ends[here] - 1]  # of each symbol in the block
        new = (sorted_ & 1).astype(bool)
        own = np.flatnonzero(new)
        after = own[own + 1 < size] + 1  # suffixes behind a new one, unless of the next symbol
        after = after[sorted_[after] >> 1 == sorted_[after - 1] >> 1]
        want = np.sort(np.concatenate([own, after, begins[here[self.fresh[here]]]]))
        want = want[np.searchsorted(want, ends[0]) :]  # symbol 0 ends a string
        want = want[np.append(True, want[1:] != want[:-1])[: len(want)]]
        place = order[want]
        symbol = bwt[place]
        rank = want - begins[symbol]
        inner = rank > 0
        padded = np.append(lcp, _NONE)
        least = np.empty(len(want), np.uint8)
        if inner.any():
            cut = np.empty(2 * int(inner.sum()), np.int64)
            cut[::2] = order[want[inner] - 1] + 1
            cut[1::2] = place[inner] + 1
            least[inner] = np.minimum.reduceat(padded, cut)[::2]
        by = np.argsort(head)
        low = self.low.copy()  # with what lies before the symbol's first place in the block
        low[here[by]] = np.minimum(low[here[by]], np.minimum.accumulate(np.minimum.reduceat(padded, np.append(0, head[by] + 1))[:-1]))
        least[~inner] = low[symbol[~inner]]
        rank = rank + self.count[symbol]
        prefix = np.where(rank > 0, least + np.uint8(1), 0).astype(np.uint8)
        own = new[want]
        self.new.append((symbol[own], rank[own], string[np.searchsorted(at, place[own])], prefix[own]))
        self.old.append((symbol[~own], rank[~own], prefix[~own]))
        self.low = np.minimum(self.low, lcp.min())
        by = np.argsort(last)
        self.low[here[by]] = np.minimum.accumulate(np.minimum.reduceat(padded, last[by] + 1)[::-1])[::-1]
        self.fresh[here] = flag[last]
        self.count += counts


def _joined(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    return tuple(np.concatenate(c) for c in zip(*parts))


def build(symbols: np.ndarray, starts: np.ndarray, folder: str) -> tuple[np.ndarray, np.ndarray]:
    """Transform and common prefixes of strings of 1 to 253 bytes of UTF-8 (the bytes of a text or of a part
    of it), concatenated in symbols; string k is symbols[starts[k]:starts[k + 1]]. A byte is b + 1 in the
    transform, 0 the end of a string; empty suffixes come first, in the order of the strings. The files
    lie in a new folder below ``folder`` (a URI), which is deleted."""
    lengths = np.diff(starts)
    m, rounds = len(lengths), int(lengths.max(initial=0))
    fs, root = FileSystem.from_uri(folder)
    root = f"{root}/{uuid.uuid4().hex}"
    fs.create_dir(root, recursive=True)
    try:
        scan = _Scan()
        with fs.open_output_stream(f"{root}/0.bwt", compression=None) as b, fs.open_output_stream(f"{root}/0.lcp", compression=None) as c:
            for at in range(0, m, BLOCK):
                ids = np.arange(at, min(m, at + BLOCK))
                bwt = symbols[starts[ids + 1] - 1] + np.uint8(1)
                lcp = np.zeros(len(ids), np.uint8)
                b.write(bwt.tobytes())
                c.write(lcp.tobytes())
                scan.block(bwt, lcp, ids - at, ids)
        total = m
        for t in range(1, rounds + 1):
            base = m + np.concatenate([[0, 0], np.cumsum(scan.count[1:-1])])
            symbol, rank, string, prefix = _joined(scan.new)
            to = base[symbol] + rank
            by = np.argsort(to)
            to, string, prefix = to[by], string[by], prefix[by]
            rest = lengths[string] - t
            ahead = np.where(rest > 0, symbols[starts[string] + np.maximum(rest - 1, 0)] + np.uint8(1), 0).astype(np.uint8)
            symbol, rank, again = _joined(scan.old)
            moved = base[symbol] + rank
            moved = moved - np.searchsorted(to, moved)
            by = np.argsort(moved)
            moved, again = moved[by], again[by]
            scan = _Scan()
            source = to - np.arange(len(to))  # the old suffix before which each goes
            with (
                fs.open_input_stream(f"{root}/{t - 1}.bwt", compression=None) as b0, fs.open_input_stream(f"{root}/{t - 1}.lcp", compression=None) as c0,
                fs.open_output_stream(f"{root}/{t}.bwt", compression=None) as b1, fs.open_output_stream(f"{root}/{t}.lcp", compression=None) as c1,
            ):
                for at in range(0, total, BLOCK):
                    size = min(BLOCK, total - at)
                    bwt, lcp = (np.frombuffer(x.read(size), np.uint8) for x in (b0, c0))
                    lo, hi = np.searchsorted(source, (at, at + size if at + size < total else total + 1))
                    u0, u1 = np.searchsorted(moved, (at, at + size))
                    lcp = lcp.copy()
                    lcp[moved[u0:u1] - at] = again[u0:u1]
                    put = to[lo:hi] - (at + lo)
                    stay = np.ones(size + hi - lo, bool)
                    stay[put] = False
                    bwt1, lcp1 = np.empty(len(stay), np.uint8), np.empty(len(stay), np.uint8)
                    bwt1[stay], lcp1[stay] = bwt, lcp
                    bwt1[put], lcp1[put] = ahead[lo:hi], prefix[lo:hi]
                    b1.write(bwt1.tobytes())
                    c1.write(lcp1.tobytes())
                    scan.block(bwt1, lcp1, put, string[lo:hi])
            total += len(to)
            fs.delete_file(f"{root}/{t - 1}.bwt")
            fs.delete_file(f"{root}/{t - 1}.lcp")
        out = []
        for kind in ("bwt", "lcp"):
            with fs.open_input_stream(f"{root}/{rounds}.{kind}", compression=None) as f:
                out.append(np.frombuffer(f.read(), np.uint8))
        return out[0], out[1]
    finally:
        fs.delete_dir(root)


def suffix_groups(bwt: np.ndarray, lcp: np.ndarray, lengths: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """string, offset and group of every suffix of at least width symbols; suffixes are of one group if
    they agree in the first width. One triple for each length of suffix."""
    order = np.argsort(bwt, kind="stable")
    longer = np.empty(len(bwt), np.int64)  # from a suffix to the one that is a symbol longer
    longer[order] = np.arange(len(bwt))
    group = np.cumsum(lcp < width)
    strings = np.argsort(-lengths, kind="stable")
    place = strings.copy()
    for t in range(1, int(lengths.max(initial=0)) + 1):
        k = int(np.searchsorted(-lengths[strings], -t, side="right"))
        place = longer[place[:k]]
        if t >= width:
            yield strings[:k], lengths[strings[:k]] - t, group[place]
