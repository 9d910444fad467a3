"""Repeated byte strings against brute force; the transform against sorted suffixes."""

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm import collection_bwt, queries, suffix_dedup
from tidemark.llm.suffix_dedup import WIDTH

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, th string, key int, spans double"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, digest) of each row; equal ids are ordered by the result alone."""
    seen, out = set(), []
    for i, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for at in range(len(b) - WIDTH + 1):
            s = b[at : at + WIDTH]
            if s in seen:
                gone[at : at + WIDTH] = True
            seen.add(s)
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), int((np.diff(gone.astype(int)) == -1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def digest(df):
    out = []
    for r in df.collect():
        out.append((r.doc_id, r.n_bytes, sum(s.stop - s.start for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()))
    return sorted(out, key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_suffix_dedup"](spark, SF)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    want = brute(rows)
    assert sorted(map(tuple, got.collect())) == sorted(want) and sum(r[2] for r in want) > 1000


def planted(r, n=120):
    """Texts that share passages around WIDTH bytes, boilerplate of fewer, runs of one byte and of a period."""
    word = lambda: "".join(r.choice("abcdeé漢") for _ in range(r.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    passages = [prose(40) for _ in range(6)]
    exact = prose(60).encode()[: WIDTH + 1].decode(errors="ignore")
    line = prose(16).encode()[:70].decode(errors="ignore")
    out = []
    for i in range(n):
        parts = [prose(r.randint(0, 40)), r.choice(passages), line, exact[r.randint(0, 3) :], "x" * r.choice([0, 90, 250]), "abc " * r.choice([0, 60]), prose(5), line]
        r.shuffle(parts)
        out.append((i, "".join(parts[: r.randint(1, 8)])))
    return out


@pytest.mark.parametrize("crowd, in_batch, collection", [(1024, 4, 8 << 20), (5, 2, 20_000), (5, 10_000, 1)])
def test_planted(spark, monkeypatch, crowd, in_batch, collection):
    """Also with minimizers that are taken apart before and after the shuffle, and with small transforms."""
    for name, value in (("CROWD", crowd), ("CROWD_IN_BATCH", in_batch), ("COLLECTION_BYTES", collection)):
        monkeypatch.setattr(suffix_dedup, name, value)
    rows = planted(random.Random(crowd))
    d = spark.createDataFrame([(*r, "t", 1, 0.5) for r in rows], SCHEMA).repartition(5)
    assert digest(suffix_dedup.dedup(d)) == sorted(brute(rows), key=str)


def test_odd_rows(spark):
    """Nulls, short and empty texts, a very long one, repeated rows, shared and missing ids."""
    r = random.Random(3)
    long_ = " ".join(str(r.randrange(10**6)) for _ in range(20_000))
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (4, long_), (5, long_[500:900]), (6, "z" * 99), (7, "z" * 100), (8, "z" * 5000), (9, long_), (9, long_), (10, "é" * 400), (None, long_[40_000:41_000]), (None, None)]
    d = spark.createDataFrame([(*x, "t", 1, 0.5) for x in rows], SCHEMA).repartition(4)
    assert digest(suffix_dedup.dedup(d)) == sorted(brute(rows), key=str)


def test_rows_of_one_id(spark):
    """Which of two texts of one id comes first is set by their hashes; either way one string of each stays."""
    r = random.Random(4)
    part = [" ".join(str(r.randrange(10**6)) for _ in range(40)) for _ in range(3)]
    rows = [(1, part[0] + part[1]), (1, part[1] + part[2]), (None, part[2]), (None, part[2] + part[0])]
    d = spark.createDataFrame([(*x, "t", 1, 0.5) for x in rows], SCHEMA)
    got = suffix_dedup.dedup(d).collect()
    kept = b"".join(bytes(x.kept) for x in got)
    assert all(p.encode()[WIDTH:-WIDTH] in kept for p in part) and len(kept) < sum(map(len, part)) + 3 * 2 * WIDTH


def test_no_rows(spark):
    assert suffix_dedup.dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("block", [3, 7, 1 << 18])
def test_transform(tmp_path, monkeypatch, block):
    monkeypatch.setattr(collection_bwt, "BLOCK", block)
    r = random.Random(block)
    for trial in range(12):
        letters = b"ab" if trial % 2 else b"abcde\x00\xf4"
        strings = [bytes(r.choice(letters) for _ in range(r.randint(1, 12))) * (1 + 2 * (trial % 3 == 0)) for _ in range(r.randint(1, 25))]
        starts = np.concatenate([[0], np.cumsum([len(s) for s in strings])]).astype(np.int64)
        bwt, lcp = collection_bwt.build(np.frombuffer(b"".join(strings), np.uint8), starts, f"file://{tmp_path}")
        suffixes = sorted(([c + 1 for c in s[k:]], i, k) for i, s in enumerate(strings) for k in range(len(s) + 1))
        assert [strings[i][k - 1] + 1 if k else 0 for _, i, k in suffixes] == list(bwt)
        common = lambda a, b: next((n for n, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert [0, *(common(a[0], b[0]) for a, b in zip(suffixes, suffixes[1:]))] == list(lcp)
        groups = {}
        for string, offset, group in collection_bwt.suffix_groups(bwt, lcp, np.diff(starts), 4):
            for i, k, g in zip(string, offset, group):
                groups.setdefault(g, set()).add((i, k))
        want = {}
        for i, s in enumerate(strings):
            for k in range(len(s) - 3):
                want.setdefault(s[k : k + 4], set()).add((i, k))
        assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
    assert list(tmp_path.iterdir()) == []
