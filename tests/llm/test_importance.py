"""Importance resampling against a plain version of its contract."""

import hashlib
import math
import re
import zlib
from collections import Counter

from tidemark.llm import importance, queries

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, bucket int, row string, weight double"


def grams(text):
    w = re.findall(r"[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return w, [" ".join(w[i : i + k]) for k in (1, 2, 3) for i in range(len(w) - k + 1)]


def brute(docs, target, percent=5, least=20):
    """(doc_id, n_features, weight, score) of each row, and the drawn ids in order."""
    bucket = lambda g: zlib.crc32(g.encode()) % 10000
    s, t = Counter(), Counter()
    for counts, texts in ((s, (x for _, x in docs)), (t, target)):
        for x in texts:
            counts.update(map(bucket, grams(x)[1]))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    rows, able = [], []
    for i, x in docs:
        w, g = grams(x)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in g)
        rows.append((i, len(g), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        able += [rows[-1]] if len(w) >= least else []
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0]))
    return rows, [(r[0], k + 1) for k, r in enumerate(able[: percent * len(able) // 100])]


def test_whole_tables(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows, drawn = brute(docs, target)
    have = queries.QUERIES["op11_importance"](spark, SF)
    assert have.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    got = have.collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(rows)
    assert sorted(((r.doc_id, r.rank) for r in got if r.rank), key=lambda r: r[1]) == drawn and len(drawn) > 3


def test_odd_rows(spark):
    """Nulls, texts without words, one very long text, repeated rows and ids, clashing columns."""
    long_ = " ".join(f"w{i % 911} Straße" for i in range(20000))
    docs = [(1, None), (2, ""), (3, "-- ** --"), (4, long_), (5, "ÄPFEL äpfel İstanbul a_b 9z"), (None, "x " * 30), (None, None), (4, long_), (7, "q r s " * 10), (7, "q r s " * 10), (8, "one"), (9, "one two")]
    target = ["q r s", None, "", "x x"]
    d = spark.createDataFrame([(*r, 7, "r", 0.5) for r in docs], SCHEMA).repartition(4)
    t = spark.createDataFrame([(x,) for x in target], "text string")
    rows, drawn = brute(docs, target, 60)
    got = importance.resample(d, t, percent=60).collect()
    assert sorted((tuple(r)[:4] for r in got), key=str) == sorted(rows, key=str)
    assert [(r.doc_id, r.rank) for r in sorted((r for r in got if r.rank), key=lambda r: r.rank)] == drawn and len(drawn) == 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b " * 20)], "doc_id long, text string")
    assert importance.resample(none, one).collect() == []
    assert [tuple(r) for r in importance.resample(one, none, percent=100).select("doc_id", "n_features", "rank").collect()] == [(1, 117, 1)]


def test_ranks_over_many_partitions(spark):
    d = spark.range(5000).selectExpr("id AS doc_id", "id % 7 AS score", "id AS row").repartition(9)
    got = importance.ranked(d, 4000).collect()
    want = {i: k + 1 for k, i in enumerate(sorted(range(5000), key=lambda i: (-(i % 7), i)))}
    assert all(r["rank"] == (want[r.doc_id] if want[r.doc_id] <= 4000 else None) for r in got) and len(got) == 5000


def test_stays_in_the_jvm(spark):
    d = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    plan = importance.features(d.select("doc_id", importance.words(d.text).alias("words")), "doc_id")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
