"""The pipeline's stages against what each must do to its own input."""

import random
import zlib

import corpus_pipeline as c
import numpy as np
import pytest

from tidemark.llm import bands, packing
from tests.llm.test_ops import SCHEMA, brute_components, brute_simhash, prose, words


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    r = random.Random(1)
    at = tmp_path_factory.mktemp("sf")
    docs, labels = [], []
    passage = prose(60, r)
    for i in range(240):
        t = prose(r.randint(40, 150), r)
        bad = i % 6 == 5
        if bad:
            t = t.upper().replace(" ", " $$$ ")
        elif i % 20 == 1:
            t = t + " " + passage + " " + prose(30, r)
        docs.append((i, t, "en", r.choice(["a", "b", "c"]), len(t)))
        labels.append((i, int(not bad), 0))
    docs += [(300, docs[0][1], "en", "a", 1), (301, docs[0][1], "en", "b", 1), docs[0]]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at), docs, passage


def test_stages(spark, corpus):
    at, docs, passage = corpus
    d = spark.read.parquet(f"{at}/documents.parquet")
    kept = c.quality(spark, d, at).collect()
    assert kept[0].asDict().keys() == set(c.COLUMNS)
    ids = {r["doc_id"] for r in kept}
    assert not any(i % 6 == 5 for i in ids if i < 300) and len(ids) >= 198
    d = spark.createDataFrame(kept, SCHEMA)

    near = c.near_duplicates(spark, d, at).collect()
    want = brute_components([brute_simhash(r["text"]) for r in kept], [r["doc_id"] for r in kept])
    assert sorted(r["doc_id"] for r in near) == sorted({i for i, k in want.items() if i == k})
    d = spark.createDataFrame(near, SCHEMA)

    left = c.repeated_passages(spark, d, at).collect()
    assert sum(passage in r["text"] for r in left) == 1
    same = {r["doc_id"]: r["text"] for r in near}
    assert all(r["text"] == same[r["doc_id"]] for r in left if r["doc_id"] % 20 != 1)
    d = spark.createDataFrame(left, SCHEMA)

    mixed = c.mixture(spark, d, at).collect()
    size = sum(len(words(r["text"])) for r in left)
    assert abs(sum(len(words(r["text"])) for r in mixed) - 1.5 * size) <= 3
    texts = {r["doc_id"]: r["text"] for r in left}
    assert all(texts[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"]) for r in mixed)

    pieces = c.packed(spark, spark.createDataFrame(mixed, SCHEMA), at).collect()
    assert sum(p["start"] == 0 for p in pieces) == len(mixed)
    t = packing.word_tokenizer(packing.public_tokenizers.path(packing.TOKENIZER))
    assert sum(p["length"] for p in pieces) == sum(len(np.frombuffer(x, "<u4")) + 1 for x in t.encode([r["text"] for r in mixed]))
    crc = {zlib.crc32(x + packing.END_ID.to_bytes(4, "little")) for x in t.encode([r["text"] for r in mixed])}
    assert all(p["ids_crc32"] in crc for p in pieces if p["length"] == p["doc_tokens"])


def test_run(spark, corpus):
    assert c.run(spark, corpus[0]).count() > 0


def test_empty_documents(spark, corpus, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert c.run(spark, str(tmp_path)).count() == 0


def test_mixture_rows_without_an_id(spark):
    r = random.Random(4)
    docs = [(None, prose(20 + i % 7, r), "en", "ab"[i % 2], 0) for i in range(60)] + [(i, prose(30, r), "en", "a", 0) for i in range(20)]
    docs += docs[:2] + docs[-1:]
    docs = [(i, t, lang, s, len(t)) for i, t, lang, s, _ in docs]
    mixed = c.mixture(spark, spark.createDataFrame(docs, SCHEMA).repartition(5), "").collect()
    whole = [r["text"] for r in mixed]
    assert abs(sum(len(words(t)) for t in whole) - 1.5 * sum(len(words(d[1])) for d in docs)) <= 3
    texts = [d[1] for d in docs]
    assert all(whole.count(t) <= 2 * texts.count(t) for t in set(texts))
    assert sum(t not in set(texts) for t in whole) <= 2  # one cut document a source


def test_edited_copies_are_near_duplicates(spark):
    r = random.Random(6)

    def grams(t):
        w = t.lower().split()
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)}

    docs = []
    for i in range(40):
        w = prose(r.randint(100, 200), r).split()
        docs.append((2 * i, " ".join(w)))
        for k in range(r.randint(1, 4)):
            w[20 * k + 10] = f"edited{i}"
        docs.append((2 * i + 1, " ".join(w)))
    j = [len(grams(a) & grams(b)) / len(grams(a) | grams(b)) for (_, a), (_, b) in zip(docs[::2], docs[1::2])]
    assert sum(0.8 <= x < 0.95 for x in j) > 10 and sum(x < 0.8 for x in j) > 3
    d = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in docs], SCHEMA).repartition(3)
    left = {x["doc_id"] for x in c.near_duplicates(spark, d, "").collect()}
    assert left == {2 * i for i in range(40)} | {2 * i + 1 for i, x in enumerate(j) if x < 0.8}


def test_near_duplicates_with_shared_and_missing_ids(spark):
    a, b, c_ = (prose(60, random.Random(i)) for i in range(3))
    docs = [(2, b), (5, a), (5, b), (7, a), (None, a), (None, c_), (None, c_), (9, None), (3, ""), (8, " \n"), (None, None), (2, b)]
    d = spark.createDataFrame([(i, t, "en", "s", 0 if t is None else len(t)) for i, t in docs], SCHEMA)
    got = sorted(((x["doc_id"], x["text"]) for x in c.near_duplicates(spark, d, "").collect()), key=str)
    assert got == sorted([(2, b), (5, a), (None, c_), (3, "")], key=str)


def test_pairs_of_a_crowded_key_are_all_linked(spark, monkeypatch):
    r = random.Random(8)
    rows = []
    for i in range(30):
        w = prose(120, r).split()
        rows.append((2 * i, np.unique(bands.shingles([x.encode() for x in w])).view(np.int64).tolist()))
        w[60] = "edited"
        rows.append((2 * i + 1, np.unique(bands.shingles([x.encode() for x in w])).view(np.int64).tolist()))
    assert len(rows) > bands.FEW + 2
    sh = spark.createDataFrame(rows, "node long, sh array<long>")
    met = spark.createDataFrame([(n, 1) for n, _ in rows], "node long, key long")
    for settings in ({}, {"BLOCK": 8}, {"FEW": 80}, {"CROWD": 40}):
        for k, v in settings.items():
            monkeypatch.setattr(bands, k, v)
        got = {x["node"]: x["component"] for x in bands.linked(met, sh, "crowded").collect()}
        assert got == {n: n - n % 2 for n, _ in rows}
        monkeypatch.undo()
