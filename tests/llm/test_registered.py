"""The registered queries over a whole table: columns, types, and what their contracts fix."""

import zlib

import pytest

from tidemark.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def run(spark, name, *columns):
    df = queries.QUERIES[name](spark, SF)
    assert df.dtypes[: len(columns)] == [tuple(c.split()) for c in columns]
    return df.collect()


def held_out(doc_id, parts, rest):
    return zlib.crc32(str(doc_id).encode()) % parts == rest


def test_packing(spark, docs):
    rows = run(spark, "op1_packing", "doc_id bigint", "start bigint", "length bigint", "ids_crc32 bigint", "doc_tokens bigint", "sequence_id bigint", "offset bigint")
    own, windows = {}, {}
    for r in rows:
        own.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert own.keys() == docs.keys()
    for pieces in own.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:k]) for k in range(len(pieces))] and sum(p[1] for p in pieces) == pieces[0][2]
    for pieces in windows.values():
        pieces.sort()
        assert [p[0] for p in pieces] == [sum(q[1] for q in pieces[:k]) for k in range(len(pieces))] and sum(p[1] for p in pieces) <= 4096
    assert sum(r.length for r in rows) > 0.9 * 4096 * len(windows)


def test_winnowing(spark, docs):
    rows = run(spark, "op2_winnowing", "doc_id bigint", "n_chars bigint", "edited_sha256 string", "fingerprint string", "edited_fingerprint string", "near_edited double", "near_next double")
    assert {r.doc_id: r.n_chars for r in rows} == {i: len(t) for i, t in docs.items()} and len(rows) == len(docs)
    by_text = {}
    assert all(by_text.setdefault(docs[r.doc_id], r.fingerprint) == r.fingerprint for r in rows)


def test_substring_dedup(spark, docs):
    rows = run(spark, "op3_substring_dedup", "doc_id bigint", "start bigint", "stop bigint", "kind string", "kept_doc_id bigint", "cluster_id bigint")
    assert rows and all(0 <= r.start < r.stop <= len(docs[r.doc_id].encode().split()) and r.kept_doc_id <= r.doc_id and r.cluster_id <= r.kept_doc_id for r in rows)


def test_simhash(spark, docs):
    rows = run(spark, "op4_simhash", "doc_id bigint", "fingerprint string", "component_id bigint")
    assert {r.doc_id for r in rows} == docs.keys() and len(rows) == len(docs)
    value = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert all(len(r.fingerprint) == 16 and r.component_id <= r.doc_id for r in rows)
    label = {r.doc_id: r.component_id for r in rows}
    near = [(a, b) for a in value for b in value if a < b and (value[a] ^ value[b]).bit_count() <= 2]
    low = {i: i for i in value}
    for _ in range(len(value)):
        before = dict(low)
        for a, b in near:
            low[a] = low[b] = min(low[a], low[b])
        if low == before:
            break
    assert label == low


@pytest.mark.parametrize("name, columns, parts, rest", [
    ("op6_quality_model", ("doc_id bigint", "held_out boolean", "score double", "predicted int"), 3, 1),
    ("op9_language_id", ("doc_id bigint", "held_out boolean", "lang_pred string", "score double"), 4, 2),
])
def test_models(spark, docs, name, columns, parts, rest):
    rows = run(spark, name, *columns)
    assert {r.doc_id: r.held_out for r in rows} == {i: held_out(i, parts, rest) for i in docs} and len(rows) == len(docs)
    assert all(0 <= r.score <= 1 for r in rows)
    if name == "op6_quality_model":
        assert all(r.predicted == (r.score >= 0.5) for r in rows)


def test_mixing(spark, docs):
    rows = run(spark, "op10_mixing", "doc_id bigint", "size bigint", "source_size bigint", "target double", "taken bigint")
    assert {r.doc_id: r.size for r in rows} == {i: len(t.encode().split()) for i, t in docs.items()}
    assert all(0 <= r.taken <= 2 * r.size and r.target <= 2 * r.source_size + 1e-6 for r in rows)
    source = {r.doc_id: r.source for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    taken, target = {}, {}
    for r in rows:
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        target[source[r.doc_id]] = r.target
    assert all(abs(taken[s] - target[s]) <= 1.5 for s in taken)
    assert sum(taken.values()) == pytest.approx(1.5 * sum(r.size for r in rows), abs=len(taken) * 1.5)
