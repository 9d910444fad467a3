"""One-pass runs, seek paging, resuming over levels, byte caps, principals, bad rows and the stream's state."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators import changes, flatten, inventory, principals, probes, reporting
from tidemark.plans.fixtures import fixture
from tidemark.sources import tables
from tidemark.streaming import incremental

SF = "/root/testdata/sf0.001"
ITEM = "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long, first_seen_run long, last_seen_run long, last_written_run long, last_written_utc timestamp, state int, pending_since_utc timestamp, deleted_utc timestamp, unchanged_streak int"
RUN = "run_id long, connection_id string, mode int, status int, is_dry_run boolean, started_utc timestamp, completed_utc timestamp, heartbeat_utc timestamp, items_written long, items_unchanged long, items_deleted long, items_failed long"
SOURCE = "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long"
AT = datetime(2024, 1, 1)


def _run(spark, lost, foreign=False, **how):
    """A full run over 40 items of which the source has lost some; the source counts how often a row is read."""
    reads = spark.sparkContext.accumulator(0)
    inv = spark.createDataFrame([("a", f"i{k}", "t", "h", "g", 1, 1, 1, 1, AT, 1, None, None, 0) for k in range(40)], ITEM)
    rows = spark.createDataFrame([("b" if foreign and k == 0 else "a", f"i{k}", "t", "h", "g", 1) for k in range(40 - lost)], SOURCE)

    def counted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    runs = spark.createDataFrame([(9, "a", 1, 1, False, AT, None, AT, 0, 0, 0, 0)], RUN)
    out, ended = inventory.full_run(inv, runs, rows.mapInArrow(counted, SOURCE), "a", 9, "2024-01-02", **how)
    return out, ended, reads


def test_a_full_run_reads_its_source_once(spark):
    out, ended, reads = _run(spark, 3)
    assert {r["state"]: r["count"] for r in out.groupBy("state").count().collect()} == {1: 37, 3: 3}
    assert ended.first()["items_deleted"] == 3 and ended.first()["items_unchanged"] == 37
    assert out.count() == 40 and reads.value == 37


def test_the_guard_and_foreign_candidates(spark):
    with pytest.raises(inventory.Refused, match="50007: 5 of 40"):
        _run(spark, 5)
    assert _run(spark, 5, override=True)[1].first()["items_deleted"] == 5
    assert _run(spark, 4, most_percent=10)[1].first()["items_deleted"] == 4
    with pytest.raises(inventory.Refused, match="50005"):
        _run(spark, 0, foreign=True)


@pytest.mark.parametrize("falls", [(True, False), (False, True)])
def test_pages_by_cursor_are_the_whole_list(spark, falls):
    r = random.Random(1)
    rows = [(r.choice([None, *range(4)]), r.choice([None, "a", "b"]), i) for i in range(37)]
    d = spark.createDataFrame(rows, "x int, y string, id int").repartition(3)
    order = [("x", falls[0]), ("y", falls[1]), ("id", True)]
    whole = [x["id"] for x in d.orderBy(*(F.col(c).desc() if f else F.col(c).asc() for c, f in order)).collect()]
    cursor, got = None, []
    while True:
        page = reporting.seek_page(d, order, size=5, cursor=cursor, secret=b"s", scope="all")
        got += [x["id"] for x in page.collect()]
        if (cursor := reporting.next_cursor(page, order, secret=b"s", scope="all")) is None:
            break
        assert "TakeOrdered" in page._jdf.queryExecution().executedPlan().toString()
        last = cursor
    assert got == whole
    for bad, how in ((last[:-1] + ("0" if last[-1] != "0" else "1"), {}), (last, {"scope": "other"}), (last, {"secret": b"t"})):
        with pytest.raises(ValueError):
            reporting.seek_page(d, order, cursor=bad, **({"secret": b"s", "scope": "all"} | how))


def test_resuming_over_levels_takes_each_item_once(spark, tmp_path):
    h = changes.effective_modified(*(fixture(spark, SF, n) for n in ("customers", "engagements", "entries")))
    stored = []
    for name, t in zip("cet", h):
        t.write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    every = [tuple(x) for x in changes.resume_items(*stored).select("effective_modified", "level", "source_id").collect()]
    assert every == sorted(every) and len(every) == flatten.all_items(*h).count()
    for cut in (1, len(every) // 3, len(every) - 1):
        rest = changes.resume_items(*stored, marker=every[cut - 1])
        assert [tuple(x) for x in rest.select("effective_modified", "level", "source_id").collect()] == every[cut:]
    first = changes.resume_items(*stored, most=7, ceiling=every[3][0])
    assert [x["marker"] for x in first.collect()] == [e[0] if e[0] < every[3][0] else None for e in every[:7]]
    plan = rest._jdf.queryExecution().executedPlan().toString()
    pushed = [x for x in plan.split("PushedFilters: [")[1:] if "effective_modified" in x.split("]")[0] and ("GreaterThan" in x.split("]")[0])]
    assert len(pushed) >= 3  # each level's own scan


def test_no_item_is_larger_than_the_cap(spark):
    r = random.Random(2)
    letters = ["a", "é", "漢", "\n", '"', "😀"]
    rows = [(str(i), "o" * r.choice([1, 50, 130, 400]), "".join(r.choice(letters) for _ in range(r.randint(0, 300)))) for i in range(120)]
    d = text.fitted(spark.createDataFrame([*rows, ("x", "o", None)], "item_id string, owner string, content string"), "content", 300, 400, 30)
    for x in d.collect():
        if x["skipped"] is None:
            size = len(json.dumps({"item_id": x["item_id"], "owner": x["owner"], "content": x["content"]}, ensure_ascii=False, separators=(",", ":")).encode())
            assert x["item_bytes"] == size <= 400 and x["final_bytes"] == len(x["content"].encode())
            assert x["truncated"] or x["content"] == dict((a, c) for a, _, c in rows).get(x["item_id"], "")
        else:
            assert x["content"] is None and len(x["owner"]) >= 130
    assert {x["skipped"] is None for x in d.collect()} == {True, False}


def test_names_are_resolved_in_order(spark):
    guid = "ABCDEF01-2345-6789-ABCD-0123456789ab"
    wanted = spark.createDataFrame([("c", n) for n in ("Run", "run", "Map", "Bad", "Store", "Old", "Dir", "Nobody", " ", None)], "connection_id string, name string")
    found = spark.createDataFrame([("c", "RUN", None), ("other", "Dir", "x")], "connection_id string, name string, object_id string")
    told = spark.createDataFrame([("map", "{" + guid + "}"), ("BAD", "no id"), ("run", guid)], "name string, object_id string")
    later, past = AT + timedelta(hours=1), AT - timedelta(hours=1)
    store = spark.createDataFrame([("c", "store", "s", later), ("c", "map", "s", later), ("c", "old", "s", past)], "connection_id string, source_key string, object_id string, expires_utc timestamp")
    directory = spark.createDataFrame([("DIR", "d"), ("old", "o"), ("bad", "b"), ("store", "no")], "name string, object_id string")
    got = principals.resolve_in_order(wanted, found, told, store, directory, AT)
    assert {x["name"]: (x["object_id"], x["provenance"]) for x in got.collect()} == {
        "run": (None, "run"), "map": (guid.lower(), "map"), "bad": ("b", "directory"), "store": ("s", "store"), "old": ("o", "directory"), "dir": ("d", "directory"), "nobody": (None, "directory"),
    }
    assert {x["source_key"]: x["object_id"] for x in principals.to_store(got).collect()} == {"bad": "b", "old": "o", "dir": "d", "nobody": None}
    alone = principals.resolve_in_order(wanted, found, told, store, None, AT)
    assert {x["name"] for x in alone.where("provenance = 'none'").collect()} == {"bad", "old", "dir", "nobody"} and principals.to_store(alone).isEmpty()


def test_bad_rows_are_named_by_place_alone(spark, tmp_path):
    spark.createDataFrame([("a", "1"), (" ", "x"), ("b", "secret"), (None, "2"), ("c", None)], "k string, n string").coalesce(1).write.parquet(f"{tmp_path}/t")
    rows = tables.mapped(tables.numbered(spark, f"{tmp_path}/t"), {"key": ("k", "string"), "size": ("n", "int")}, "key")
    assert [(x["ordinal"], x["outcome"], x["error"], x["key"], x["size"]) for x in rows.orderBy("ordinal").collect()] == [
        (1, "mapped", None, "a", 1), (2, "skipped", None, None, None), (3, "bad", "size: not a int", None, None), (4, "skipped", None, None, None), (5, "mapped", None, "c", None),
    ]
    with pytest.raises(tables.SourceRefused, match=r"row 3 \(size: not a int\)") as refused:
        tables.refuse_bad_rows(rows)
    assert "secret" not in str(refused.value)
    assert tables.refuse_bad_rows(rows.where("outcome <> 'bad'")).columns == ["key", "size"]


def test_a_probe_without_rows_is_skipped(spark):
    none = [spark.createDataFrame([], s) for s in ("customer_id long, effective_modified timestamp", "engagement_id long, customer_id long, effective_modified timestamp", "entry_id long, engagement_id long, effective_modified timestamp")]
    got = probes.cascade_probes(tuple(none), lambda t, k, ids: probes.touched(t, k, ids, AT), AT).collect()
    assert [x["verdict"] for x in got] == ["skipped"] * 3 + ["ok"] * 3


def test_a_batch_rewrites_its_buckets_only(spark, tmp_path):
    state = str(tmp_path / "state")
    batch = lambda ids, run, h="h": spark.createDataFrame([("c", f"i{k}", "t", h, "g", 1, run) for k in ids], SOURCE + ", run_id long")
    incremental.apply_batch(batch(range(300), 0), 0, state, AT, buckets=16)
    size = lambda n: sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{state}/data/v={n}") for f in fs)
    for _ in range(2):  # run twice, the same result
        incremental.apply_batch(batch([7], 1, "new"), 1, state, AT, buckets=16)
        assert len([x for x in os.listdir(f"{state}/data/v=1") if x.startswith("bucket=")]) == 1 and size(1) < size(0) / 4
        got = {r["item_id"]: (r["content_hash"], r["last_written_run"]) for r in incremental.inventory_of(spark, state).collect()}
        assert len(got) == 300 and got["i7"] == ("new", 1) and all(v == ("h", 0) for k, v in got.items() if k != "i7")
