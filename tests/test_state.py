"""Keyset resume, the inventory's state machine and the stream."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import changes, inventory, reporting
from tidemark.sources import tables
from tidemark.streaming import incremental

NOW = "2020-01-10 00:00:00"
ITEM = "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long, first_seen_run long, last_seen_run long, last_written_run long, last_written_utc timestamp, state int, pending_since_utc timestamp, deleted_utc timestamp, unchanged_streak int"


def test_resume_loses_and_repeats_nothing(spark):
    r = random.Random(4)
    start = datetime(2020, 1, 1)
    rows = [(f"k{i:03}", start + timedelta(seconds=r.randint(0, 12))) for i in range(60)] + [("never", None)]
    d = spark.createDataFrame(rows, "k string, t timestamp").cache()
    for cut in (1, 7, 23, 59):
        first = changes.incremental(d, "t", "k", most=cut).collect()
        last = first[-1]
        rest = changes.incremental(d, "t", "k", marker_time=last["t"], marker_key=last["k"]).collect()
        assert [x["k"] for x in first + rest] == [k for k, _ in sorted(rows[:-1], key=lambda x: (x[1], x[0]))]
    again = changes.incremental(d, "t", "k", marker_time=start + timedelta(seconds=6), marker_key="k500", slack_seconds=2).collect()
    assert all(x["t"] > start + timedelta(seconds=4) for x in again)
    below = changes.incremental(d, "t", "k", ceiling=start + timedelta(seconds=6)).collect()
    assert below and all(x["t"] < start + timedelta(seconds=6) for x in below)


def test_keyset_reaches_the_scan(spark, tmp_path):
    spark.range(100).select(F.col("id").alias("k"), F.timestamp_seconds("id").alias("t")).write.parquet(f"{tmp_path}/x")
    d = changes.incremental(spark.read.parquet(f"{tmp_path}/x"), "t", "k", marker_time="1970-01-01 00:00:50", marker_key=50)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t)" in plan and "GreaterThan(t" in plan
    assert d.count() == 49


class Model:
    """The inventory as a dictionary."""

    def __init__(self):
        self.items = {}

    def write(self, keys, run):
        for k in keys:
            old = self.items.get(k, {})
            self.items[k] = {"state": 1, "first": old.get("first", run), "seen": run, "streak": 0}

    def unchanged(self, keys, run):
        for k in keys:
            if self.items.get(k, {}).get("state") == 1:
                self.items[k] |= {"seen": run, "streak": self.items[k]["streak"] + 1}

    def sweep(self, run):
        for v in self.items.values():
            if v["state"] == 1 and v["seen"] < run:
                v["state"] = 2
        return sorted(k for k, v in self.items.items() if v["state"] == 2)

    def confirm(self, keys):
        for k in keys:
            if self.items[k]["state"] == 2:
                self.items[k]["state"] = 3


def test_inventory_follows_the_model(spark):
    r, model = random.Random(8), Model()
    inv = spark.createDataFrame([], ITEM)
    frame = lambda keys: spark.createDataFrame([("c", k, "t", f"h{k}", "a", 1) for k in keys], "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long")
    for run in range(1, 6):
        keys = [f"i{k}" for k in r.sample(range(12), 8)]
        judged = {x["item_id"]: x["action"] for x in inventory.compare_and_see(inv, frame(keys)).collect()}
        new = [k for k in keys if judged[k] == "write"]
        same = [k for k in keys if judged[k] == "unchanged"]
        assert same == [k for k in keys if model.items.get(k, {}).get("state") == 1]
        inv = inventory.record_unchanged(inventory.record_written(inv, frame(new), run, NOW), frame(same), run)
        model.write(new, run)
        model.unchanged(same, run)
        runs = spark.createDataFrame([(run, "c", 1, False)], "run_id long, connection_id string, mode int, is_dry_run boolean")
        inv, pending = inventory.sweep(inv, runs, "c", run, NOW, 100)
        gone = [x["item_id"] for x in pending.collect()]
        assert gone == model.sweep(run)
        inv = inventory.confirm_deletes(inv, frame(gone[::2]), NOW) if gone else inv
        model.confirm(gone[::2])
        inv = spark.createDataFrame(inv.collect(), ITEM)
        have = {x["item_id"]: {"state": x["state"], "first": x["first_seen_run"], "seen": x["last_seen_run"], "streak": x["unchanged_streak"]} for x in inv.collect()}
        assert have == model.items
        assert all((x["state"] == 2) == (x["pending_since_utc"] is not None) and (x["state"] == 3) == (x["deleted_utc"] is not None) for x in inv.collect())


def test_sweep_guards(spark):
    inv = spark.createDataFrame([("c", f"i{k}", "t", "h", "a", 1, 1, 1 if k < 3 else 2, 1, None, 1, None, None, 0) for k in range(10)], ITEM)
    runs = spark.createDataFrame([(2, "c", 1, False), (3, "c", 2, False), (4, "c", 1, True)], "run_id long, connection_id string, mode int, is_dry_run boolean")
    for args, code in (((9, "c"), 50004), ((2, "d"), 50005), ((3, "c"), 50006), ((2, "c"), 50007)):
        with pytest.raises(inventory.Refused) as e:
            inventory.sweep(inv, runs, args[1], args[0], NOW)
        assert e.value.code == code
    assert inventory.sweep(inv, runs, "c", 4, NOW)[1].count() == 0
    assert inventory.sweep(inv, runs, "c", 2, NOW, override=True)[1].count() == 3
    assert [str(inventory.guard_percent(x)) for x in (float("nan"), -1, 0.005, 12.345, 500)] == ["0.00", "0.00", "0.01", "12.35", "100.00"]


def test_finish_run(spark):
    runs = spark.createDataFrame([(1, 1, None, 0, 0), (2, 2, None, 0, 0)], "run_id long, status int, completed_utc timestamp, items_written int, items_failed int")
    out = inventory.finish_run(runs, 1, NOW, {"items_written": 5, "items_failed": 1}).where("run_id = 1").first()
    assert (out["status"], out["items_written"], out["items_failed"]) == (5, 5, 1) and out["completed_utc"] is not None
    with pytest.raises(inventory.Refused):
        inventory.finish_run(runs, 2, NOW, {})


def test_checkpoint_moves_forward_only(spark):
    schema = "connection_id string, marker_time timestamp, marker_key string, run_id long, run_count long"
    old = spark.createDataFrame([("a", datetime(2020, 1, 2), "k5", 1, 1), ("b", datetime(2020, 1, 2), "k5", 1, 1)], schema)
    saved = spark.createDataFrame([("a", 2, datetime(2020, 1, 2), "k4"), ("b", 2, datetime(2020, 1, 2), "k6"), ("c", 2, datetime(2020, 1, 1), "k1")], "connection_id string, run_id long, marker_time timestamp, marker_key string")
    got = {r["connection_id"]: (r["marker_key"], r["run_id"], r["run_count"]) for r in inventory.save_checkpoints(old, saved).collect()}
    assert got == {"a": ("k5", 1, 2), "b": ("k6", 2, 2), "c": ("k1", 2, 1)}


def test_purge_keeps_what_is_referred_to(spark):
    runs = spark.createDataFrame([(i, 2, datetime(2019, 1, i)) for i in range(1, 7)], "run_id long, status int, started_utc timestamp")
    inv = spark.createDataFrame([("c", "x", "t", "h", "a", 1, 1, 2, 3, None, 1, None, None, 0), ("c", "y", "t", "h", "a", 1, 5, 5, 5, None, 3, None, datetime(2019, 1, 1), 0)], ITEM)
    points = spark.createDataFrame([("c", 4)], "connection_id string, run_id long")
    out = inventory.purge({"run": runs, "item": inv, "checkpoint": points}, NOW)
    assert {r["run_id"] for r in out["run"].collect()} == {1, 2, 3, 4} and [r["item_id"] for r in out["item"].collect()] == ["x"]


def test_alerts_persist(spark):
    one = spark.createDataFrame([("a", "Stale", "page", False), ("a", "DeletesPending", "ticket", True)], "connection_id string, condition string, severity string, transient boolean")
    none = one.where("condition = 'none'")
    assert {r["condition"] for r in reporting.persistent([none, one]).collect()} == {"Stale"}
    assert reporting.persistent([one, one]).count() == 2


def test_source_rules(spark):
    d = spark.range(5)
    assert tables.guarded(d, {"row policies": 0}).count() == 5
    for n in (1, None):
        with pytest.raises(tables.SourceRefused):
            tables.guarded(d, {"row policies": n})
    with pytest.raises(tables.SourceRefused):
        tables.within_budget(d, 4)
    with pytest.raises(tables.SourceRefused):
        tables.validated(d, ["ID", "name"])
    assert tables.without_table_prefix(d.withColumnRenamed("id", "t.id")).columns == ["id"]
    docs = spark.createDataFrame([("5f000000aaaaaaaaaaaaaaaa", "t", None, None, "b", None, ["x", " "], False), (None, "t", None, None, "b", None, None, False), ("z", "t", None, None, "b", None, None, True)], "_id string, title string, status string, owner string, body string, updatedAt timestamp, classifications array<string>, isDeleted boolean")
    (r,) = tables.document_items(docs, "m").collect()
    assert r["item_id"] == "m5f000000aaaaaaaaaaaaaaaa" and r["classifications"] == ["x"] and r["last_modified"].year == 2020
    rec = spark.createDataFrame([("1", "a", "b", None, "x, y"), (" ", "a", "b", None, None)], "record_id string, title string, body string, last_modified timestamp, tags string")
    (r,) = tables.record_items(rec, "rec", classifications="tags").collect()
    assert r["item_id"] == "rec1" and r["classifications"] == ["x", "y"]
    b = tables.error_budget(spark.createDataFrame([(i >= 9,) for i in range(60)], "ok boolean")).first()
    assert (b["examined"], b["failures"], b["percent"], b["exceeded"]) == (60, 9, 15, True)


def test_stream_applies_each_file_once(spark, tmp_path):
    schema = "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long, run_id long"
    write = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    go = lambda: incremental.follow(spark, f"{tmp_path}/in", spark.createDataFrame([], schema).schema, f"{tmp_path}/state", f"{tmp_path}/check", NOW).awaitTermination()
    write([("c", "a", "t", "h1", "x", 1, 1), ("c", "b", "t", "h1", "x", 1, 1)])
    go()
    write([("c", "a", "t", "h1", "x", 1, 2), ("c", "b", "t", "h2", "x", 1, 2)])
    go()
    go()
    got = {r["item_id"]: (r["unchanged_streak"], r["content_hash"], r["first_seen_run"]) for r in incremental.inventory_of(spark, f"{tmp_path}/state").collect()}
    assert got == {"a": (1, "h1", 0), "b": (0, "h2", 0)}


RUN = "run_id long, connection_id string, mode int, status int, is_dry_run boolean, started_utc timestamp, completed_utc timestamp, heartbeat_utc timestamp, items_written long, items_unchanged long, items_deleted long, items_failed long"


def _begin(spark, runs, **how):
    checkpoints = spark.createDataFrame([("a", None)], "connection_id string, marker_time timestamp")
    connections = spark.createDataFrame([("a", how.pop("stamp", None))], "connection_id string, hash_version int")
    return inventory.begin_run(spark.createDataFrame(runs, RUN), checkpoints, connections, "a", 9, "2024-01-02", **how)


def test_begin_run_refuses_abandons_and_escalates(spark):
    held = (1, "a", 2, 1, False, datetime(2024, 1, 1, 23), None, datetime(2024, 1, 1, 23, 59), 0, 0, 0, 0)
    with pytest.raises(inventory.Refused, match="50043"):
        _begin(spark, [held])
    got = {r["run_id"]: r for r in _begin(spark, [held, (2, "b", *held[2:])], lease_seconds=10).collect()}
    assert (got[1]["status"], got[2]["status"], got[9]["status"]) == (inventory.ABANDONED, inventory.RUNNING, inventory.RUNNING)
    assert got[9]["mode"] == inventory.FULL  # no full run yet
    assert _begin(spark, []).count() == 1


def test_hash_version_decides_on_a_full_run(spark):
    c = spark.createDataFrame([("new", None), ("same", 1), ("old", 0)], "connection_id string, hash_version int")
    assert {r["connection_id"]: r["changed"] for r in inventory.hash_version_due(c, 1).collect()} == {"new": False, "same": False, "old": True}


def test_heartbeat_never_goes_back(spark):
    at = datetime(2024, 1, 2)
    runs = spark.createDataFrame([(k, "a", 2, s, False, at, None, at, 0, 0, 0, 0) for k, s in ((1, 1), (2, 2))], RUN)
    pulse = lambda df: {r["run_id"]: r["heartbeat_utc"] for r in df.collect()}
    assert pulse(inventory.heartbeat(runs, 1, "2024-01-03")) == {1: datetime(2024, 1, 3), 2: at}
    assert pulse(inventory.heartbeat(runs, 2, "2024-01-03")) == pulse(inventory.heartbeat(runs, 1, "2024-01-01")) == {1: at, 2: at}


@pytest.mark.parametrize("mode, dry, swept", [(1, False, 1), (2, False, 0), (1, True, 0)])
def test_a_run_records_sweeps_and_ends(spark, mode, dry, swept):
    at = datetime(2024, 1, 1)
    item = ITEM
    inv = spark.createDataFrame([("a", k, "t", "h", "g", 1, 1, 1, 1, at, 1, None, None, 3) for k in ("same", "changed", "gone")] + [("b", "other", "t", "h", "g", 1, 1, 1, 1, at, 1, None, None, 3)], item)
    runs = spark.createDataFrame([(9, "a", mode, 1, dry, at, None, at, 0, 0, 0, 0)], RUN)
    source = spark.createDataFrame([("a", "same", "t", "h", "g", 1), ("a", "changed", "t", "x", "g", 1), ("a", "new", "t", "h", "g", 1)], "connection_id string, item_id string, item_type string, content_hash string, acl_hash string, content_bytes long")
    out, ended = inventory.full_run(inv, runs, source, "a", 9, "2024-01-02", override=True)
    got = {r["item_id"]: (r["state"], r["last_seen_run"], r["unchanged_streak"]) for r in out.collect()}
    end = ended.first()
    assert (end["status"], end["items_written"], end["items_unchanged"], end["items_deleted"]) == (inventory.SUCCEEDED, 2, 1, swept)
    if dry:
        assert got == {k: (1, 1, 3) for k in ("same", "changed", "gone", "other")}
    else:
        assert got == {"same": (1, 9, 4), "changed": (1, 9, 0), "new": (1, 9, 0), "gone": (3 if swept else 1, 1, 3), "other": (1, 1, 3)}
    with pytest.raises(inventory.Refused, match="50004"):
        inventory.full_run(inv, runs, source, "a", 8, "2024-01-02")
