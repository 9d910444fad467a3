"""Probes of the cascade touch one row of each level: no table goes through the driver, and picks are shared."""

from datetime import datetime, timedelta

from tidemark.operators import changes, probes

AT = datetime(2024, 1, 1)


def _tables(spark):
    old = lambda k: AT - timedelta(days=k)
    c = spark.createDataFrame([(1, old(9)), (2, old(8)), (3, AT)], "customer_id long, effective_modified timestamp")
    e = spark.createDataFrame([(k, 1 + k % 2, old(k)) for k in range(1, 6)], "engagement_id long, customer_id long, effective_modified timestamp")
    t = spark.createDataFrame([(k, 1 + k % 5, old(k % 4 + 1)) for k in range(1, 40)], "entry_id long, engagement_id long, effective_modified timestamp")
    return c, e, t


def test_stale_children_are_counted_without_a_broadcast(spark):
    c, e, t = _tables(spark)
    d = changes.stale_edges(c.unionByName(c.where("customer_id = 1")), e, t)
    got = {x["edge"]: x["stale"] for x in d.collect()}
    up, of, em = {1: 9, 2: 8}, {k: 1 + k % 2 for k in range(1, 6)}, {k: k for k in range(1, 6)}  # in days before AT
    twice = lambda k: 2 if of[k] == 1 else 1
    entries = [(1 + k % 5, k % 4 + 1) for k in range(1, 40)]
    assert got == {
        "engagement<customer": sum(twice(k) for k in em if em[k] > up[of[k]]), "entry<engagement": sum(m > em[k] for k, m in entries), "entry<customer": sum(twice(k) for k, m in entries if m > up[of[k]]),
    }
    assert got["entry<engagement"] > 0
    assert "Broadcast" not in d._jdf.queryExecution().executedPlan().toString()


def test_probes_share_what_they_touch(spark):
    tables = _tables(spark)
    touch = lambda t, k, ids: probes.touched(t, k, ids, AT)
    picks = probes.chosen(tables, AT)
    assert [(x["id"], x["child_id"]) for p in picks for x in p.collect()] == [(1, 2), (1, 5), (1, None)]
    got = probes.cascade_probes(tables, touch, AT, picks).collect()
    assert got == probes.cascade_probes(tables, touch, AT).collect()
    assert [(x["id"], x["child_id"], x["own_moved"], x["child_moved"], x["verdict"]) for x in got[:3]] == [(1, 2, True, True, "ok"), (1, 5, True, True, "ok"), (1, None, True, None, "ok")]
