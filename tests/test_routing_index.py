"""The pattern index and the folder fold against plain versions, and their plans."""

import json
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entitlement as en


def _pattern(value, path=False):
    out = "".join({"*": "[^/]*" if path else ".*", "?": "[^/]" if path else "."}.get(c, re.escape(c)) for c in value)
    return out


def _covers(value, name, excludes):
    hit = any(re.fullmatch(_pattern(v), name, re.I | re.S | re.A) for v in value)
    return bool(value) and hit != excludes


def _random_policy(r, i):
    word = lambda: "".join(r.choice("abAé_1") for _ in range(r.randint(1, 4)))
    value = lambda: r.choice([word(), word() + "*", "*" + word(), word() + "?" + word(), "*" + word() + "*", "*", "?", "*?", word() + "*" + word()])
    some = lambda: [value() for _ in range(r.choice([1, 1, 1, 2, 0]))]
    return {"id": i, "resources": {"database": {"values": some(), "isExcludes": r.random() < 0.15}, "table": {"values": some(), "isExcludes": r.random() < 0.15}}, "policyItems": [{"groups": [f"g{i}"], "accesses": [{"type": "select"}]}]}


def _policies(spark, ps):
    return en.parse_policies(spark.createDataFrame([(json.dumps(p),) for p in ps], "value string"))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_names(spark, seed):
    r = random.Random(seed)
    ps = [_random_policy(r, i) for i in range(60)]
    names = sorted({"".join(r.choice("aAbBé_1") for _ in range(r.randint(1, 6))) for _ in range(25)})
    tables = [(a, b) for a in names[:8] for b in names]
    got = en.route_tables(spark.createDataFrame(tables, "database string, table string"), _policies(spark, ps)).collect()
    want = {(a, b): sorted(f"g{p['id']}" for p in ps if all(_covers(p["resources"][n]["values"], x, p["resources"][n]["isExcludes"]) for n, x in (("database", a), ("table", b)))) for a, b in tables}
    assert {(x["database"], x["table"]): sorted(x["groups"]) for x in got} == want and len(got) == len(tables)


def test_random_paths(spark):
    r = random.Random(3)
    part = lambda: r.choice(["a", "b", "A", "ab", "a*", "?", "*", "b?"])
    ps = []
    for i in range(50):
        v = "/" + "/".join(part() for _ in range(r.randint(1, 3))) + r.choice(["", "/"])
        ps.append({"id": i, "resources": {"path": {"values": [v] if r.random() < 0.95 else ["/"], "isRecursive": r.random() < 0.5, "isExcludes": r.random() < 0.1}}, "policyItems": [{"groups": [f"g{i}"], "accesses": [{"type": "read"}]}], "denyPolicyItems": [{"groups": ["x"], "accesses": []}] if r.random() < 0.1 else []})
    paths = sorted({"/" + "/".join(r.choice(["a", "b", "A", "ab", "abb"]) for _ in range(r.randint(1, 4))) for _ in range(80)}) + ["/"]

    def covers(p, path, recursive):
        v = p["resources"]["path"]
        value = v["values"][0].rstrip("/") or "/"
        if value == "/":
            return bool(re.fullmatch("/.*" if recursive else "/", path, re.S))
        return bool(re.fullmatch(_pattern(value, True) + ("(/.*)?" if recursive else ""), path, re.S))

    want = {}
    for path in paths:
        flags = [(p, p["resources"]["path"]["isExcludes"]) for p in ps]
        grants = [p for p, but in flags if covers(p, path, p["resources"]["path"]["isRecursive"]) != but]
        denied = any(p["denyPolicyItems"] and (covers(p, path, True) if not but else not covers(p, path, False)) for p, but in flags)
        want[path] = ("live query", []) if denied else ("index", sorted(f"g{p['id']}" for p in grants))
    got = en.route_paths(spark.createDataFrame([(p,) for p in paths], "path string"), _policies(spark, ps)).collect()
    assert {x["path"]: (x["verdict"], sorted(x["groups"])) for x in got} == want


def test_plan_joins_by_equality(spark):
    """Literal and prefix policies: no nested loop, also if policies are too many to be broadcast."""
    ps = _policies(spark, [{"id": i, "resources": {"database": {"values": [f"d{i}"]}, "table": {"values": ["t*"]}}, "policyItems": []} for i in range(5)])
    d = spark.createDataFrame([("d1", "t1"), ("d2", "x")], "database string, table string")
    plan = lambda: en.route_tables(d, ps)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan() and "Cartesian" not in plan()
    most, en.MAX_BROADCAST_POLICIES = en.MAX_BROADCAST_POLICIES, 2
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
        assert "NestedLoop" not in plan() and "Broadcast" not in plan() and "Cartesian" not in plan()
    finally:
        en.MAX_BROADCAST_POLICIES = most
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_gates_of_random_trees(spark):
    r = random.Random(4)
    dirs = {"/"} | {"/" + "/".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(40)}
    known = {d: (r.choice(["755", "750", "710", "700"]), r.choice(["g1", "g2", "g3"]), r.choice([None, ["group::--x", "group:g1:--x", "group:g2:r-x"]])) for d in dirs if r.random() < 0.7}
    files = [f"{d.rstrip('/')}/f{i}" for i, d in enumerate(sorted(dirs)) for _ in range(1)] + ["/top", "/unknown/x/y"]

    def passes(d):
        mode, group, acl = known[d]
        if int(mode[2]) & 1:
            return None
        mask = int(mode[1]) & 1
        if acl is None:
            return {group} if mask else set()
        return ({group} | {"g1", "g2"}) if mask else set()

    want = {}
    for f in files:
        at, gate, everyone = f.rsplit("/", 1)[0] or "/", None, True
        while True:
            if at in known and (own := passes(at)) is not None:
                gate, everyone = own if gate is None else gate & own, False
            if at == "/":
                break
            at = at.rsplit("/", 1)[0] or "/"
        want[f] = (gate, everyone)
    fs = spark.createDataFrame([(f, i) for i, f in enumerate(files)], "path string, n int")
    ds = spark.createDataFrame([(d, m, a, g) for d, (m, g, a) in known.items()], "path string, permission string, acl array<string>, group string")
    got = en.traverse_gates(fs, ds)
    assert got.columns == ["path", "n", "gate", "everyone"]
    assert {r_["path"]: (None if r_["gate"] is None else set(r_["gate"]), r_["everyone"]) for r_ in got.collect()} == want
    assert en.traverse_gates(fs.limit(0), ds).collect() == []
    assert en.traverse_gates(fs, ds.limit(0)).where(F.col("gate").isNotNull() | ~F.col("everyone")).count() == 0
