"""Policies alike in their patterns are settled once, with the same verdicts."""

import json

from tidemark.operators import entitlement as en


def _policies(spark, resources, n):
    """n policies of the same patterns: two groups each, of which some are excepted, and some deny all others."""
    grant = lambda *groups: [{"groups": list(groups), "accesses": [{"type": "select"}]}]
    made = [{"id": i, "resources": resources, "policyItems": grant(f"G{i % 7}", "all", "most"), "allowExceptions": grant("g3") if i == 3 else [], "isDenyAllElse": i % 50 == 0} for i in range(n)]
    made[50]["policyItems"] = grant("all", "G1")
    return en.parse_policies(spark.createDataFrame([(json.dumps(p),) for p in made], "value string"))


def test_tables_meet_alike_policies_once(spark):
    policies = _policies(spark, {"database": {"values": ["d*"]}, "table": {"values": ["*"]}}, 200)
    tables = spark.createDataFrame([("d1", "a"), ("d2", "b"), ("x", "c")], "database string, table string")
    assert en._tables_met(tables, policies).count() == 3 + 2
    got = {r["database"]: (r["verdict"], r["groups"]) for r in en.route_tables(tables, policies).collect()}
    # 0, 50, 100 and 150 leave their own: g0, g1, g2 and g3, of which "all" is in each
    assert got == {"d1": ("index", ["all"]), "d2": ("index", ["all"]), "x": ("live query", [])}


def test_columns_of_alike_policies(spark):
    column = lambda *names: {"database": {"values": ["d"]}, "table": {"values": ["t"]}, "column": {"values": list(names)}}
    items = [{"groups": ["g"], "accesses": [{"type": "select"}]}]
    made = [{"id": 1, "resources": column("a", "B", "c"), "policyItems": items}, {"id": 2, "resources": column("b", "C"), "policyItems": items}, {"id": 3, "resources": column("*"), "policyItems": items}]
    policies = en.parse_policies(spark.createDataFrame([(json.dumps(p),) for p in made], "value string"))
    tables = spark.createDataFrame([("d", "t"), ("d", "u")], "database string, table string")
    assert {r["table"]: r["columns"] for r in en.describable_columns(tables, policies).collect()} == {"t": ["b", "c"], "u": None}


def test_paths_meet_alike_policies_once(spark):
    policies = _policies(spark, {"path": {"values": ["/data/*"], "isRecursive": True}}, 200)
    paths = spark.createDataFrame([("/data/a/b",), ("/data/c",), ("/x",)], "path string")
    assert en._paths_met(paths, policies).count() == 3 + 2
    got = {r["path"]: (r["verdict"], r["groups"]) for r in en.route_paths(paths, policies).collect()}
    assert got == {"/data/a/b": ("index", ["all"]), "/data/c": ("index", ["all"]), "/x": ("index", [])}
