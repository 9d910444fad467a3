"""Routing, masks, gates, labels and lineage on small cases."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import entitlement as en
from tidemark.sources import catalogue, files


def policy(i, db="sales", table="*", column=None, groups=("Staff",), kind=0, deny=(), excluded=(), recursive=False, path=None, excepted=(), only=False, enabled=True, **more):
    grant = lambda g: [{"groups": list(g), "accesses": [{"type": "select"}]}] if g else []
    res = {"path": {"values": [path], "isRecursive": recursive, "isExcludes": "path" in excluded}} if path else {"database": {"values": [db], "isExcludes": "database" in excluded}, "table": {"values": [table], "isExcludes": "table" in excluded}}
    if column:
        res["column"] = {"values": column, "isExcludes": "column" in excluded}
    return {"id": i, "name": f"p{i}", "policyType": kind, "resources": res, "policyItems": grant(groups), "denyPolicyItems": grant(deny), "allowExceptions": grant(excepted), "isDenyAllElse": only, **({} if enabled else {"isEnabled": False}), **more}


def policies(spark, *ps):
    return en.parse_policies(spark.createDataFrame([(json.dumps(p),) for p in ps], "value string"))


def route(spark, *ps, table="orders", f=en.route_tables):
    d = spark.createDataFrame([("Sales", table)], "database string, table string")
    r = f(d, policies(spark, *ps)).first()
    return r["verdict"], r["reason"], r["groups"]


@pytest.mark.parametrize(
    ("ps", "want"),
    [
        ([policy(1)], ("index", None, ["staff"])),
        ([policy(1), policy(2, kind=2)], ("live query", "row filter", [])),
        ([policy(1), policy(2, kind=1)], ("live query", "mask", [])),
        ([policy(1), policy(2, kind=1), policy(3, kind=2)], ("live query", "row filter", [])),
        ([policy(1), policy(2, deny=["x"])], ("live query", "deny", [])),
        ([policy(1, column=["a"])], ("live query", "column grant", [])),
        ([policy(1, column=["*"])], ("index", None, ["staff"])),
        ([policy(1, column=["*"], excluded=["column"])], ("live query", "column grant", [])),
        ([policy(1, groups=())], ("live query", "no group", [])),
        ([], ("live query", "no group", [])),
        ([policy(1), policy(2, kind=2, enabled=False)], ("index", None, ["staff"])),
        ([policy(1, table="ord*")], ("index", None, ["staff"])),
        ([policy(1, table="or?ers")], ("index", None, ["staff"])),
        ([policy(1, table="or?rs")], ("live query", "no group", [])),
        ([policy(1, table="ORDERS")], ("index", None, ["staff"])),
        ([policy(1, table="o.ders")], ("live query", "no group", [])),
        ([policy(1, table="customers", excluded=["table"])], ("index", None, ["staff"])),
        ([policy(1, groups=["A", "B", "b"]), policy(2, groups=["C"], excepted=["B"])], ("index", None, ["a", "c"])),
        ([policy(1, groups=["A", "B"]), policy(2, groups=["B"], only=True)], ("index", None, ["b"])),
    ],
)
def test_table_routing(spark, ps, want):
    assert route(spark, *ps) == want


def test_catalogue_and_database_routing(spark):
    assert route(spark, policy(1), policy(2, kind=2), f=en.route_catalogue) == ("index", None, ["staff"])
    assert route(spark, policy(1), policy(2, deny=["x"]), f=en.route_catalogue)[1] == "deny"
    d = spark.createDataFrame([("sales",), ("other",)], "database string")
    got = {r["database"]: r["verdict"] for r in en.route_databases(d, policies(spark, policy(1, table="t"))).collect()}
    assert got == {"sales": "index", "other": "live query"}
    t = spark.createDataFrame([("sales", "orders")], "database string, table string")
    assert en.describable_columns(t, policies(spark, policy(1, column=["A", "b"]), policy(2, column=["B", "c"]), policy(3))).first()["columns"] == ["b"]
    assert en.describable_columns(t, policies(spark, policy(1))).first()["columns"] is None


def test_path_routing(spark):
    d = spark.createDataFrame([(p,) for p in ("/a", "/a/b", "/a/b/c", "/z")], "path string")
    ps = policies(spark, policy(1, path="/a", recursive=True), policy(2, path="/a/b", deny=["x"], groups=()))
    got = {r["path"]: (r["verdict"], r["groups"]) for r in en.route_paths(d, ps).collect()}
    assert got == {"/a": ("index", ["staff"]), "/a/b": ("live query", []), "/a/b/c": ("live query", []), "/z": ("index", [])}
    flat = {r["path"]: r["groups"] for r in en.route_paths(d, policies(spark, policy(1, path="/a/*"))).collect()}
    assert flat == {"/a": [], "/a/b": ["staff"], "/a/b/c": [], "/z": []}


def test_unreadable_policies(spark):
    got = {r["id"]: r["effect"] for r in en.unreadable_policies(policies(spark, policy(1), policy(2, zoneName="z"), policy(3, conditions=["c"]), policy(4, denyExceptions=[{"groups": ["g"]}]))).collect()}
    assert got == {2: "refuse", 3: "refuse", 4: "warn"}


@pytest.mark.parametrize(
    ("mode", "acl", "readers", "traversers"),
    [
        ("750", None, ["own"], ["own"]), ("740", None, ["own"], []), ("700", None, [], []), ("x50", None, [], []),
        ("770", ["group::r--", "group:a:r-x"], ["own", "a"], ["a"]), ("730", ["group::rwx", "group:a:rwx"], [], ["own", "a"]),
        ("750", ["default:group:a:rwx"], ["own"], ["own"]), ("770", ["group::---", "user:u:rwx", "mask::rwx"], [], []),
    ],
)
def test_masks(spark, mode, acl, readers, traversers):
    d = spark.createDataFrame([(mode, acl, "own")], "m string, a array<string>, g string")
    r = d.select(en.read_groups(F.col("m"), F.col("a"), F.col("g")).alias("r"), en.traverse_groups(F.col("m"), F.col("a"), F.col("g")).alias("t")).first()
    assert (r["r"], r["t"]) == (readers, traversers)


def test_gates_and_grants(spark):
    fs = spark.createDataFrame([("/a/b/f", "644", None, "Own"), ("/a/f", "640", None, "Own"), ("/c/f", "640", None, "Own")], "path string, permission string, acl array<string>, group string")
    ds = spark.createDataFrame([("/", "755", None, "root"), ("/a", "750", ["group::--x", "group:own:--x", "group:b:--x"], "Staff"), ("/a/b", "710", None, "b"), ("/c", "700", None, "x")], "path string, permission string, acl array<string>, group string")
    got = {r["path"]: r for r in en.traverse_gates(fs, ds).collect()}
    assert set(got["/a/f"]["gate"]) == {"staff", "own", "b"} and got["/a/b/f"]["gate"] == ["b"] and got["/c/f"]["gate"] == []
    assert not got["/a/f"]["everyone"]
    g = en.traverse_gates(fs, ds).withColumn("policy_groups", F.when(F.col("path") == "/c/f", F.array(F.lit("Own"))))
    who = spark.createDataFrame([("own", "id-own"), ("b", None)], "group string, object_id string")
    acls = {r["path"]: r["acl"] for r in en.file_grants(g, who, "id-all").collect()}
    assert acls == {"/a/b/f": [], "/a/f": ["id-own"], "/c/f": ["id-own"]}
    r = spark.range(1).select(en.resolved_acl(F.lit(None).cast("array<string>"), F.array(F.lit(" A "), F.lit("a"))).alias("x"), en.resolved_acl(F.array().cast("array<string>"), F.array(F.lit("a"))).alias("y")).first()
    assert (r["x"]["acl"], r["x"]["refused"], r["y"]["refused"]) == (["a"], False, True)


LABELS = [{"name": "Public", "tags": ["pub"]}, {"name": "Secret", "tags": ["sec", "pii"], "indexable": False}]


@pytest.mark.parametrize(
    ("tags", "options", "want"),
    [
        (["Pub"], {}, ("Public", False)), (["pub", " PII "], {}, ("Secret", True)), (["pub", "odd"], {}, ("Public", False)), (["pub", "odd"], {"unmapped": "refuse"}, (None, True)),
        ([], {"unlabelled": "refuse"}, (None, True)), ([" "], {}, (None, False)), (["sec"], {"mode": "annotate"}, ("Secret", False)), (["sec"], {"mode": "off"}, (None, False)), (["odd"], {}, (None, False)),
    ],
)
def test_sensitivity(spark, tags, options, want):
    d = spark.createDataFrame([(tags,)], "t array<string>")
    r = d.select(en.sensitivity(F.col("t"), LABELS, **options).alias("v")).first()["v"]
    assert (r["label"], r["refused"]) == want
    with pytest.raises(ValueError):
        en.sensitivity(F.col("t"), [*LABELS, {"name": "X", "tags": ["pii"]}])


def test_lineage(spark):
    ents = spark.createDataFrame([("a", False, "db.A"), ("b", False, "db.B"), ("c", False, "db.C"), ("p", True, "p"), ("q", True, "q")], "guid string, is_process boolean, qualified_name string")
    edges = spark.createDataFrame([("a", "p"), ("p", "b"), ("p", "q"), ("q", "c"), ("b", "a")], "from_id string, to_id string")
    n = en.lineage_neighbours(ents, edges, steps=3)
    got = {(r["guid"], r["direction"], r["neighbour"]) for r in n.collect()}
    assert {("a", "downstream", "b"), ("a", "downstream", "c"), ("b", "upstream", "a"), ("c", "upstream", "a")} <= got
    assert ("a", "downstream", "c") not in {(r["guid"], r["direction"], r["neighbour"]) for r in en.lineage_neighbours(ents, edges, steps=2).collect()}
    grants = spark.createDataFrame([("a", ["G"]), ("b", ["g", "h"]), ("c", ["h"])], "guid string, groups array<string>")
    seen = {(r["guid"], r["direction"]): r["names"] for r in en.visible_neighbours(n, grants).collect()}
    assert seen[("a", "downstream")] == ["db.B"]


def test_files_and_catalogue(spark, tmp_path):
    import zipfile

    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.txt").write_text("hello")
    (tmp_path / "d/b.html").write_text("<p>x &lt; y</p>")
    (tmp_path / "d/c.tmp").write_text("no")
    (tmp_path / "d/e.bin").write_bytes(b"\x00")
    with zipfile.ZipFile(tmp_path / "d/w.docx", "w") as z:
        z.writestr("word/document.xml", '<w:d xmlns:w="u"><w:p><w:t>one</w:t><w:t> two</w:t></w:p><w:p><w:t>three</w:t></w:p></w:d>')
    (tmp_path / "d/bad.docx").write_bytes(b"nothing")
    d = files.extracted(files.read_files(spark, str(tmp_path / "d")))
    got = {r["path"].rsplit("/", 1)[-1]: (r["status"], r["text"]) for r in d.collect()}
    assert got["a.txt"] == ("extracted", "hello") and got["b.html"] == ("extracted", "x < y") and got["w.docx"] == ("extracted", "one two\nthree")
    assert got["bad.docx"][0] == "failed" and got["e.bin"][0] == "unsupported"
    names = {r["path"].rsplit("/", 1)[-1] for r in d.where(files.indexable(F.col("path"))).collect()}
    assert names == {"a.txt", "b.html", "w.docx", "bad.docx"}
    raw = [{"guid": "g-1", "typeName": "table", "attributes": {"name": "t", "qualifiedName": "db.t@c", "owner": "o", "columns": ["x", "y"]}, "classificationNames": ["pii"]}, {"guid": "g-2", "typeName": "table", "status": "DELETED"}]
    e = catalogue.parse_entities(spark.createDataFrame([(json.dumps(r),) for r in [*raw, raw[0]]], "value string"))
    (r,) = catalogue.described(e).collect()
    assert r["item_id"] == "ag1" and r["content"] == "table db.t\nOwner: o\nColumns: x, y\nTags: pii"
