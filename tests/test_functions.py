"""Text, time and hash functions against small independent versions."""

import hashlib
import struct

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import hashing, text, times
from tidemark.operators import timing


def one(spark, column, **values):
    d = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'string' if isinstance(v, str) or v is None else 'long'}" for k, v in values.items())) if values else spark.range(1)
    return d.select(column.alias("x")).first()["x"]


def framed(*parts):
    return b"".join(struct.pack("<i", len(p.encode())) + p.encode() for p in parts)


def test_content_hash_is_framed_sha256(spark):
    d = spark.createDataFrame([("a", "t", "é漢", 5, True, 1.5, ["x", "y"], "body"), ("b", "t", None, 5, False, 2.0, None, None)], "item_id string, item_type string, s string, n long, f boolean, d double, l array<string>, content string")
    got = {r["item_id"]: r["h"] for r in d.select("item_id", hashing.content_hash(d, ["s", "n", "f", "d", "l"]).alias("h")).collect()}
    a = framed("a", "t", "d", "1.5", "f", "true", "l", "x\x1fy", "n", "5", "s", "é漢", "body")
    b = framed("b", "t", "d", "2.0", "f", "false", "n", "5", "")
    assert got == {"a": hashlib.sha256(a).hexdigest(), "b": hashlib.sha256(b).hexdigest()}
    assert d.select(hashing.content_hash(d, ["l", "d", "f", "n", "s"]).alias("h")).first()["h"] == got["a"]


def test_field_borders_count(spark):
    d = spark.createDataFrame([("a", "t", "ab", "c", ""), ("a", "t", "a", "bc", "")], "item_id string, item_type string, p string, q string, content string")
    assert d.select(hashing.content_hash(d, ["p", "q"]).alias("h")).distinct().count() == 2


def test_unknown_types_are_refused(spark):
    d = spark.createDataFrame([], "item_id string, item_type string, x decimal(5,2), content string")
    with pytest.raises(TypeError):
        hashing.content_hash(d, ["x"])


def test_acl_hash(spark):
    schema = "acl array<struct<type:string,value:string,access:string>>"
    d = spark.createDataFrame([([("g", "b", "grant"), ("g", "a", "grant")],), ([("g", "a", "grant"), ("g", "b", "grant")],), ([],), (None,)], schema)
    h = [r["h"] for r in d.select(hashing.acl_hash(F.col("acl")).alias("h")).collect()]
    assert h[0] == h[1] == hashlib.sha256(framed("g|a|grant", "g|b|grant")).hexdigest()
    assert h[2] == h[3] == hashlib.sha256(framed("(no grants)")).hexdigest()


def test_truncation_keeps_code_points(spark):
    samples = ["é" * 100, "a" + "漢" * 80, "😀" * 60, "x" * 100, "ab" * 30 + "é", "", None]
    for cap in (64, 65, 66, 67, 90):
        d = spark.createDataFrame([(s,) for s in samples], "s string").select("s", text.truncate_utf8(F.col("s"), cap).alias("t"))
        for r in d.collect():
            s, t = r["s"] or "", r["t"]
            n = len(s.encode())
            assert t["original_bytes"] == n and t["final_bytes"] == len(t["content"].encode()) and t["truncated"] == (n > cap)
            if n > cap:
                mark = text.TRUNCATION_MARK.format(cap=cap, size=n)
                kept = t["content"].removesuffix(mark)
                assert s.startswith(kept) and t["final_bytes"] <= cap and cap - t["final_bytes"] < 4
            else:
                assert t["content"] == s


def test_markup(spark):
    html = '<p>A &amp; B</p><SCRIPT x="1">var t="</p>";\n</script> <style>p{}</style>c\n d&nbsp;e'
    assert one(spark, text.strip_markup(F.col("h")), h=html) == "A & B c d\xa0e"
    assert one(spark, text.strip_markup(F.col("h"), entities=False), h="<b>x</b> y") == "x y"


@pytest.mark.parametrize(
    ("given_", "want"),
    [
        ("a Bearer abc.def-1 b", "a Bearer [token [redacted]] b"), ("password = hunter2; x", "password=[redacted]; x"), ("Server=a;Database=b;", "[connection string [redacted]] "),
        ("-----BEGIN RSA PRIVATE KEY-----\nabc\n-----END RSA PRIVATE KEY-----", "[private key [redacted]]"), ("eyJabcdef.ghijkl.mn", "[token [redacted]]"), ("plain", "plain"),
    ],
)
def test_scrub(spark, given_, want):
    assert one(spark, text.scrub(F.col("s")), s=given_) == want
    assert one(spark, text.needs_scrubbing(F.col("s")), s=given_) == (given_ != want)


def test_names_and_maps(spark):
    assert tuple(one(spark, text.qualified_name(F.col("s")), s="db.t.u@c@d")) == ("db", "t.u@c", "d")
    assert tuple(one(spark, text.qualified_name(F.col("s")), s="db")) == ("db", "", "")
    assert tuple(one(spark, text.table_name(F.col("s")), s="a.b")) == ("a", "b")
    assert tuple(one(spark, text.table_name(F.col("s")), s="a.b.c")) == ("default", "a.b.c")
    assert one(spark, text.key_values(F.col("s")), s=" a = 1 ; b; =2; a=3;c=") == {"a": "3", "c": ""}
    assert one(spark, text.tags(F.col("s")), s=" x, ,y ") == ["x", "y"] and one(spark, text.tags(F.col("s")), s=" ,") is None
    assert one(spark, text.from_template("http://x/{0}/y", F.col("n")), n=5) == "http://x/5/y"
    with pytest.raises(ValueError):
        text.from_template("http://x", F.col("n"))
    assert [one(spark, f(F.col("n")), n=n) for f, n in ((text.compact_count, 1500), (text.compact_bytes, 2048), (text.duration, 3700), (text.age, 3000))] == ["1.5k", "2.0 KB", "1h 1m", "2d"]


def test_minute_boundaries(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    assert one(spark, times.boundaries("minute", t("2020-01-01 00:00:59"), t("2020-01-01 00:01:00"))) == 1
    assert one(spark, times.boundaries("minute", t("2020-01-01 00:00:00"), t("2020-01-01 00:00:59"))) == 0
    assert one(spark, times.boundaries("day", t("2020-01-01 23:59:59"), t("2020-01-02 00:00:00"))) == 1
    assert one(spark, F.date_format(times.to_millis(t("2020-01-01 00:00:00.123999")), "SSSSSS")) == "123000"


def sketch(values, fraction):
    """The percentile from buckets, one value at a time."""
    buckets = [0] * 192
    for v in map(lambda v: max(v, 0), values):
        k = 0 if v <= 1 else (v.bit_length() - 1) * 4 + (v - (1 << v.bit_length() - 1)) * 4 // (1 << v.bit_length() - 1)
        buckets[min(k, 191)] += 1
    target, below = max(1, -(-int(fraction * 100) * len(values) // 100)), 0
    for k, n in enumerate(buckets):
        if n and below + n >= target:
            low = 1 << k // 4
            lo, hi = (0, 2) if k == 0 else (low, low + 1) if low < 4 else (low + k % 4 * (low // 4), low + (k % 4 + 1) * (low // 4))
            return min(lo + int((hi - lo) * ((target - below) / n)), max(values))
        below += n
    return max(values)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(-5, 1 << 45), min_size=1, max_size=60))
def test_percentiles_of_buckets(spark, values):
    d = spark.createDataFrame([("k", v) for v in values], "k string, value long")
    r = timing.percentiles(d, ["k"]).first()
    assert (r["sample_count"], r["max"]) == (len(values), max(0, *values) if len(values) > 1 else max(0, values[0]))
    v = [max(0, x) for x in values]
    assert [r["p50"], r["p95"], r["p99"]] == [sketch(v, f) for f in (0.5, 0.95, 0.99)]


def test_percentiles_of_two_humps(spark):
    d = spark.createDataFrame([("k", 1000)] * 985 + [("k", 4_000_000)] * 15, "k string, value long")
    r = timing.percentiles(d, ["k"]).first()
    assert 512 <= r["p50"] <= 1024 and 2_097_152 <= r["p99"] <= 4_194_304 and r["max"] == 4_000_000
