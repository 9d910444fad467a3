"""Expressions for secrets run only where their signs are, with the same results."""

import random

from pyspark.sql import functions as F

from tidemark.functions import text


def test_expressions_are_not_run_without_their_signs(spark, monkeypatch):
    monkeypatch.setattr(text, "SECRET_PATTERNS", tuple((".", "!") for _ in text.SECRET_PATTERNS))
    d = spark.createDataFrame([("plain words",), ("a=b",), (None,)], "s string")
    got = d.select(text.scrub(F.col("s")), text.needs_scrubbing(F.col("s"))).collect()
    assert [tuple(x) for x in got] == [("plain words", False), ("!!!", True), (None, False)]


def test_random_texts_as_by_the_expressions_alone(spark):
    r = random.Random(6)
    parts = ["password", "PWD", " = ", "=", ";", "; ", "x", "Server", "eyJabcde", ".abcdef", ".", "BEARER ", "Bearer a.b=", "-----BEGIN RSA PRIVATE KEY-----", "-----end PRIVATE key-----", "\n", "é", "İ", "K", "ab" * 30]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 12))) for _ in range(400)]

    plain, found = F.col("s"), F.lit(False)
    for pattern, instead in text.SECRET_PATTERNS:
        plain, found = F.regexp_replace(plain, pattern, instead), found | F.col("s").rlike(pattern)
    d = spark.createDataFrame([(t,) for t in texts], "s string")
    got = d.select("s", text.scrub(F.col("s")).alias("t"), plain.alias("want"), text.needs_scrubbing(F.col("s")).alias("f"), found.alias("want_f")).collect()
    assert [(x["s"], x["t"], x["f"]) for x in got] == [(x["s"], x["want"], x["want_f"]) for x in got] and any(x["f"] for x in got)
