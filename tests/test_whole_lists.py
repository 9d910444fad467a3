"""All pages of a list at once, and numbers that go on through a table's files."""

import random

from pyspark.sql import functions as F

from tidemark.operators import reporting
from tidemark.plans import queries
from tidemark.sources import tables


def test_all_pages_are_those_of_the_cursors(spark):
    r = random.Random(5)
    d = spark.createDataFrame([(r.choice([None, *range(4)]), i) for i in range(61)], "x int, id int").repartition(5)
    order, want, cursor, page = [("x", True), ("id", False)], {}, None, 0
    while True:
        got = reporting.seek_page(d, order, size=20, cursor=cursor, secret=b"s")
        if (cursor := reporting.next_cursor(got, order, secret=b"s")) is None:
            break
        page += 1
        want |= {x["id"]: page for x in got.collect()}
    assert {x["id"]: x["page"] for x in reporting.all_pages(d, order, size=20).collect()} == want and page == 4
    assert reporting.all_pages(d.limit(0), order, size=20).collect() == []


def test_seek_runs_takes_as_many_jobs_for_many_pages(spark, monkeypatch):
    calls = []
    one = reporting.seek_page
    monkeypatch.setattr(reporting, "seek_page", lambda *a, **k: calls.append(1) or one(*a, **k))
    got = queries.QUERIES["seek_runs"](spark, "/root/testdata/sf0.01")
    assert got.agg(F.max("page")).first()[0] == 3 and len(calls) == 1


def test_numbers_go_on_through_files(spark, tmp_path):
    for k, n in enumerate((3, 2, 4)):
        spark.range(10 * k, 10 * k + n, 1, 1).write.parquet(f"{tmp_path}/w{k}")
        part = next((tmp_path / f"w{k}").glob("part-*"))
        (tmp_path / "t").mkdir(exist_ok=True)
        part.rename(tmp_path / "t" / f"part-{k}.parquet")
    got = tables.numbered_through(spark, f"{tmp_path}/t").orderBy("ordinal").collect()
    assert [(x["id"], x["ordinal"]) for x in got] == list(zip([0, 1, 2, 10, 11, 20, 21, 22, 23], range(1, 10)))
    assert got[3]["file"] == "part-1.parquet"
