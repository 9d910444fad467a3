"""Change timestamps over a hierarchy and resumable keyset reads.

A marker is a pair (time, key). It is a high-water mark for resuming a read, not an event-time
watermark: nothing is dropped as late.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant
from tidemark.operators.flatten import customer_items, engagement_items, entry_items


def effective_modified(customers: DataFrame, engagements: DataFrame, entries: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Adds effective_modified: a row's own last_modified or its ancestors', whichever is latest."""
    c = customers.withColumn("effective_modified", F.col("last_modified"))
    up = c.select("customer_id", F.col("effective_modified").alias("_up"))
    e = engagements.join(up, "customer_id", "left").withColumn("effective_modified", F.greatest("last_modified", "_up")).drop("_up")
    up = e.select("engagement_id", F.col("effective_modified").alias("_up"))
    t = entries.join(up, "engagement_id", "left").withColumn("effective_modified", F.greatest("last_modified", "_up")).drop("_up")
    return c, e, t


def cascade(children: DataFrame, changed_parents: DataFrame, key: str, now: str | datetime | Column) -> DataFrame:
    """effective_modified of the children of changed parents moves to now, never backwards."""
    hit = F.col("_changed").isNotNull() & (F.col("effective_modified") < instant(now))
    changed = changed_parents.select(key, F.lit(True).alias("_changed")).distinct()
    return children.join(changed, key, "left").withColumn("effective_modified", F.when(hit, instant(now)).otherwise(F.col("effective_modified"))).drop("_changed")


def after(time: str, key: str, marker_time=None, marker_key=None, slack_seconds: int = 0) -> Column:
    """Strictly after the marker pair. Without a marker, all rows. With slack the marker's time moves
    back, and the key breaks ties at the moved instant only."""
    if marker_time is None:
        return F.lit(True)
    m = instant(marker_time)
    if slack_seconds:
        m = m - F.make_dt_interval(secs=F.lit(slack_seconds))
    t = F.col(time)
    return (t > m) | ((t == m) & (F.col(key) > F.lit(marker_key)))


def incremental(df: DataFrame, time: str, key: str, *, marker_time=None, marker_key=None, ceiling=None, slack_seconds: int = 0, most: int | None = None) -> DataFrame:
    """Rows after the marker, in the order of the pair; below the ceiling if there is one.

    Rows without a time can never follow a marker and are left out. The predicate is on the columns
    themselves, so it reaches the scan.
    """
    d = df.where(F.col(time).isNotNull() & after(time, key, marker_time, marker_key, slack_seconds))
    if ceiling is not None:
        d = d.where(F.col(time) < instant(ceiling))
    d = d.orderBy(time, key)
    return d if most is None else d.limit(most)


def after_item(time: str, key: str, level: int, marker: tuple | None) -> Column:
    """Strictly after a marker (time, level, key) among the rows of one level, as a plain comparison of columns
    that a scan can take."""
    if marker is None:
        return F.lit(True)
    t, (at, marked, last) = F.col(time), marker
    if level == marked:
        return after(time, key, at, last)
    return t >= instant(at) if level > marked else t > instant(at)


def resume_items(customers: DataFrame, engagements: DataFrame, entries: DataFrame, *, marker: tuple | None = None, ceiling=None, most: int | None = None) -> DataFrame:
    """Items of all levels after a marker (time, level 1 to 3, source id), in that order, with level and marker
    columns. The tables hold effective_modified.

    Each level's changed rows are found by its own scan (the comparison is on its columns) before anything is
    joined. A row at or past the ceiling is read, but its marker is null, so a checkpoint doesn't move there.
    """
    tables = {"customers": customers, "engagements": engagements, "entries": entries}
    levels = (("customers", "customer_id", customer_items), ("engagements", "engagement_id", engagement_items), ("entries", "entry_id", entry_items))
    out = None
    for level, (name, key, items) in enumerate(levels, 1):
        changed = tables[name].where(F.col("effective_modified").isNotNull() & after_item("effective_modified", key, level, marker))
        d = items(**(tables | {name: changed})).withColumn("level", F.lit(level))
        out = d if out is None else out.unionByName(d)
    out = out.orderBy("effective_modified", "level", "source_id")
    out = out if most is None else out.limit(most)
    return out.withColumn("marker", F.col("effective_modified")) if ceiling is None else with_marker(out, "effective_modified", ceiling)


def with_marker(df: DataFrame, time: str, ceiling) -> DataFrame:
    """Adds marker: the row's time if it is below the ceiling. A row at or past it is read, but the
    checkpoint must not move there."""
    return df.withColumn("marker", F.when(F.col(time) < instant(ceiling), F.col(time)))


def order_faults(df: DataFrame, time: str, key: str, as_of) -> DataFrame:
    """One row: whether (time, key) orders all rows totally."""
    total = df.agg(F.count("*").alias("rows"), F.count_if(F.col(time).isNull()).alias("null_times"), F.count_if(F.col(time) > instant(as_of)).alias("ahead"))
    twice = df.groupBy(time, key).count().where("count > 1").agg(F.count("*").alias("repeated_pairs"))
    ties = df.groupBy(time).count().where("count > 1").agg(F.count("*").alias("tie_groups"), F.coalesce(F.max("count"), F.lit(0)).alias("largest_tie"))
    ok = (F.col("null_times") == 0) & (F.col("repeated_pairs") == 0) & (F.col("ahead") == 0)
    return total.crossJoin(twice).crossJoin(ties).withColumn("verdict", F.when(ok, "ok").otherwise("broken"))


def stale_edges(customers: DataFrame, engagements: DataFrame, entries: DataFrame) -> DataFrame:
    """Of each edge, the children whose effective_modified lies before their parent's; must be 0.

    An engagement takes its customer's time along, so entries are shuffled by engagement alone. Sides are
    merged, as none of them is small for long, and none goes through the driver.
    """
    c = customers.select("customer_id", F.col("effective_modified").alias("up")).hint("merge")
    e = engagements.select("engagement_id", "customer_id", F.col("effective_modified").alias("em"))
    ups = e.join(c, "customer_id").select("engagement_id", "up")
    t = entries.select("engagement_id", F.col("effective_modified").alias("tm"))
    first = e.join(c, "customer_id").agg(F.lit("engagement<customer").alias("edge"), F.count_if(F.col("em") < F.col("up")).alias("stale"))
    second = t.join(e.hint("merge"), "engagement_id").agg(F.lit("entry<engagement").alias("edge"), F.count_if(F.col("tm") < F.col("em")).alias("stale"))
    third = t.join(ups.hint("merge"), "engagement_id").agg(F.lit("entry<customer").alias("edge"), F.count_if(F.col("tm") < F.col("up")).alias("stale"))
    return first.unionByName(second).unionByName(third).withColumn("verdict", F.when(F.col("stale") == 0, "ok").otherwise("stale"))


def count_parity(full: DataFrame, incremental_view: DataFrame) -> DataFrame:
    """Whether two views of the same items hold equally many."""
    a, b = full.agg(F.count("*").alias("full_items")), incremental_view.agg(F.count("*").alias("incremental_items"))
    return a.crossJoin(b).withColumn("verdict", F.when(F.col("full_items") == F.col("incremental_items"), "ok").otherwise("differs"))


def preflight(df: DataFrame, time: str, key: str, as_of, marker_time=None, marker_key=None) -> DataFrame:
    """Range of times, rows in the future, and rows still to read after a marker."""
    t = F.col(time)
    return df.agg(F.min(t).alias("first"), F.max(t).alias("last"), F.count_if(t > instant(as_of)).alias("in_future"), F.count_if(after(time, key, marker_time, marker_key)).alias("pending"))
