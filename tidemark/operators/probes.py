"""Probes of the cascade of change times: touch one row of each level and look whether it and its child moved.

The tables are only read: a probe applies an update to them as a function from tables to tables, and holds
the state after it against the one before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.times import instant
from tidemark.operators.changes import cascade, stale_edges

#: customers, engagements and entries, each with effective_modified.
Tables = tuple[DataFrame, DataFrame, DataFrame]
#: Tables after an update of the rows of a level (0 to 2) whose ids are given.
Touch = Callable[[Tables, int, DataFrame], Tables]
KEYS = ("customer_id", "engagement_id", "entry_id")
NAMES = ("customer", "engagement", "entry")


def fewest_children(parents: DataFrame, children: DataFrame, key: str, child_key: str, as_of) -> DataFrame:
    """The parent in the past with the fewest children, but some, ties to the smaller key: key, before,
    children, and its first child's id and time. No row if there is none.

    Children are counted by a lateral join, which becomes one aggregation by the key.
    """
    past = parents.where(F.col("effective_modified") < instant(as_of))
    return parents.sparkSession.sql(
        f"""
        SELECT p.{key} AS id, p.effective_modified AS before, children, child.{child_key} AS child_id, child.effective_modified AS child_before
        FROM {{parents}} p, LATERAL (SELECT count(*) AS children, min(struct(c.{child_key}, c.effective_modified)) AS child FROM {{below}} c WHERE c.{key} = p.{key}) WHERE children > 0
        ORDER BY children, p.{key} LIMIT 1""",
        parents=past, below=children,
    )


def touched(tables: Tables, level: int, ids: DataFrame, now) -> Tables:
    """What an update of some rows does: their own time moves to now, and so do those of all below."""
    out = list(tables)
    changed = ids.select(F.col("id").alias(KEYS[level]))
    for k in range(level, 3):
        out[k] = cascade(tables[k], changed, KEYS[level] if k == level else KEYS[k - 1], now)
        if k < 2:
            changed = tables[k].join(changed.distinct(), KEYS[level] if k == level else KEYS[k - 1], "left_semi").select(KEYS[k])
    return out[0], out[1], out[2]


def chosen(tables: Tables, as_of) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The row of each level that is touched: id, before, children, child_id, child_before; at most one."""
    c, e, t = tables
    none = F.lit(None)
    alone = t.where(F.col("effective_modified") < instant(as_of)).orderBy("entry_id").limit(1)
    return (
        fewest_children(c, e, "customer_id", "engagement_id", as_of),
        fewest_children(e, t, "engagement_id", "entry_id", as_of),
        alone.select(F.col("entry_id").alias("id"), F.col("effective_modified").alias("before"), none.cast("long").alias("children"), none.cast("long").alias("child_id"), none.cast("timestamp").alias("child_before")),
    )


def _only(after: DataFrame, key: str, ids: DataFrame, id_: str, time: str) -> DataFrame:
    """id and time of the rows of one id: it is taken to the table, whose rows neither move nor reach the driver."""
    return after.join(F.broadcast(ids.select(F.col(id_).alias(key))), key, "left_semi").select(F.col(key).alias(id_), F.col("effective_modified").alias(time))


def cascade_probes(tables: Tables, touch: Touch, as_of, picks: tuple[DataFrame, DataFrame, DataFrame] | None = None) -> DataFrame:
    """One row per check: check, id, child_id, own_moved, child_moved, stale, verdict (ok, fail or skipped).

    Checks: a touched entry moves, a touched engagement and customer move with their first child, and after
    the customer's update no child is older than its parent, by edge. Without a row to touch a probe is
    skipped. Several probes of the same tables can share picks, what chosen() found in them.
    """
    none = F.lit(None)
    picks = picks or chosen(tables, as_of)
    out, after_customer = None, None
    for level, pick in enumerate(picks):
        after = touch(tables, level, pick.select("id"))
        if level == 0:
            after_customer = after
        d = pick.join(F.broadcast(_only(after[level], KEYS[level], pick, "id", "after")), "id", "left")
        if level < 2:
            d = d.join(F.broadcast(_only(after[level + 1], KEYS[level + 1], pick, "child_id", "child_after")), "child_id", "left")
        else:
            d = d.withColumn("child_after", none.cast("timestamp"))
        moved = lambda a, b: F.coalesce(F.col(a) > F.col(b), F.lit(False))
        child = F.when(F.col("child_id").isNotNull(), moved("child_after", "child_before"))
        d = d.select("id", "child_id", moved("after", "before").alias("own_moved"), child.alias("child_moved"))
        name = F.lit(f"update of a {NAMES[level]}" if level == 2 else f"update of a {NAMES[level]} reaches its {NAMES[level + 1]}")
        d = tables[0].sparkSession.range(1).select(name.alias("check")).join(d, F.lit(True), "left")  # one row each
        ok = F.col("own_moved") & F.coalesce("child_moved", F.lit(True))
        d = d.withColumns({"stale": none.cast("long"), "verdict": F.when(F.col("id").isNull(), "skipped").when(ok, "ok").otherwise("fail")})
        out = d if out is None else out.unionByName(d)
    old = stale_edges(*after_customer).select(F.concat(F.lit("no older child: "), "edge").alias("check"), "stale", F.when(F.col("stale") == 0, "ok").otherwise("fail").alias("verdict"))
    return out.unionByName(old, allowMissingColumns=True)
