"""Flattening of customers, engagements and time entries into items of one shape.

Ancestors' columns are copied down, counts and names are rolled up. Rollups are aggregated by the
parent's key before any join, so a parent of very many children is combined where its rows lie.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import joined
from tidemark.functions.times import iso_date

BASE_URL = "https://portal.example.com"
NEWLINE = "\r\n"

#: The columns of an item in order, with their types.
COLUMNS = {
    "item_id": "string", "item_type": "string", "title": "string", "url": "string", "last_modified": "timestamp", "hierarchy_path": "string",
    "container_name": "string", "container_url": "string", "customer_id": "long", "customer_name": "string", "customer_code": "string",
    "industry": "string", "region": "string", "account_manager": "string", "account_manager_email": "string", "engagement_id": "long",
    "engagement_name": "string", "engagement_code": "string", "practice": "string", "status": "string", "project_manager": "string",
    "consultant_name": "string", "consultant_email": "string", "work_date": "date", "hours": "decimal(5,2)", "billable": "boolean",
    "work_type": "string", "contract_value": "decimal(18,2)", "total_hours": "decimal(10,2)", "child_count": "int", "content": "string", "source_id": "long",
}


def _item(df: DataFrame, **given: Column) -> DataFrame:
    """All columns in order: given ones, else those of df, else nulls. effective_modified comes along if df has it."""
    own = set(df.columns)
    more = [c for c in ("effective_modified",) if c in own]
    return df.select(*((given[n] if n in given else F.col(n) if n in own else F.lit(None)).cast(t).alias(n) for n, t in COLUMNS.items()), *more)


def live(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_deleted"))


def entry_rollup(entries: DataFrame) -> DataFrame:
    """Of each engagement: live entries, hours, and the names of those who logged them."""
    return live(entries).groupBy("engagement_id").agg(
        F.count("*").alias("entry_count"), F.sum("hours").alias("entry_hours"),
        F.array_join(F.array_sort(F.collect_set("consultant_name")), ", ").alias("consultants"),
    )


def engagement_rollup(engagements: DataFrame, entries: DataFrame) -> DataFrame:
    """Of each customer: live engagements, their value and hours, and their names in order of code."""
    hours = live(entries).groupBy("engagement_id").agg(F.sum("hours").alias("h"))
    d = live(engagements).join(hours, "engagement_id", "left")
    name = F.concat("engagement_name", F.lit(" ("), "engagement_code", F.lit(", "), "status", F.lit(")"))
    listed = F.array_sort(F.collect_list(F.struct(F.col("engagement_code").alias("k"), name.alias("v"))))
    return d.groupBy("customer_id").agg(
        F.count("*").alias("engagement_count"), F.sum("contract_value").alias("value"), F.sum("h").alias("customer_hours"),
        F.array_join(F.transform(listed, lambda x: x["v"]), "; ").alias("engagement_list"),
    )


def customer_items(customers: DataFrame, engagements: DataFrame, entries: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    d = live(customers).join(engagement_rollup(engagements, entries), "customer_id", "left")
    count, hours, value = F.coalesce("engagement_count", F.lit(0)), F.coalesce("customer_hours", F.lit(0)).cast("decimal(10,2)"), F.coalesce("value", F.lit(0)).cast("decimal(18,2)")
    c = F.col
    content = joined(
        "Customer: ", c("customer_name"), " (", c("customer_code"), ")", NEWLINE, "Industry: ", c("industry"), " | Region: ", c("region"), " | Account manager: ",
        c("account_manager"), " <", c("account_manager_email"), ">", NEWLINE, "Engagements: ", count, " | Total logged: ", hours, " hours | Contract value: ", value, NEWLINE,
        F.when(c("engagement_list").isNotNull(), joined("Engagement list: ", c("engagement_list"), NEWLINE)), NEWLINE, c("notes"),
    )
    return _item(
        d, item_id=joined("cust", c("customer_id")), item_type=F.lit("Customer"), title=c("customer_name"), url=joined(f"{base_url}/customers/", c("customer_id")),
        hierarchy_path=c("customer_name"), container_name=F.lit("Customers"), container_url=F.lit(f"{base_url}/customers"), contract_value=value, total_hours=hours,
        child_count=count, content=content, source_id=c("customer_id"),
    )


def _ancestors(customers: DataFrame) -> DataFrame:
    return live(customers).select("customer_id", "customer_name", "customer_code", "industry", "region", "account_manager", "account_manager_email")


def engagement_items(customers: DataFrame, engagements: DataFrame, entries: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    d = live(engagements).join(_ancestors(customers), "customer_id").join(entry_rollup(entries), "engagement_id", "left")
    count, hours = F.coalesce("entry_count", F.lit(0)), F.coalesce("entry_hours", F.lit(0)).cast("decimal(10,2)")
    c = F.col
    content = joined(
        "Engagement: ", c("engagement_name"), " (", c("engagement_code"), ")", NEWLINE, "Customer: ", c("customer_name"), " (", c("customer_code"), ") | ", c("industry"),
        " | ", c("region"), " | Account manager: ", c("account_manager"), NEWLINE, "Practice: ", c("practice"), " | Status: ", c("status"), " | Project manager: ",
        c("project_manager"), NEWLINE, "Started ", iso_date(c("start_date")),
        F.when(c("end_date").isNull(), F.lit(" | ongoing")).otherwise(joined(" | ended ", iso_date(c("end_date")))), " | Contract value: ", c("contract_value"), NEWLINE,
        "Logged to date: ", hours, " hours across ", count, " time entries", NEWLINE, F.when(c("consultants").isNotNull(), joined("Consultants: ", c("consultants"), NEWLINE)),
        NEWLINE, c("scope"),
    )
    return _item(
        d, item_id=joined("eng", c("engagement_id")), item_type=F.lit("Engagement"), title=c("engagement_name"), url=joined(f"{base_url}/engagements/", c("engagement_id")),
        hierarchy_path=joined(c("customer_name"), " > ", c("engagement_name")), container_name=c("customer_name"), container_url=joined(f"{base_url}/customers/", c("customer_id")),
        total_hours=hours, child_count=count, content=content, source_id=c("engagement_id"),
    )


def entry_items(customers: DataFrame, engagements: DataFrame, entries: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    parents = live(engagements).select("engagement_id", "customer_id", "engagement_name", "engagement_code", "practice", "status", "project_manager")
    d = live(entries).join(parents, "engagement_id").join(_ancestors(customers), "customer_id")
    c, day = F.col, iso_date(F.col("work_date"))
    content = joined(
        "Time entry: ", c("consultant_name"), " — ", day, " — ", c("hours"), " hours", F.when(c("billable"), F.lit(" (billable)")).otherwise(" (non billable)"), NEWLINE,
        "Customer: ", c("customer_name"), " (", c("customer_code"), ") | ", c("industry"), " | ", c("region"), " | Account manager: ", c("account_manager"), NEWLINE,
        "Engagement: ", c("engagement_name"), " (", c("engagement_code"), ") | ", c("practice"), " | ", c("status"), " | Project manager: ", c("project_manager"), NEWLINE,
        "Work type: ", c("work_type"), NEWLINE, NEWLINE, c("narrative"),
    )
    return _item(
        d, item_id=joined("time", c("entry_id")), item_type=F.lit("TimeEntry"), title=joined(day, " — ", c("consultant_name"), " — ", c("engagement_name"), " — ", c("customer_name")),
        url=joined(f"{base_url}/time/", c("entry_id")), hierarchy_path=joined(c("customer_name"), " > ", c("engagement_name"), " > ", day, " ", c("consultant_name")),
        container_name=joined(c("engagement_name"), " — ", c("customer_name")), container_url=joined(f"{base_url}/engagements/", c("engagement_id")),
        total_hours=c("hours"), child_count=F.lit(0), content=content, source_id=c("entry_id"),
    )


def all_items(customers: DataFrame, engagements: DataFrame, entries: DataFrame, base_url: str = BASE_URL) -> DataFrame:
    """The three levels in one shape."""
    args = (customers, engagements, entries, base_url)
    return customer_items(*args).unionByName(engagement_items(*args)).unionByName(entry_items(*args))


def in_level_order(items: DataFrame) -> DataFrame:
    level = F.when(F.col("item_type") == "Customer", 1).when(F.col("item_type") == "Engagement", 2).otherwise(3)
    return items.orderBy(level, "item_id")


#: Rows of a task of dealt tables.
TASK_ROWS = 250_000


def parts(entries: DataFrame) -> int:
    """Into how many parts the hierarchy is dealt, so that a task's share doesn't grow with the input. Shuffled ids
    are small once compressed, so parts that are put together by their bytes hold very many rows."""
    return max(1, math.ceil(entries.count() / TASK_ROWS))


def dealt(customers: DataFrame, engagements: DataFrame, entries: DataFrame, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The hierarchy with engagements and entries in n parts by engagement, as the joins of flattening need them."""
    return customers, engagements.repartition(n, "engagement_id"), entries.repartition(n, "engagement_id")


def level_counts(items: DataFrame, n: int | None = None) -> DataFrame:
    """Items, distinct ids and children of each type; ids are told apart in n parts, if given."""
    if n is not None:
        items = items.select("item_type", "item_id", "child_count").repartition(n, "item_type", "item_id")
    return items.groupBy("item_type").agg(F.count("*").alias("items"), F.count_distinct("item_id").alias("ids"), F.sum("child_count").alias("children"))


def missing_ancestors(items: DataFrame) -> DataFrame:
    """Items whose content lacks the name of their own customer: must be none."""
    return items.where(~F.contains("content", "customer_name")).select("item_id", "item_type", "customer_id")


def customer_hours(customers: DataFrame, engagements: DataFrame, entries: DataFrame) -> DataFrame:
    """Engagements, entries, hours and billable hours of each live customer that has entries."""
    d = live(entries).join(live(engagements).select("engagement_id", "customer_id"), "engagement_id")
    total = d.groupBy("customer_id").agg(
        F.count_distinct("engagement_id").alias("engagements"), F.count("*").alias("entries"), F.sum("hours").alias("hours"),
        F.sum(F.when(F.col("billable"), F.col("hours")).otherwise(0)).alias("billable_hours"),
    )
    return total.join(live(customers).select("customer_id", "customer_name"), "customer_id")


def childless(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Live parents without a live child."""
    return live(parents).join(live(children).select(key).distinct(), key, "left_anti")


def replicated(customers: DataFrame, engagements: DataFrame, entries: DataFrame, folds: int, step: tuple[int, int, int] = (1_000, 1_000, 100_000)) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The hierarchy folds times, ids moved by a step each time and parents within the same fold.
    A step must exceed every id of its level."""
    fold = customers.sparkSession.range(folds).withColumnRenamed("id", "fold")
    move = lambda df, **by: df.join(F.broadcast(fold)).withColumns({c: F.col(c) + F.col("fold") * s for c, s in by.items()}).drop("fold")
    return move(customers, customer_id=step[0]), move(engagements, engagement_id=step[1], customer_id=step[0]), move(entries, entry_id=step[2], engagement_id=step[1])


def fold_faults(child: DataFrame, key: str, key_step: int, parent: str, parent_step: int) -> DataFrame:
    """Rows whose parent lies in another fold: must be none."""
    return child.where(F.floor(F.col(key) / key_step) != F.floor(F.col(parent) / parent_step))
