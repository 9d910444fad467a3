"""Reports over the state tables: run history, connection health, throttling, daily activity, paging.

All take as_of instead of reading a clock. Rankings are window functions over one connection's runs.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import json

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.times import boundaries, instant
from tidemark.operators.inventory import DELETED, FULL, INCREMENTAL, LIVE, PENDING, SUCCEEDED
from tidemark.shared import written

# The words that other systems read.
MODES = {FULL: "full", INCREMENTAL: "incremental"}
STATUSES = {1: "running", 2: "succeeded", 3: "failed", 4: "abandoned", 5: "partial"}
STATES = {LIVE: "live", PENDING: "pending delete", DELETED: "deleted"}
SEVERITY = ("failing", "items refused", "late", "deletes pending", "never run", "running", "healthy")
TONES = {
    "ok": ("healthy", "succeeded", "live"), "bad": ("failing", "failed", "late"), "warn": ("items refused", "partial", "abandoned", "deletes pending", "pending delete", "never run"),
    "busy": ("running",), "idle": ("disabled", "deleted"),
}
UNSUCCESSFUL = (3, 4, 5)


def word(code: Column, words: dict[int, str]) -> Column:
    out = F.lit(None).cast("string")
    for k, v in words.items():
        out = F.when(code == k, v).otherwise(out)
    return out


def code(text: Column, words: dict[int, str]) -> Column:
    out = F.lit(None).cast("int")
    for k, v in words.items():
        out = F.when(F.lower(text) == v, k).otherwise(out)
    return out


def tone(text: Column) -> Column:
    out = F.lit("idle")
    for k, words in TONES.items():
        out = F.when(F.lower(text).isin(*words), k).otherwise(out)
    return out


def percent(part: Column, whole: Column, kind: str = "decimal(5,1)") -> Column:
    """A percentage, null if there is nothing to divide by."""
    return (F.lit(100).cast("decimal(4,1)") * part / F.nullif(whole, F.lit(0))).cast(kind)


def run_history(runs: DataFrame, connections: DataFrame, as_of) -> DataFrame:
    """Every run with its words, duration (of open runs up to as_of), unchanged share and rate."""
    d = runs.join(connections.select("connection_id", "display_name", "connector_key"), "connection_id")
    w, u = F.col("items_written"), F.col("items_unchanged")
    seconds = boundaries("second", F.col("started_utc"), F.col("completed_utc"))
    return d.select(
        "run_id", "connection_id", "display_name", "connector_key", word(F.col("mode"), MODES).alias("mode"), word(F.col("status"), STATUSES).alias("status"),
        "is_dry_run", "started_utc", "completed_utc", boundaries("second", F.col("started_utc"), F.coalesce("completed_utc", instant(as_of))).alias("duration_seconds"),
        "items_written", "items_unchanged", "items_deleted", percent(u, w + u).alias("unchanged_percent"),
        ((w + u).cast("decimal(20,1)") / F.nullif(seconds, F.lit(0))).cast("decimal(10,2)").alias("items_per_second"),
    )


def _newest(runs: DataFrame, by: str) -> DataFrame:
    w = Window.partitionBy("connection_id").orderBy(F.desc(by), F.desc("run_id"))
    return runs.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def failure_streaks(runs: DataFrame) -> DataFrame:
    """Unsuccessful real runs since the last success, of connections that have any."""
    real = runs.where(~F.col("is_dry_run"))
    last = real.where(F.col("status") == SUCCEEDED).groupBy("connection_id").agg(F.max("started_utc").alias("_last"))
    d = real.where(F.col("status").isin(*UNSUCCESSFUL)).join(last, "connection_id", "left")
    return d.where(F.col("_last").isNull() | (F.col("started_utc") > F.col("_last"))).groupBy("connection_id").agg(F.count("*").alias("consecutive_failures"))


def connection_health(connections: DataFrame, runs: DataFrame, items: DataFrame, as_of) -> DataFrame:
    """One row per connection with one word for its health; the most urgent condition gives the word."""
    real = runs.where(~F.col("is_dry_run"))
    last = _newest(real, "started_utc").select("connection_id", F.col("run_id").alias("last_run_id"), F.col("status").alias("_status"), F.col("started_utc").alias("last_run_started_utc"))
    good = _newest(real.where(F.col("status") == SUCCEEDED), "completed_utc").select(
        "connection_id", F.col("completed_utc").alias("last_success_utc"), F.col("items_written").alias("last_success_items_written"),
        F.col("items_unchanged").alias("last_success_items_unchanged"), F.col("items_deleted").alias("last_success_items_deleted"),
    )
    counts = items.groupBy("connection_id").agg(F.count_if(F.col("state") == LIVE).alias("live"), F.count_if(F.col("state") == PENDING).alias("pending"))
    d = connections.join(last, "connection_id", "left").join(good, "connection_id", "left").join(failure_streaks(runs), "connection_id", "left").join(counts, "connection_id", "left")
    since = boundaries("minute", F.col("last_success_utc"), instant(as_of))
    failures, pending = F.coalesce("consecutive_failures", F.lit(0)), F.coalesce("pending", F.lit(0))
    health = (
        F.when(~F.col("is_enabled"), "disabled").when(F.col("last_run_id").isNull(), "never run").when(F.col("_status") == 1, "running").when(failures > 0, "failing")
        .when(F.col("_status") == 5, "items refused").when(since > F.col("expected_interval_minutes") * 2, "late").when(pending > 0, "deletes pending").otherwise("healthy")
    )
    return d.select(
        "connection_id", "display_name", "connector_key", "is_enabled", "expected_interval_minutes", "last_run_id", word(F.col("_status"), STATUSES).alias("last_run_status"),
        "last_run_started_utc", "last_success_utc", since.alias("minutes_since_last_success"), failures.alias("consecutive_failures"), "last_success_items_written",
        "last_success_items_unchanged", "last_success_items_deleted", F.coalesce("live", F.lit(0)).alias("live_item_count"), pending.alias("pending_delete_count"), health.alias("health"),
    )


def by_severity(health: DataFrame) -> DataFrame:
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col("health")), F.lit(0)), F.lit(len(SEVERITY) + 1))
    return health.orderBy(rank, "display_name")


def pending_deletes(items: DataFrame, connections: DataFrame, runs: DataFrame, as_of) -> DataFrame:
    """Items that wait for their delete, how long they have, and when a run last saw them."""
    d = items.where(F.col("state") == PENDING).join(connections.select("connection_id", "display_name"), "connection_id")
    seen = runs.select(F.col("run_id").alias("last_seen_run"), F.col("started_utc").alias("last_seen_run_started_utc"))
    d = d.join(seen, "last_seen_run", "left")
    return d.select("connection_id", "display_name", "item_id", "item_type", "last_seen_run", "last_written_utc", "pending_since_utc", boundaries("minute", F.col("pending_since_utc"), instant(as_of)).alias("age_minutes"), "last_seen_run_started_utc")


def item_inventory(items: DataFrame, connections: DataFrame, as_of) -> DataFrame:
    d = items.join(connections.select("connection_id", "display_name"), "connection_id")
    return d.select(
        "connection_id", "display_name", "item_id", "item_type", word(F.col("state"), STATES).alias("state"), "content_bytes", F.upper("content_hash").alias("content_hash_hex"),
        F.upper("acl_hash").alias("acl_hash_hex"), "first_seen_run", "last_seen_run", "last_written_run", "last_written_utc", "unchanged_streak",
        boundaries("day", F.col("last_written_utc"), instant(as_of)).alias("days_since_last_write"),
    )


def throttle_summary(events: DataFrame, runs: DataFrame, connections: DataFrame) -> DataFrame:
    """One row per throttled run."""
    d = events.join(runs.select("run_id", "connection_id", "started_utc", "mode"), "run_id").join(connections.select("connection_id", "display_name"), "connection_id")
    wait = F.coalesce("retry_after_seconds", F.lit(0))
    return d.groupBy("run_id", "connection_id", "display_name", F.col("started_utc").alias("run_started_utc"), word(F.col("mode"), MODES).alias("mode")).agg(
        F.count("*").alias("throttle_events"), F.count_if(F.col("status_code") == 429).alias("refusals_429"), F.count_if(F.col("status_code").between(500, 599)).alias("server_errors"),
        F.sum(wait).alias("total_retry_after_seconds"), F.max(wait).alias("max_retry_after_seconds"),
        F.count_distinct(boundaries("minute", F.col("started_utc"), F.col("occurred_utc"))).alias("distinct_minutes"),
        F.min("occurred_utc").alias("first_event_utc"), F.max("occurred_utc").alias("last_event_utc"), F.max("attempt_number").alias("deepest_retry"),
    )


def daily_activity(runs: DataFrame, connections: DataFrame) -> DataFrame:
    """One row per connection and day of its real runs. Partial runs count as failed, running ones as
    neither; durations are averaged over successes."""
    d = runs.where(~F.col("is_dry_run")).join(connections.select("connection_id", "display_name"), "connection_id")
    seconds = boundaries("second", F.col("started_utc"), F.col("completed_utc")).cast("decimal(18,1)")
    w, u = F.sum("items_written"), F.sum("items_unchanged")
    return d.groupBy("connection_id", "display_name", F.to_date("started_utc").alias("activity_date")).agg(
        F.count("*").alias("runs"), F.count_if(F.col("status") == SUCCEEDED).alias("succeeded"), F.count_if(F.col("status").isin(*UNSUCCESSFUL)).alias("failed"),
        w.alias("items_written"), u.alias("items_unchanged"), F.sum("items_deleted").alias("items_deleted"), percent(u, w + u).alias("unchanged_percent"),
        F.avg(F.when(F.col("status") == SUCCEEDED, seconds)).cast("decimal(10,1)").alias("avg_duration_seconds"),
    )


def daily_trend(activity: DataFrame, as_of, days: int) -> DataFrame:
    """Runs, written and failed of each of the last days, 0 where there was no run."""
    last = F.to_date(instant(as_of))
    calendar = activity.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(last, days - 1), last)).alias("activity_date"))
    total = activity.groupBy("activity_date").agg(*(F.sum(c).alias(c) for c in ("runs", "failed", "items_written")))
    return calendar.join(total, "activity_date", "left").na.fill(0, ["runs", "failed", "items_written"])


def recent_activity(activity: DataFrame, as_of, days: int = 30) -> DataFrame:
    return activity.where(F.col("activity_date") >= F.date_sub(F.to_date(instant(as_of)), days)).orderBy("activity_date", "display_name")


def dashboard_tiles(connections: DataFrame, runs: DataFrame, items: DataFrame, health: DataFrame, as_of, window_hours: int = 24) -> DataFrame:
    """One row of totals: each table is read once."""
    inside = (F.col("started_utc") >= instant(as_of) - F.make_dt_interval(hours=F.lit(window_hours))) & ~F.col("is_dry_run")
    total = lambda c: F.coalesce(F.sum(F.when(inside, F.col(c))), F.lit(0))
    w, u = total("items_written"), total("items_unchanged")
    a = connections.agg(F.count_if("is_enabled").alias("connections_enabled"))
    b = health.agg(F.count_if(F.col("health") == "healthy").alias("connections_healthy"), F.count_if(F.col("health").isin("failing", "late", "items refused")).alias("connections_needing_attention"))
    c = runs.agg(
        F.count_if(F.col("status") == 1).alias("runs_in_progress"), w.alias("items_written_in_window"), u.alias("items_unchanged_in_window"), total("items_deleted").alias("items_deleted_in_window"),
        F.count_if(inside & F.col("status").isin(*UNSUCCESSFUL)).alias("failed_runs_in_window"), F.count_if(inside).alias("runs_in_window"), percent(u, w + u).alias("unchanged_percent_in_window"),
    )
    d = items.agg(F.count_if(F.col("state") == LIVE).alias("live_items"), F.count_if(F.col("state") == PENDING).alias("pending_deletes"), F.count_if(F.col("state") == DELETED).alias("tombstones"))
    return a.crossJoin(b).crossJoin(c).crossJoin(d)


def paged(df: DataFrame, order: list[Column | str], page: int = 1, size: int | None = None, default: int = 50, most: int = 500) -> DataFrame:
    """A page of rows in order, each beside total_rows. Page and size are clamped."""
    size = default if size is None or size < 1 else min(size, most)
    page = min(max(page, 1), 1_000_000)
    total = df.agg(F.count("*").alias("total_rows"))
    return df.orderBy(*order).offset((page - 1) * size).limit(size).crossJoin(F.broadcast(total))


def _following(order: list[tuple[str, bool]], last: list[Column]) -> Column:
    """Whether a row comes after the one with the last values; nulls are first ascending and last descending."""
    out, equal = F.lit(False), F.lit(True)
    for (name, falls), v in zip(order, last):
        c = F.col(name)
        later = (c < v) | (c.isNull() & v.isNotNull()) if falls else (c > v) | (c.isNotNull() & v.isNull())
        out = out | (equal & F.coalesce(later, F.lit(False)))
        equal = equal & c.eqNullSafe(v)
    return out


def _signature(secret: bytes, scope: str, payload: bytes) -> str:
    return hmac.new(secret, scope.encode() + b"\n" + payload, hashlib.sha256).hexdigest()


def seek_page(df: DataFrame, order: list[tuple[str, bool]], *, size: int | None = None, cursor: str | None = None, secret: bytes = b"", scope: str = "", default: int = 50, most: int = 500) -> DataFrame:
    """The page of rows after a cursor, in order: columns, each with whether it falls; together they must tell
    all rows apart. Size is clamped.

    Only rows after the cursor are looked at, and only the first of them are kept by every task, so a deep page
    costs what the first one does. A cursor is refused if it wasn't signed with the secret for this
    scope (the caller's list and filters) and order.
    """
    size = default if size is None or size < 1 else min(size, most)
    if cursor is not None:
        df = after_cursor(df, order, cursor, secret=secret, scope=scope)
    return df.orderBy(*(F.col(c).desc() if falls else F.col(c).asc() for c, falls in order)).limit(size)


def after_cursor(df: DataFrame, order: list[tuple[str, bool]], cursor: str, *, secret: bytes = b"", scope: str = "") -> DataFrame:
    """All rows after a cursor, as seek_page takes it."""
    body, _, signed = cursor.partition(".")
    payload = base64.urlsafe_b64decode(body.encode())
    if not hmac.compare_digest(signed, _signature(secret, f"{scope}{order}", payload)):
        raise ValueError("the cursor is not of this list")
    last = [F.lit(v).cast(df.schema[name].dataType) for (name, _), v in zip(order, json.loads(payload))]
    return df.where(_following(order, last))


def all_pages(df: DataFrame, order: list[tuple[str, bool]], *, size: int | None = None, default: int = 50, most: int = 500) -> DataFrame:
    """All rows with page, the number from 1 of the page on which reading on by seek_page meets them.

    One sort for all pages, dealt by ranges and written; a row's place is the number of rows in the ranges before
    its own, which are as few as there are tasks, and its place there.
    """
    size = default if size is None or size < 1 else min(size, most)
    d = df.orderBy(*(F.col(c).desc() if falls else F.col(c).asc() for c, falls in order))
    d = written(d.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "pages")
    ranges = d.groupBy("_range").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    before = F.coalesce(F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select("_range", (before - F.col("_first")).alias("_shift"))
    place = F.col("_at") + F.col("_shift")
    return d.join(F.broadcast(ranges), "_range").select(*df.columns, (F.floor(place / size) + 1).cast("int").alias("page"))


def next_cursor(page: DataFrame, order: list[tuple[str, bool]], *, secret: bytes = b"", scope: str = "") -> str | None:
    """The cursor after a page's last row, signed on the driver; None after an empty page. Of the page only the
    columns of the order are collected."""
    rows = page.select(*(F.col(c).cast("string") for c, _ in order)).collect()
    if not rows:
        return None
    payload = json.dumps(list(rows[-1])).encode()
    return f"{base64.urlsafe_b64encode(payload).decode()}.{_signature(secret, f'{scope}{order}', payload)}"


def _optional(df: DataFrame, **equal) -> DataFrame:
    for k, v in equal.items():
        if v is not None:
            df = df.where(F.col(k) == v)
    return df


def list_runs(history: DataFrame, *, connection_id=None, status=None, mode=None, start=None, end=None, include_dry_runs: bool = False, page: int = 1, size: int | None = None) -> DataFrame:
    """Newest first; start is included, end isn't."""
    d = _optional(history, connection_id=connection_id, status=status, mode=mode)
    if start is not None:
        d = d.where(F.col("started_utc") >= instant(start))
    if end is not None:
        d = d.where(F.col("started_utc") < instant(end))
    if not include_dry_runs:
        d = d.where(~F.col("is_dry_run"))
    return paged(d, [F.desc("started_utc"), F.desc("run_id")], page, size)


def list_items(inventory: DataFrame, *, connection_id=None, search=None, item_type=None, state=None, min_streak=None, page: int = 1, size: int | None = None) -> DataFrame:
    """In order of id; search is a prefix in which the caller's own wildcards stay active."""
    d = _optional(inventory, connection_id=connection_id, item_type=item_type, state=state)
    if search:
        d = d.where(F.col("item_id").like(search + "%"))
    if min_streak is not None:
        d = d.where(F.col("unchanged_streak") >= min_streak)
    return paged(d, ["connection_id", "item_id"], page, size)


def list_pending_deletes(pending: DataFrame, *, connection_id=None, min_age=None, page: int = 1, size: int | None = None) -> DataFrame:
    d = _optional(pending, connection_id=connection_id)
    if min_age is not None:
        d = d.where(F.col("age_minutes") >= min_age)
    return paged(d, [F.desc("age_minutes"), "connection_id", "item_id"], page, size)


def list_throttle_events(events: DataFrame, run_id: int, page: int = 1, size: int | None = None) -> DataFrame:
    return paged(events.where(F.col("run_id") == run_id), ["occurred_utc", "throttle_event_id"], page, size, 100, 1000)


def newest_runs(history: DataFrame, n: int = 10) -> DataFrame:
    return history.orderBy(F.desc("started_utc"), F.desc("run_id")).limit(n)


def item_mix(items: DataFrame) -> DataFrame:
    """Of each connection and type: items by state, bytes and streaks."""
    s = F.col("state")
    return items.groupBy("connection_id", "item_type").agg(
        F.count("*").alias("items"), F.count_if(s == LIVE).alias("live"), F.count_if(s == PENDING).alias("pending_delete"), F.count_if(s == DELETED).alias("tombstoned"),
        F.sum(F.col("content_bytes").cast("long")).alias("content_bytes"), F.avg(F.col("unchanged_streak").cast("decimal(10,1)")).cast("decimal(14,5)").alias("avg_unchanged_streak"), F.max("unchanged_streak").alias("max_unchanged_streak"),
    )


def run_detail(run_id: int, history: DataFrame, types: DataFrame, phases: DataFrame, throttles: DataFrame) -> dict[str, DataFrame]:
    """A run's four sets: its history row, its items by type (busiest first), its phases (longest first) and
    what throttled it. types, phases and throttles are type_totals, timing.phase_shares and throttle_summary."""
    own = lambda df: df.where(F.col("run_id") == run_id)
    busy = F.col("items_written") + F.col("items_unchanged")
    return {
        "run": own(history),
        "types": own(types).withColumn("unchanged_percent", percent(F.col("items_unchanged"), busy)).orderBy(busy.desc(), "item_type"),
        "phases": own(phases).orderBy(F.desc("total_ms")),
        "throttles": own(throttles),
    }


def connection_detail(connection_id: str, health: DataFrame, items: DataFrame, activity: DataFrame, checkpoints: DataFrame, as_of, days: int = 30) -> dict[str, DataFrame]:
    """A connection's four sets: its health, the mix of what it holds (most first), its recent days, its marker."""
    own = lambda df: df.where(F.col("connection_id") == connection_id)
    return {
        "health": own(health),
        "mix": item_mix(own(items)).orderBy(F.desc("items")),
        "activity": recent_activity(own(activity), as_of, days),
        "checkpoint": own(checkpoints),
    }


def measures(sets: dict[str, DataFrame], names: dict[str, list[str]]) -> DataFrame:
    """The numbers of several sets in one table: part, name, measure, value. names: the columns of each set
    that together name its row."""
    out = None
    for part, df in sets.items():
        numbers = [f.name for f in df.schema if f.dataType.typeName() in ("integer", "long", "decimal", "double") and f.name not in names[part]]
        pairs = F.explode(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).cast("decimal(20,1)").alias("value")) for n in numbers))).alias("m")
        d = df.select(F.lit(part).alias("part"), F.concat_ws(" ", *names[part]).alias("name"), pairs).select("part", "name", "m.*")
        out = d if out is None else out.unionByName(d)
    return out


def health_counts(health: DataFrame) -> DataFrame:
    """Connections by word and severity rank."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col("health")), F.lit(0)), F.lit(len(SEVERITY) + 1))
    return health.groupBy("health").agg(F.count("*").alias("connections"), F.min(rank).alias("rank"))


def health_report(health: DataFrame, as_of) -> DataFrame:
    """One row of JSON: the worst word decides; no connection at all isn't healthy."""
    each = F.sort_array(F.collect_list(F.struct("connection_id", "health", "minutes_since_last_success", "consecutive_failures")))
    rank = F.min(F.coalesce(F.nullif(F.array_position(F.array(*map(F.lit, SEVERITY)), F.col("health")), F.lit(0)), F.lit(len(SEVERITY) + 1)))
    d = health.agg(F.count("*").alias("n"), rank.alias("rank"), each.alias("connections"))
    status = F.when(F.col("n") == 0, "unknown").when(F.col("rank") <= 3, "failing").when(F.col("rank") <= 5, "degraded").otherwise("ok")
    return d.select(F.to_json(F.struct(status.alias("status"), F.date_format(instant(as_of), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("generatedUtc"), "connections")).alias("report"))


def alerts(health: DataFrame, *, interval_factor: int = 3, least_minutes: int = 60, fallback_minutes: int = 1440, failures_to_page: int = 3) -> DataFrame:
    """connection_id, condition, severity (page or ticket), transient: what is wrong with enabled
    connections. A transient finding counts only once consecutive polls have it."""
    d = health.where(F.col("is_enabled"))
    has = F.coalesce(F.col("expected_interval_minutes") > 0, F.lit(False))
    threshold = F.when(has, F.greatest(F.col("expected_interval_minutes") * interval_factor, F.lit(least_minutes))).otherwise(fallback_minutes)
    since, failures = F.col("minutes_since_last_success"), F.col("consecutive_failures")
    finding = lambda when, name, severity, transient=False: F.when(when, F.struct(F.lit(name).alias("condition"), severity.alias("severity"), F.lit(transient).alias("transient")))
    page, ticket = F.lit("page"), F.lit("ticket")
    found = F.array_compact(
        F.array(
            finding(~has, "NoExpectedInterval", ticket),
            finding(since.isNull(), "NeverSucceeded", F.when(F.col("live_item_count") > 0, page).otherwise(ticket)),
            finding(since > threshold, "Stale", page),
            finding(failures > 0, "Failing", F.when(failures >= failures_to_page, page).otherwise(ticket)),
            finding((F.col("health") == "items refused") | F.coalesce(F.col("last_run_status") == "partial", F.lit(False)), "ItemsRefused", ticket, True),
            finding(F.col("pending_delete_count") > 0, "DeletesPending", ticket, True),
        )
    )
    return d.select("connection_id", F.explode(found).alias("f")).select("connection_id", "f.*")


def persistent(polls: list[DataFrame]) -> DataFrame:
    """Findings that count: lasting ones of the last poll, and transient ones that all polls have."""
    last = polls[-1]
    for earlier in polls[:-1]:
        kept = last.where("transient").join(earlier.select("connection_id", "condition"), ["connection_id", "condition"], "left_semi")
        last = last.where("not transient").unionByName(kept)
    return last


def stuck_deletes(pending: DataFrame, minutes: int) -> DataFrame:
    d = pending.where(F.col("age_minutes") > minutes)
    return d.groupBy("connection_id", "item_type").agg(F.count("*").alias("items"), F.max("age_minutes").alias("max_age_minutes"))


def deletion_rate(items: DataFrame, n: int = 30) -> DataFrame:
    """Days with the largest share of the live corpus deleted."""
    live = items.agg(F.count_if(F.col("state") == LIVE).alias("live"))
    d = items.where(F.col("deleted_utc").isNotNull()).groupBy(F.to_date("deleted_utc").alias("day")).agg(F.count("*").alias("deleted"))
    d = d.crossJoin(F.broadcast(live)).withColumn("percent_of_live", percent(F.col("deleted"), F.col("live"), "decimal(9,2)"))
    return d.orderBy(F.desc("percent_of_live"), "day").limit(n)


def sweep_forensics(items: DataFrame, run_id: int) -> DataFrame:
    """Live items that a run has not seen, by connection and type."""
    d = items.where((F.col("state") == LIVE) & (F.col("last_seen_run") < run_id))
    return d.groupBy("connection_id", "item_type").agg(F.count("*").alias("missing"), F.min("item_id").alias("first_id"))


def missing_items_sample(items: DataFrame, run_id: int, n: int = 20) -> DataFrame:
    """The first n live items, in order of connection and id, that a run has not seen."""
    d = items.where((F.col("state") == LIVE) & (F.col("last_seen_run") < run_id))
    return d.select("connection_id", "item_type", "item_id", "last_seen_run").orderBy("connection_id", "item_id").limit(n)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """table_name and row_count of each table, also of empty ones."""
    return reduce(DataFrame.unionByName, (df.agg(F.lit(name).alias("table_name"), F.count("*").alias("row_count")) for name, df in tables.items()))


def principal_policy(connections: DataFrame, cache: DataFrame, as_of) -> DataFrame:
    """Cached answers and absences of every connection, also of those that have none."""
    d = connections.join(cache, "connection_id", "left")
    here = F.col("source_key").isNotNull()
    return d.groupBy("connection_id", "display_name").agg(
        F.count_if(here).alias("cached"), F.count_if(here & F.col("object_id").isNull()).alias("absences"),
        F.count_if(here & (F.col("expires_utc") <= instant(as_of))).alias("expired"), F.coalesce(F.sum("hit_count"), F.lit(0)).alias("hits"),
    )


def schedule_budget(slots: DataFrame, window_minutes: int, most_writers: int) -> DataFrame:
    """slots: connection_id, minutes, writers. Whether they fit a window one after another."""
    d = slots.agg(F.sum("minutes").alias("minutes"), F.max("writers").alias("max_writers"), F.sum("writers").alias("all_writers"))
    return d.withColumn("fits", (F.col("minutes") <= window_minutes) & (F.col("max_writers") <= most_writers))


# A fixed value: the line that ends a run's log.
RUN_LINE = r"^(\S+)\s+run (\d+) (succeeded|failed|partial): read (\d+), written (\d+), unchanged (\d+), deleted (\d+)"


def mined_runs(lines: DataFrame) -> DataFrame:
    """One record per log line that ends a run."""
    part = lambda i: F.regexp_extract("value", RUN_LINE, i)
    d = lines.where(F.col("value").rlike(RUN_LINE))
    return d.select(F.to_timestamp(part(1)).alias("ended_utc"), part(2).cast("long").alias("run_id"), part(3).alias("status"), *(part(4 + i).cast("long").alias(f"items_{n}") for i, n in enumerate(("read", "written", "unchanged", "deleted"))))
