"""The inventory of items and the state kept beside it, as functions from tables to tables.

Each function returns the new rows of a table; the caller writes them where tables live (a new
snapshot, a partition, a MERGE). Joins are on (connection_id, item_id), so an inventory bucketed by
those is not shuffled again.
"""

from __future__ import annotations

import math
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.hashing import HASH_VERSION
from tidemark.functions.times import instant
from tidemark.shared import written

LIVE, PENDING, DELETED = 1, 2, 3
RUNNING, SUCCEEDED, FAILED, ABANDONED, PARTIAL = 1, 2, 3, 4, 5
FULL, INCREMENTAL = 1, 2
KEY = ["connection_id", "item_id"]


class Refused(RuntimeError):
    """A state transition that must not happen; code says which."""

    def __init__(self, code: int, why: str) -> None:
        super().__init__(f"{code}: {why}")
        self.code = code


def upsert(current: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """new rows in place of current ones of the same keys."""
    return current.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def last_of_duplicates(items: DataFrame, ordinal: str = "ordinal", key: str = "item_id") -> DataFrame:
    """Of items alike in id, whatever the case, the last; duplicates counts the others."""
    w = Window.partitionBy(F.lower(key))
    d = items.withColumn("_n", F.row_number().over(w.orderBy(F.desc(ordinal)))).withColumn("duplicates", F.count("*").over(w) - 1)
    return d.where("_n = 1").drop("_n")


def compare_and_see(inventory: DataFrame, candidates: DataFrame) -> DataFrame:
    """candidates (connection_id, item_id, content_hash, acl_hash) with action: unchanged for a live
    item whose hashes are both the same, else write."""
    known = inventory.where(F.col("state") == LIVE).select(*KEY, F.col("content_hash").alias("_c"), F.col("acl_hash").alias("_a"))
    same = F.coalesce((F.col("_c") == F.col("content_hash")) & (F.col("_a") == F.col("acl_hash")), F.lit(False))
    return candidates.join(known, KEY, "left").withColumn("action", F.when(same, "unchanged").otherwise("write")).drop("_c", "_a")


def record_written(inventory: DataFrame, written: DataFrame, run_id: int, as_of) -> DataFrame:
    """The inventory after items were written: live, streak 0, no longer pending or deleted."""
    now = instant(as_of)
    first = inventory.select(*KEY, F.col("first_seen_run").alias("_first"))
    new = written.join(first, KEY, "left").select(
        *KEY, "item_type", "content_hash", "acl_hash", "content_bytes", F.coalesce("_first", F.lit(run_id)).cast("long").alias("first_seen_run"),
        F.lit(run_id).cast("long").alias("last_seen_run"), F.lit(run_id).cast("long").alias("last_written_run"), now.alias("last_written_utc"), F.lit(LIVE).alias("state"),
        F.lit(None).cast("timestamp").alias("pending_since_utc"), F.lit(None).cast("timestamp").alias("deleted_utc"), F.lit(0).alias("unchanged_streak"),
    )
    return upsert(inventory, new, KEY).select(*new.columns)


def record_unchanged(inventory: DataFrame, seen: DataFrame, run_id: int) -> DataFrame:
    """The inventory after live items were seen unchanged: last seen in this run, streak one more."""
    hit = F.col("_seen").isNotNull() & (F.col("state") == LIVE)
    d = inventory.join(seen.select(*KEY, F.lit(True).alias("_seen")).distinct(), KEY, "left")
    return d.withColumn("last_seen_run", F.when(hit, F.lit(run_id)).otherwise(F.col("last_seen_run"))).withColumn("unchanged_streak", F.col("unchanged_streak") + F.when(hit, 1).otherwise(0)).drop("_seen")


def guard_percent(most: float) -> Decimal:
    """A delete guard between 0 and 100 with two digits, halves away from zero; not a number is 0."""
    if math.isnan(most) or most <= 0:
        return Decimal("0.00")
    return Decimal("100.00") if most >= 100 else Decimal(str(most)).quantize(Decimal("0.01"), ROUND_HALF_UP)


def sweep_counts(inventory: DataFrame, run_id: int) -> DataFrame:
    """live, missing (live but not seen in the run) and the percentage, of each connection."""
    live = F.col("state") == LIVE
    d = inventory.groupBy("connection_id").agg(F.count_if(live).alias("live"), F.count_if(live & (F.col("last_seen_run") < run_id)).alias("missing"))
    return d.withColumn("missing_percent", (F.col("missing") * 100 / F.nullif("live", F.lit(0))).cast("decimal(9,2)"))


def sweep(inventory: DataFrame, run: DataFrame, connection_id: str, run_id: int, as_of, most_percent: float = 10.0, override: bool = False) -> tuple[DataFrame, DataFrame]:
    """The inventory after the guarded delete sweep of a full run, and all pending items in order of id.

    Refused for an unknown run (50004), another connection's (50005), a run that isn't full (50006),
    and if more than most_percent of the live items would go (50007). A dry run changes nothing.
    Reads one row of run and one of counts on the driver.
    """
    own = run.where(F.col("run_id") == run_id).select("connection_id", "mode", "is_dry_run").first()
    if own is None:
        raise Refused(50004, "unknown run")
    if own["connection_id"] != connection_id:
        raise Refused(50005, "the run is another connection's")
    if own["mode"] != FULL:
        raise Refused(50006, "only a full run has seen all items")
    mine = F.col("connection_id") == connection_id
    if own["is_dry_run"]:
        return inventory, inventory.where(F.lit(False)).select("item_id", "item_type")
    n = sweep_counts(inventory.where(mine), run_id).first()
    if n and not override and n["missing"] * 100 > guard_percent(most_percent) * n["live"]:
        raise Refused(50007, f"{n['missing']} of {n['live']} live items are missing")
    gone = mine & (F.col("state") == LIVE) & (F.col("last_seen_run") < run_id)
    out = inventory.withColumn("pending_since_utc", F.when(gone, instant(as_of)).otherwise(F.col("pending_since_utc"))).withColumn("state", F.when(gone, PENDING).otherwise(F.col("state")))
    return out, out.where(mine & (F.col("state") == PENDING)).select("item_id", "item_type").orderBy("item_id")


def sweep_preview(inventory: DataFrame, seen: DataFrame, connection_id: str, most_percent: float = 10.0, sample: int = 20) -> DataFrame:
    """What a sweep would do: the first sample missing ids, each beside the counts and the verdict."""
    live = inventory.where((F.col("connection_id") == connection_id) & (F.col("state") == LIVE)).select("item_id")
    missing = live.join(seen.select("item_id").distinct(), "item_id", "left_anti")
    counts = live.agg(F.count("*").alias("live")).crossJoin(missing.agg(F.count("*").alias("missing")))
    counts = counts.withColumn("would_refuse", F.col("missing") * 100 > F.lit(guard_percent(most_percent)) * F.col("live"))
    return missing.orderBy("item_id").limit(sample).crossJoin(counts)


def confirm_deletes(inventory: DataFrame, confirmed: DataFrame, as_of) -> DataFrame:
    """Pending items whose delete was confirmed become deleted; others keep their state."""
    hit = F.col("_ok").isNotNull() & (F.col("state") == PENDING)
    d = inventory.join(confirmed.select(*KEY, F.lit(True).alias("_ok")).distinct(), KEY, "left")
    d = d.withColumn("deleted_utc", F.when(hit, instant(as_of)).otherwise(F.col("deleted_utc"))).withColumn("pending_since_utc", F.when(~hit, F.col("pending_since_utc")))
    return d.withColumn("state", F.when(hit, DELETED).otherwise(F.col("state"))).drop("_ok")


def item_state(inventory: DataFrame, batch: DataFrame) -> DataFrame:
    """Hashes of those items of a batch that are live; what is absent must be written."""
    return inventory.where(F.col("state") == LIVE).join(batch.select(*KEY).distinct(), KEY).select(*KEY, "content_hash", "acl_hash")


def register_connections(connections: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(connections, new, ["connection_id"])


def full_due(runs: DataFrame, checkpoints: DataFrame, connections: DataFrame, as_of, full_every_hours: int) -> DataFrame:
    """connection_id, full_due: no full run ever succeeded, no marker, or the last one is too old."""
    ok = (F.col("status") == SUCCEEDED) & (F.col("mode") == FULL) & ~F.col("is_dry_run")
    last = runs.where(ok).groupBy("connection_id").agg(F.max("completed_utc").alias("last_full"))
    d = connections.select("connection_id").join(last, "connection_id", "left").join(checkpoints.select("connection_id", "marker_time"), "connection_id", "left")
    old = F.col("last_full") < instant(as_of) - F.make_dt_interval(hours=F.lit(full_every_hours))
    return d.select("connection_id", "last_full", (F.col("last_full").isNull() | F.col("marker_time").isNull() | old).alias("full_due"))


def open_runs(runs: DataFrame, as_of, lease_seconds: int, abandon_hours: int) -> DataFrame:
    """Running runs and what becomes of each: held (its lease is fresh, another run is refused with
    50043) or abandoned."""
    now = instant(as_of)
    fresh = F.col("heartbeat_utc") >= now - F.make_dt_interval(secs=F.lit(lease_seconds))
    young = F.col("started_utc") >= now - F.make_dt_interval(hours=F.lit(abandon_hours))
    return runs.where(F.col("status") == RUNNING).withColumn("fate", F.when(F.coalesce(fresh, F.lit(False)) & young, "held").otherwise("abandoned"))


def hash_version_due(connections: DataFrame, version: int = HASH_VERSION) -> DataFrame:
    """connection_id, previous and current hash_version, changed: hashes of another version force a full
    run. A connection without a stamp has written nothing yet, so nothing changed."""
    known = F.coalesce("hash_version", F.lit(version))
    return connections.select("connection_id", known.alias("previous_version"), F.lit(version).alias("current_version"), (known != version).alias("changed"))


def begin_run(runs: DataFrame, checkpoints: DataFrame, connections: DataFrame, connection_id: str, run_id: int, as_of, *, mode: int = INCREMENTAL, is_dry_run: bool = False, lease_seconds: int = 300, abandon_hours: int = 24, full_every_hours: int = 168) -> DataFrame:
    """runs with a new open run of the connection; refused (50043) while another holds the lease.

    Its other open runs are abandoned. The new one is full if a full one is due or, where connections have
    a hash_version, if that has changed.
    """
    mine, now = F.col("connection_id") == connection_id, instant(as_of)
    if not open_runs(runs.where(mine), as_of, lease_seconds, abandon_hours).where("fate = 'held'").isEmpty():
        raise Refused(50043, "another run of the connection holds the lease")
    own = connections.where(mine)
    due = full_due(runs.where(mine), checkpoints, own, as_of, full_every_hours).where("full_due")
    if "hash_version" in connections.columns:
        due = due.select("connection_id").union(hash_version_due(own).where("changed").select("connection_id"))
    mode = mode if due.isEmpty() else FULL
    stale = mine & (F.col("status") == RUNNING)
    old = runs.withColumns({"status": F.when(stale, ABANDONED).otherwise(F.col("status")), "completed_utc": F.when(stale, now).otherwise(F.col("completed_utc"))})
    new = runs.sparkSession.createDataFrame([(run_id, connection_id, mode, RUNNING, is_dry_run)], "run_id long, connection_id string, mode int, status int, is_dry_run boolean")
    counters = {c: F.lit(0).cast("long") for c in runs.columns if c.startswith("items_")}
    return old.unionByName(new.withColumns({"started_utc": now, "heartbeat_utc": now} | counters), allowMissingColumns=True)


def heartbeat(runs: DataFrame, run_id: int, as_of) -> DataFrame:
    """The open run's lease renewed, never backwards; a run that has ended keeps its last."""
    own = (F.col("run_id") == run_id) & (F.col("status") == RUNNING)
    return runs.withColumn("heartbeat_utc", F.when(own, F.greatest("heartbeat_utc", instant(as_of))).otherwise(F.col("heartbeat_utc")))


def full_run(inventory: DataFrame, runs: DataFrame, candidates: DataFrame, connection_id: str, run_id: int, as_of, *, most_percent: float = 10.0, override: bool = False) -> tuple[DataFrame, DataFrame]:
    """inventory and runs after an open run of the connection has compared, recorded, swept and ended.

    candidates: connection_id, item_id, item_type, content_hash, acl_hash, content_bytes of what the source
    has, each once. Only a full run sweeps, under the guard of sweep, and what it sweeps counts as
    deleted. A dry run ends with its counters and changes no item. Refused for an unknown run (50004),
    another connection's run or candidates (50005), and by the guard (50007).

    One full outer join of the connection's items with the candidates decides what becomes of each, and its
    result is written once: the source is read once, and the counters, observed by that write, are of the
    rows that were written. Nothing else reaches the driver.
    """
    own = runs.where(F.col("run_id") == run_id).select("connection_id", "mode", "is_dry_run").first()
    if own is None:
        raise Refused(50004, "unknown run")
    if own["connection_id"] != connection_id:
        raise Refused(50005, "the run is another connection's")
    mine = F.col("connection_id") == connection_id
    sweeps = F.lit(own["mode"] == FULL)
    given = ["item_type", "content_hash", "acl_hash", "content_bytes"]
    new = candidates.select(*KEY, F.struct(*given).alias("_new"))
    d = inventory.where(mine).withColumn("_old", F.lit(True)).join(new, KEY, "full_outer")
    found, live = F.col("_new").isNotNull(), F.col("_old").isNotNull() & (F.col("state") == LIVE)
    same = live & F.coalesce((F.col("_new.content_hash") == F.col("content_hash")) & (F.col("_new.acl_hash") == F.col("acl_hash")), F.lit(False))
    fate = (
        F.when(found & ~mine, "foreign").when(found & same, "unchanged").when(found, "write")
        .when(sweeps & live & (F.col("last_seen_run") < run_id), "missing").when(sweeps & (F.col("state") == PENDING), "pending").otherwise("kept")
    )
    d = d.withColumn("_fate", fate)
    n = Observation()
    is_ = lambda *f: F.count_if(F.col("_fate").isin(*f))
    still = F.count_if((F.col("_fate") == "kept") & (F.col("state") == LIVE))
    d = d.observe(n, is_("write").alias("items_written"), is_("unchanged").alias("items_unchanged"), is_("missing").alias("missing"), is_("missing", "pending").alias("items_deleted"), is_("foreign").alias("foreign"), still.alias("still"))
    if own["is_dry_run"]:
        d.write.format("noop").mode("overwrite").save()
        out = inventory
    else:
        out = inventory.where(~mine).unionByName(written(_settled(d, inventory.columns, run_id, as_of), "inventory"))
    got = n.get
    if got["foreign"]:
        raise Refused(50005, f"{got['foreign']} candidates are another connection's")
    counters = {c: got[c] for c in ("items_written", "items_unchanged", "items_deleted")}
    if own["is_dry_run"]:
        return out, finish_run(runs, run_id, as_of, counters | {"items_deleted": 0})
    all_live = got["items_written"] + got["items_unchanged"] + got["missing"] + got["still"]
    if not override and got["missing"] * 100 > guard_percent(most_percent) * all_live:
        raise Refused(50007, f"{got['missing']} of {all_live} live items are missing")
    return out, finish_run(runs, run_id, as_of, counters)


def _settled(judged: DataFrame, columns: list[str], run_id: int, as_of) -> DataFrame:
    """The judged items (see full_run) as they are after the run."""
    now, run = instant(as_of), F.lit(run_id).cast("long")
    fate = F.col("_fate")
    write, seen, gone = fate == "write", fate == "unchanged", fate.isin("missing", "pending")
    new = lambda c: F.when(write, F.col(f"_new.{c}")).otherwise(F.col(c))
    after = {c: new(c) for c in ("item_type", "content_hash", "acl_hash", "content_bytes")} | {
        "first_seen_run": F.coalesce("first_seen_run", run),
        "last_seen_run": F.when(write | seen, run).otherwise(F.col("last_seen_run")),
        "last_written_run": F.when(write, run).otherwise(F.col("last_written_run")),
        "last_written_utc": F.when(write, now).otherwise(F.col("last_written_utc")),
        "state": F.when(write, LIVE).when(gone, DELETED).otherwise(F.col("state")),
        "pending_since_utc": F.when(~write & ~gone, F.col("pending_since_utc")),
        "deleted_utc": F.when(gone, now).when(~write, F.col("deleted_utc")),
        "unchanged_streak": F.when(write, 0).when(seen, F.col("unchanged_streak") + 1).otherwise(F.col("unchanged_streak")),
    }
    return judged.select(*(after.get(c, F.col(c)).cast(judged.schema[c].dataType).alias(c) for c in columns))


def finish_run(runs: DataFrame, run_id: int, as_of, counters: dict[str, int], failed: bool = False) -> DataFrame:
    """runs after one is completed (partial if items failed) or failed; its counters are kept either way."""
    if not runs.where((F.col("run_id") == run_id) & (F.col("status") == RUNNING)).limit(1).count():
        raise Refused(50003, "the run is not open")
    status = FAILED if failed else PARTIAL if counters.get("items_failed", 0) else SUCCEEDED
    own = F.col("run_id") == run_id
    new = {"status": F.lit(status), "completed_utc": instant(as_of)} | {k: F.lit(v) for k, v in counters.items()}
    return runs.withColumns({k: F.when(own, v).otherwise(F.col(k)) for k, v in new.items()})


def reclassified(runs: DataFrame) -> DataFrame:
    """Succeeded runs that refused items become partial."""
    return runs.withColumn("status", F.when((F.col("status") == SUCCEEDED) & (F.col("items_failed") > 0), PARTIAL).otherwise(F.col("status")))


def save_checkpoints(checkpoints: DataFrame, saved: DataFrame) -> DataFrame:
    """Checkpoints after saves (connection_id, run_id, marker_time, marker_key): forward only, as a pair."""
    latest = saved.groupBy("connection_id").agg(F.max(F.struct("marker_time", "marker_key", "run_id")).alias("s"))
    d = checkpoints.join(latest, "connection_id", "full_outer")
    pair = lambda *c: F.struct(*(F.col(x) for x in c))
    new = F.col("s").isNotNull() & (F.col("marker_time").isNull() | (pair("s.marker_time", "s.marker_key") > pair("marker_time", "marker_key")))
    take = lambda c: F.when(new, F.col(f"s.{c}")).otherwise(F.col(c)).alias(c)
    return d.select("connection_id", take("marker_time"), take("marker_key"), take("run_id"), (F.coalesce("run_count", F.lit(0)) + F.when(F.col("s").isNotNull(), 1).otherwise(0)).alias("run_count"))


def committed_marker(items: DataFrame, chunk: int = 20) -> DataFrame:
    """The marker that may be saved when some items (ordinal, marker_time, marker_key, refused) were
    refused: the last of the last chunk before the first refusal. No row if there is none."""
    first = items.where("refused").agg(F.min("ordinal").alias("stop"))
    whole = F.floor(F.coalesce(F.col("stop"), F.lit(1 << 62)) / chunk)
    ok = items.crossJoin(first).where(F.floor(F.col("ordinal") / chunk) < whole)
    return ok.agg(F.max(F.struct("ordinal", "marker_time", "marker_key")).alias("m")).where("m is not null").select("m.*")


def resolve_principals(cache: DataFrame, wanted: DataFrame, as_of) -> DataFrame:
    """Cached answers that have not expired, with hit_count one more; a null object is a known absence."""
    keys = ["connection_id", "source_type", "source_key"]
    d = cache.where(F.col("expires_utc") > instant(as_of)).join(wanted.select(*keys).distinct(), keys)
    return d.withColumn("hit_count", F.col("hit_count") + 1)


def principal_ttl(object_id: Column, ttl_minutes: int, negative_minutes: Column) -> Column:
    """Minutes that an answer is kept: absences at most as long as the connection allows, at least 1."""
    return F.greatest(F.when(object_id.isNull(), F.least(F.lit(ttl_minutes), negative_minutes)).otherwise(F.lit(ttl_minutes)), F.lit(1))


def cache_principals(cache: DataFrame, answers: DataFrame, connections: DataFrame, as_of, ttl_minutes: int = 720) -> DataFrame:
    keys = ["connection_id", "source_type", "source_key"]
    policy = connections.select("connection_id", F.coalesce("negative_ttl_minutes", F.lit(60)).alias("_negative"))
    minutes = principal_ttl(F.col("object_id"), ttl_minutes, F.coalesce("_negative", F.lit(60)))
    new = answers.join(policy, "connection_id", "left").withColumn("expires_utc", instant(as_of) + F.make_dt_interval(mins=minutes)).withColumn("hit_count", F.lit(0)).drop("_negative")
    return upsert(cache, new, keys)


def clamp_absences(cache: DataFrame, connections: DataFrame, as_of) -> DataFrame:
    """Known absences expire no later than their connection's negative time from now."""
    policy = connections.select("connection_id", F.coalesce("negative_ttl_minutes", F.lit(60)).alias("_negative"))
    latest = instant(as_of) + F.make_dt_interval(mins=F.coalesce("_negative", F.lit(60)))
    d = cache.join(policy, "connection_id", "left")
    return d.withColumn("expires_utc", F.when(F.col("object_id").isNull(), F.least("expires_utc", latest)).otherwise(F.col("expires_utc"))).drop("_negative")


def record_throttles(events: DataFrame, run_id: int, new: DataFrame, as_of) -> DataFrame:
    """events with those of a run appended: status_code, and where known retry_after_seconds, endpoint (item),
    attempt_number (1) and occurred_utc (now). Nothing is compared, so a flush twice is recorded twice."""
    given = {"retry_after_seconds": F.lit(None).cast("int"), "endpoint": F.lit("item"), "attempt_number": F.lit(1), "occurred_utc": instant(as_of)}
    d = new.withColumns({c: F.coalesce(c, v) if c in new.columns else v for c, v in given.items()}).withColumn("run_id", F.lit(run_id))
    return events.unionByName(d.select(*(F.col(c).cast(events.schema[c].dataType).alias(c) for c in events.columns if c in d.columns)), allowMissingColumns=True)


def planned_modes(due: DataFrame, sources: DataFrame) -> DataFrame:
    """connection_id and mode of each connection's next run. sources: connection_id, has_marker. A source
    without a usable time of change is read whole by every run; one with it only when a full run is due."""
    d = sources.join(due.select("connection_id", "full_due"), "connection_id", "left")
    full = ~F.coalesce("has_marker", F.lit(False)) | F.coalesce("full_due", F.lit(True))
    return d.select("connection_id", F.when(full, FULL).otherwise(INCREMENTAL).alias("mode"))


def replace_run_rows(current: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of a run (timings) in place of all that it had."""
    return current.join(new.select("run_id").distinct(), "run_id", "left_anti").unionByName(new)


def merge_run_item_types(current: DataFrame, new: DataFrame) -> DataFrame:
    return upsert(current, new, ["run_id", "item_type"])


def purgeable_runs(runs: DataFrame, inventory: DataFrame, checkpoints: DataFrame, as_of, keep_days: int) -> DataFrame:
    """Finished runs older than keep_days that no live item and no checkpoint refers to."""
    old = runs.where((F.col("status") != RUNNING) & (F.col("started_utc") < instant(as_of) - F.make_dt_interval(days=F.lit(keep_days))))
    live = inventory.where(F.col("state") == LIVE)
    used = live.select(F.explode(F.array("first_seen_run", "last_seen_run", "last_written_run")).alias("run_id")).union(checkpoints.select("run_id")).where("run_id is not null").distinct()
    return old.join(used, "run_id", "left_anti")


def purge(tables: dict[str, DataFrame], as_of, keep_runs: int = 90, keep_tombstones: int = 30, keep_principals: int = 7) -> dict[str, DataFrame]:
    """run, item, principal and the rows that belong to runs, without what retention lets go."""
    gone = purgeable_runs(tables["run"], tables["item"], tables["checkpoint"], as_of, keep_runs).select("run_id")
    before = lambda days: instant(as_of) - F.make_dt_interval(days=F.lit(days))
    out = {k: tables[k].join(gone, "run_id", "left_anti") for k in ("run", "throttle_event", "run_phase_timing", "run_item_type") if k in tables}
    out["item"] = tables["item"].where(~((F.col("state") == DELETED) & F.coalesce(F.col("deleted_utc") < before(keep_tombstones), F.lit(False))))
    if "principal" in tables:
        out["principal"] = tables["principal"].where(F.col("expires_utc") >= before(keep_principals))
    return out


def run_totals(items: DataFrame) -> DataFrame:
    """Totals of a run's items by outcome; read is written, unchanged and skipped together."""
    n = lambda *o: F.count_if(F.col("outcome").isin(*o))
    return items.groupBy("run_id").agg(n("written", "unchanged", "skipped").alias("items_read"), *(n(o).alias(f"items_{o}") for o in ("written", "unchanged", "deleted", "skipped", "failed", "duplicate")))


def type_totals(items: DataFrame) -> DataFrame:
    """The same by item type; a blank type counts as item."""
    kind = F.coalesce(F.nullif(F.trim("item_type"), F.lit("")), F.lit("item"))
    n = lambda o: F.count_if(F.col("outcome") == o).alias(f"items_{o}")
    return items.groupBy("run_id", kind.alias("item_type")).agg(*(n(o) for o in ("written", "unchanged", "deleted", "skipped", "failed", "duplicate")), F.sum(F.when(F.col("outcome") == "written", F.col("content_bytes")).otherwise(0)).alias("bytes_written"))


def constraint_faults(runs: DataFrame, inventory: DataFrame, connections: DataFrame) -> DataFrame:
    """Rows that break a rule of the state tables, by rule; all must be 0."""
    c = F.col
    rules = [
        (runs, "run status and completion", ((c("status") == RUNNING) != c("completed_utc").isNull())),
        (runs, "run mode", ~c("mode").isin(FULL, INCREMENTAL)),
        (runs, "run status", ~c("status").between(RUNNING, PARTIAL)),
        (inventory, "item state", ~c("state").between(LIVE, DELETED)),
        (inventory, "pending since", ((c("state") == PENDING) != c("pending_since_utc").isNotNull())),
        (inventory, "deleted at", ((c("state") == DELETED) != c("deleted_utc").isNotNull())),
        (connections, "expected interval", c("expected_interval_minutes") <= 0),
    ]
    out = [df.agg(F.lit(name).alias("rule"), F.count_if(F.coalesce(bad, F.lit(False))).alias("faults")) for df, name, bad in rules]
    d = out[0]
    for x in out[1:]:
        d = d.unionByName(x)
    return d
