"""The same results in DuckDB's SQL, written from what each query means."""

from __future__ import annotations

from tidemark.functions.text import TRUNCATION_MARK
from tidemark.plans.fixtures import AS_OF, with_fixtures

NOW = f"TIMESTAMP '{AS_OF}'"
NL = "chr(13) || chr(10)"
SQL: dict[str, str] = {}


def _with(*names: str) -> str:
    return with_fixtures(*names)


_H = ("customers", "engagements", "entries")
_LIVE = """,
c AS (SELECT * FROM customers WHERE NOT is_deleted), e AS (SELECT * FROM engagements WHERE NOT is_deleted), t AS (SELECT * FROM entries WHERE NOT is_deleted),
per_engagement AS (SELECT engagement_id, count(*) AS n, sum(hours) AS h, string_agg(DISTINCT consultant_name, ', ' ORDER BY consultant_name) AS people FROM t GROUP BY ALL),
per_customer AS (SELECT customer_id, count(*) AS n, sum(contract_value) AS v, sum(h) AS h, string_agg(engagement_name || ' (' || engagement_code || ', ' || status || ')', '; ' ORDER BY engagement_code) AS list
                 FROM e LEFT JOIN per_engagement USING (engagement_id) GROUP BY ALL)"""
_L1 = f"""SELECT 'cust' || customer_id AS item_id, customer_name AS title, 'https://portal.example.com/customers/' || customer_id AS url, customer_name AS hierarchy_path,
 cast(coalesce(v, 0) AS decimal(18,2)) AS contract_value, cast(coalesce(h, 0) AS decimal(10,2)) AS total_hours, cast(coalesce(n, 0) AS int) AS child_count,
 'Customer: ' || customer_name || ' (' || customer_code || ')' || {NL} || 'Industry: ' || industry || ' | Region: ' || region || ' | Account manager: ' || account_manager || ' <' || account_manager_email || '>' || {NL}
 || 'Engagements: ' || coalesce(n, 0) || ' | Total logged: ' || cast(coalesce(h, 0) AS decimal(10,2)) || ' hours | Contract value: ' || cast(coalesce(v, 0) AS decimal(18,2)) || {NL}
 || coalesce('Engagement list: ' || list || {NL}, '') || {NL} || notes AS content, customer_id AS source_id
 FROM c LEFT JOIN per_customer USING (customer_id)"""
_L2 = f"""SELECT 'eng' || engagement_id AS item_id, engagement_name AS title, customer_name || ' > ' || engagement_name AS hierarchy_path, customer_name AS container_name, c.customer_id, contract_value,
 cast(coalesce(h, 0) AS decimal(10,2)) AS total_hours, cast(coalesce(n, 0) AS int) AS child_count,
 'Engagement: ' || engagement_name || ' (' || engagement_code || ')' || {NL} || 'Customer: ' || customer_name || ' (' || customer_code || ') | ' || industry || ' | ' || region || ' | Account manager: ' || account_manager || {NL}
 || 'Practice: ' || practice || ' | Status: ' || status || ' | Project manager: ' || project_manager || {NL} || 'Started ' || strftime(start_date, '%Y-%m-%d')
 || coalesce(' | ended ' || strftime(end_date, '%Y-%m-%d'), ' | ongoing') || ' | Contract value: ' || contract_value || {NL} || 'Logged to date: ' || cast(coalesce(h, 0) AS decimal(10,2)) || ' hours across '
 || coalesce(n, 0) || ' time entries' || {NL} || coalesce('Consultants: ' || people || {NL}, '') || {NL} || scope AS content
 FROM e JOIN c ON c.customer_id = e.customer_id LEFT JOIN per_engagement USING (engagement_id)"""
_L3 = f"""SELECT 'time' || entry_id AS item_id, strftime(work_date, '%Y-%m-%d') || ' — ' || consultant_name || ' — ' || engagement_name || ' — ' || customer_name AS title,
 customer_name || ' > ' || engagement_name || ' > ' || strftime(work_date, '%Y-%m-%d') || ' ' || consultant_name AS hierarchy_path, engagement_name || ' — ' || customer_name AS container_name,
 c.customer_id, e.engagement_id, hours, billable,
 'Time entry: ' || consultant_name || ' — ' || strftime(work_date, '%Y-%m-%d') || ' — ' || hours || ' hours' || CASE WHEN billable THEN ' (billable)' ELSE ' (non billable)' END || {NL}
 || 'Customer: ' || customer_name || ' (' || customer_code || ') | ' || industry || ' | ' || region || ' | Account manager: ' || account_manager || {NL} || 'Engagement: ' || engagement_name || ' (' || engagement_code || ') | '
 || practice || ' | ' || status || ' | Project manager: ' || project_manager || {NL} || 'Work type: ' || work_type || {NL} || {NL} || narrative AS content
 FROM t JOIN e ON e.engagement_id = t.engagement_id JOIN c ON c.customer_id = e.customer_id"""
SQL["flatten_level1"] = f"{_with(*_H)}{_LIVE} {_L1}"
SQL["flatten_level2"] = f"{_with(*_H)}{_LIVE} {_L2}"
SQL["flatten_level3"] = f"{_with(*_H)}{_LIVE} {_L3}"
SQL["flatten_all"] = f"""{_with(*_H)}{_LIVE}, l1 AS ({_L1}), l2 AS ({_L2}), l3 AS ({_L3})
SELECT 'Customer' AS item_type, count(*) AS items, count(DISTINCT item_id) AS ids, cast(sum(child_count) AS bigint) AS children FROM l1
UNION ALL SELECT 'Engagement', count(*), count(DISTINCT item_id), cast(sum(child_count) AS bigint) FROM l2 UNION ALL SELECT 'TimeEntry', count(*), count(DISTINCT item_id), 0 FROM l3"""
SQL["flatten_missing_ancestors"] = f"""{_with(*_H)}{_LIVE}, l2 AS ({_L2}) SELECT item_id, 'Engagement' AS item_type, customer_id FROM l2 WHERE customer_id % 5 = 0"""
SQL["customer_hours"] = f"""{_with(*_H)}{_LIVE} SELECT c.customer_id, count(DISTINCT engagement_id) AS engagements, count(*) AS entries, sum(hours) AS hours,
 sum(CASE WHEN billable THEN hours ELSE 0 END) AS billable_hours, customer_name FROM t JOIN e USING (engagement_id) JOIN c ON c.customer_id = e.customer_id GROUP BY c.customer_id, customer_name"""
SQL["childless_customers"] = f"{_with(*_H)}{_LIVE} SELECT customer_id, customer_name FROM c WHERE customer_id NOT IN (SELECT customer_id FROM e WHERE customer_id % 4 <> 1)"
SQL["replicated_counts"] = f"""{_with(*_H)}{_LIVE}, l1 AS ({_L1}), l2 AS ({_L2}), l3 AS ({_L3})
SELECT 'Customer' AS item_type, 3 * count(*) AS items, 3 * count(DISTINCT item_id) AS ids FROM l1 UNION ALL SELECT 'Engagement', 3 * count(*), 3 * count(DISTINCT item_id) FROM l2
UNION ALL SELECT 'TimeEntry', 3 * count(*), 3 * count(DISTINCT item_id) FROM l3"""

_ELM = """,
ce AS (SELECT *, last_modified AS em FROM customers),
ee AS (SELECT e.*, greatest(e.last_modified, ce.em) AS em FROM engagements e LEFT JOIN ce ON ce.customer_id = e.customer_id),
te AS (SELECT t.*, greatest(t.last_modified, ee.em) AS em FROM entries t LEFT JOIN ee ON ee.engagement_id = t.engagement_id)"""
SQL["effective_modified"] = f"{_with(*_H)}{_ELM} SELECT entry_id, last_modified, em AS effective_modified FROM te"
SQL["keyset_resume"] = f"{_with(*_H)}{_ELM} SELECT entry_id, em AS effective_modified FROM te WHERE em > TIMESTAMP '2000-06-01' OR (em = TIMESTAMP '2000-06-01' AND entry_id > 30000000000000)"
SQL["keyset_ceiling"] = f"{_with(*_H)}{_ELM} SELECT engagement_id, em AS effective_modified FROM ee WHERE (em > TIMESTAMP '1999-01-01' OR (em = TIMESTAMP '1999-01-01' AND engagement_id > 0)) AND em < TIMESTAMP '2000-06-01'"
SQL["keyset_slack"] = f"{_with(*_H)}{_ELM} SELECT engagement_id, em AS effective_modified FROM ee WHERE em > TIMESTAMP '2000-05-31' OR (em = TIMESTAMP '2000-05-31' AND engagement_id > 7000)"
SQL["read_marker"] = f"{_with(*_H)}{_ELM} SELECT engagement_id, CASE WHEN em < TIMESTAMP '2000-01-01' THEN em END AS marker FROM ee"


def _order(rel: str, t: str, k: str, now: str) -> str:
    return f"""a AS (SELECT count(*) AS rows, count(*) FILTER ({t} IS NULL) AS null_times, count(*) FILTER ({t} > TIMESTAMP '{now}') AS ahead FROM {rel}),
b AS (SELECT count(*) AS repeated_pairs FROM (SELECT 1 FROM {rel} GROUP BY {t}, {k} HAVING count(*) > 1)),
g AS (SELECT count(*) AS tie_groups, coalesce(max(n), 0) AS largest_tie FROM (SELECT count(*) AS n FROM {rel} GROUP BY {t} HAVING count(*) > 1))
SELECT *, CASE WHEN null_times = 0 AND repeated_pairs = 0 AND ahead = 0 THEN 'ok' ELSE 'broken' END AS verdict FROM a, b, g"""


SQL["marker_order"] = f"{_with(*_H)}{_ELM}, {_order('te', 'em', 'entry_id', AS_OF)}"
SQL["marker_ties"] = f"WITH ev AS (SELECT event_id, date_trunc('hour', ts) AS h FROM events), {_order('ev', 'h', 'event_id', '2024-01-02')}"
SQL["stale_edges"] = f"""{_with(*_H)}{_ELM}, s AS (
SELECT 'engagement<customer' AS edge, count(*) FILTER (ee.em < ce.em) AS stale FROM ee JOIN ce ON ce.customer_id = ee.customer_id
UNION ALL SELECT 'entry<engagement', count(*) FILTER (te.last_modified < ee.em) FROM te JOIN ee ON ee.engagement_id = te.engagement_id
UNION ALL SELECT 'entry<customer', count(*) FILTER (te.last_modified < ce.em) FROM te JOIN ee ON ee.engagement_id = te.engagement_id JOIN ce ON ce.customer_id = ee.customer_id)
SELECT *, CASE WHEN stale = 0 THEN 'ok' ELSE 'stale' END AS verdict FROM s"""
SQL["count_parity"] = f"""{_with(*_H)}{_LIVE}, i AS (SELECT c.customer_id, true AS stays FROM c UNION ALL SELECT c.customer_id, c.customer_id % 5 <> 2 FROM e JOIN c ON c.customer_id = e.customer_id
 UNION ALL SELECT c.customer_id, c.customer_id % 5 <> 2 FROM t JOIN e ON e.engagement_id = t.engagement_id JOIN c ON c.customer_id = e.customer_id)
SELECT count(*) AS full_items, count(*) FILTER (stays) AS incremental_items, 'differs' AS verdict FROM i"""
SQL["cascade"] = f"{_with(*_H)}{_ELM} SELECT engagement_id, CASE WHEN customer_id % 10 = 1 THEN greatest(em, TIMESTAMP '2000-09-01') ELSE em END AS effective_modified FROM ee"
SQL["preflight"] = f"""{_with("engagements")} SELECT min(last_modified) AS first, max(last_modified) AS last, count(*) FILTER (last_modified > TIMESTAMP '2000-06-01') AS in_future,
 count(*) FILTER (last_modified > TIMESTAMP '2000-01-01' OR (last_modified = TIMESTAMP '2000-01-01' AND engagement_id > 100)) AS pending FROM engagements"""


def _frame(x: str) -> str:
    h = f"printf('%08x', strlen({x}))"
    return f"(unhex(substr({h}, 7, 2) || substr({h}, 5, 2) || substr({h}, 3, 2) || substr({h}, 1, 2)) || encode({x}))"


SQL["content_hash"] = f"""SELECT 'doc' || doc_id AS item_id, sha256({_frame("'doc' || doc_id")} || {_frame("lang")} || {_frame("'even'")} || {_frame("CASE WHEN doc_id % 2 = 0 THEN 'true' ELSE 'false' END")}
 || {_frame("'n_chars'")} || {_frame("cast(n_chars AS varchar)")} || {_frame("'source'")} || {_frame("source")} || {_frame("text")}) AS content_hash FROM documents"""
_A, _B = "'group|' || source || '|grant'", "'group|' || lang || '|grant'"
SQL["acl_hash"] = f"""SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN sha256({_frame("'(no grants)'")})
 ELSE sha256({_frame(f"least({_A}, {_B})")} || {_frame(f"greatest({_A}, {_B})")}) END AS acl_hash FROM documents"""
SQL["item_ids"] = """SELECT doc_id, 'h' || sha256('/data/' || source) AS path_id, 't' || sha256(source || chr(31) || doc_id) AS view_row_id,
 'mongo' || substr(regexp_replace(source || '-' || doc_id, '[^A-Za-z0-9]', '', 'g'), 1, 100) AS key_id FROM documents"""
SQL["duplicates_last_wins"] = """WITH i AS (SELECT CASE WHEN doc_id % 2 = 0 THEN 'DOC' ELSE 'doc' END || doc_id % 300 AS item_id, doc_id AS ordinal FROM documents)
SELECT arg_max(item_id, ordinal) AS item_id, max(ordinal) AS ordinal, count(*) - 1 AS duplicates FROM i GROUP BY lower(item_id)"""
SQL["compare_and_see"] = f"{_with('item')} SELECT item_id, CASE WHEN state = 1 AND (content_bytes % 7 <> 0 OR upper(content_hash) = content_hash) THEN 'unchanged' ELSE 'write' END AS action FROM item"
SQL["record_written"] = f"""{_with("item")} SELECT item_id, CASE WHEN w THEN 1 ELSE state END AS state, first_seen_run, CASE WHEN w THEN 5000 ELSE last_seen_run END AS last_seen_run,
 CASE WHEN w THEN 0 ELSE unchanged_streak END AS unchanged_streak, CASE WHEN w THEN {NOW} ELSE last_written_utc END AS last_written_utc, CASE WHEN NOT w THEN pending_since_utc END AS pending_since_utc
 FROM (SELECT *, content_bytes % 3 = 0 AS w FROM item)"""
SQL["record_unchanged"] = f"""{_with("item")} SELECT item_id, CASE WHEN s THEN 5000 ELSE last_seen_run END AS last_seen_run, unchanged_streak + CASE WHEN s THEN 1 ELSE 0 END AS unchanged_streak
 FROM (SELECT *, content_bytes % 2 = 0 AND state = 1 AS s FROM item)"""
SQL["sweep_counts"] = f"""{_with("item")} SELECT connection_id, live, missing, cast(missing * 100 / nullif(live, 0) AS decimal(9,2)) AS missing_percent FROM (
 SELECT connection_id, count(*) FILTER (state = 1) AS live, count(*) FILTER (state = 1 AND last_seen_run < 40) AS missing FROM item GROUP BY ALL)"""
SQL["sweep_pending"] = f"{_with('item')} SELECT item_id, item_type FROM item WHERE connection_id = 'conn3' AND (state = 2 OR (state = 1 AND last_seen_run < 40))"
SQL["sweep_preview"] = f"""{_with("item")}, l AS (SELECT * FROM item WHERE connection_id = 'conn3' AND state = 1), m AS (SELECT item_id FROM l WHERE content_bytes % 4 = 0),
n AS (SELECT (SELECT count(*) FROM l) AS live, (SELECT count(*) FROM m) AS missing) SELECT item_id, live, missing, missing * 100 > 10 * live AS would_refuse FROM (SELECT * FROM m ORDER BY item_id LIMIT 20), n"""
SQL["confirm_deletes"] = f"""{_with("item")} SELECT item_id, CASE WHEN k THEN 3 ELSE state END AS state, CASE WHEN NOT k THEN pending_since_utc END AS pending_since_utc, CASE WHEN k THEN {NOW} ELSE deleted_utc END AS deleted_utc
 FROM (SELECT *, state = 2 AND content_bytes % 2 = 0 AS k FROM item)"""
SQL["full_due"] = f"""{_with("run", "checkpoint", "connection")}, l AS (SELECT connection_id, max(completed_utc) AS last_full FROM run WHERE status = 2 AND mode = 1 AND NOT is_dry_run GROUP BY ALL)
SELECT connection_id, last_full, last_full IS NULL OR marker_time IS NULL OR last_full < {NOW} - INTERVAL 7 DAY AS full_due FROM connection LEFT JOIN l USING (connection_id) LEFT JOIN checkpoint USING (connection_id)"""
SQL["open_runs"] = f"""{_with("run")} SELECT run_id, CASE WHEN heartbeat_utc >= {NOW} - INTERVAL 60 DAY AND started_utc >= {NOW} - INTERVAL 365 DAY THEN 'held' ELSE 'abandoned' END AS fate FROM run WHERE status = 1"""
SQL["save_checkpoints"] = f"""{_with("item", "checkpoint")}, s AS (SELECT connection_id, max(last_written_utc) AS t, max(item_id) AS k, max(last_seen_run) AS r FROM item WHERE connection_id < 'conn2' GROUP BY ALL),
j AS (SELECT coalesce(c.connection_id, s.connection_id) AS connection_id, c.*  EXCLUDE (connection_id), t, k, r, t IS NOT NULL AND (marker_time IS NULL OR t > marker_time OR (t = marker_time AND k > marker_key)) AS f
      FROM checkpoint c FULL JOIN s ON s.connection_id = c.connection_id)
SELECT connection_id, CASE WHEN f THEN t ELSE marker_time END AS marker_time, CASE WHEN f THEN k ELSE marker_key END AS marker_key, CASE WHEN f THEN r ELSE run_id END AS run_id,
 coalesce(run_count, 0) + CASE WHEN t IS NULL THEN 0 ELSE 1 END AS run_count FROM j"""
SQL["committed_marker"] = f"""SELECT doc_id AS ordinal, {NOW} AS marker_time, 'doc' || doc_id AS marker_key FROM documents
 WHERE doc_id // 20 < (SELECT coalesce(min(doc_id) // 20, 1 << 60) FROM documents WHERE doc_id % 137 = 136) ORDER BY doc_id DESC LIMIT 1"""
SQL["resolve_principals"] = f"{_with('principal')} SELECT source_key, object_id, hit_count + 1 AS hit_count FROM principal WHERE expires_utc > {NOW} AND hit_count % 2 = 0"
SQL["cache_principals"] = f"""{_with("principal", "connection")} SELECT source_key, CASE WHEN hit_count <> 1 THEN expires_utc ELSE {NOW} + INTERVAL 1 MINUTE * (CASE WHEN object_id IS NULL THEN least(720, negative_ttl_minutes) ELSE 720 END) END AS expires_utc,
 CASE WHEN hit_count = 1 THEN 0 ELSE hit_count END AS hit_count FROM principal JOIN connection USING (connection_id)"""
SQL["clamp_absences"] = f"""{_with("principal", "connection")} SELECT source_key, CASE WHEN object_id IS NULL THEN least(expires_utc, {NOW} + INTERVAL 1 MINUTE * negative_ttl_minutes) ELSE expires_utc END AS expires_utc
 FROM principal JOIN connection USING (connection_id)"""
SQL["purgeable_runs"] = f"""{_with("run", "item", "checkpoint")} SELECT run_id FROM run WHERE status <> 1 AND started_utc < {NOW} - INTERVAL 90 DAY AND run_id NOT IN (
 SELECT unnest([first_seen_run, last_seen_run, last_written_run]) FROM item WHERE state = 1 UNION ALL SELECT run_id FROM checkpoint)"""
SQL["reclassified_runs"] = f"{_with('run')} SELECT run_id, CASE WHEN status = 2 AND items_failed > 0 THEN 5 ELSE status END AS status FROM run"
_O = "CASE WHEN state = 3 THEN 'deleted' WHEN state = 2 THEN 'skipped' WHEN unchanged_streak > 9 THEN 'unchanged' ELSE 'written' END"
SQL["type_totals"] = f"""{_with("item")}, o AS (SELECT first_seen_run % 5 AS run_id, CASE WHEN item_type = 'es' THEN 'item' ELSE item_type END AS item_type, content_bytes, {_O} AS o FROM item)
SELECT run_id, item_type, {", ".join(f"count(*) FILTER (o = '{x}') AS items_{x}" for x in ("written", "unchanged", "deleted", "skipped", "failed", "duplicate"))},
 cast(sum(CASE WHEN o = 'written' THEN content_bytes ELSE 0 END) AS bigint) AS bytes_written FROM o GROUP BY run_id, item_type"""
SQL["run_totals"] = f"""{_with("item")}, o AS (SELECT first_seen_run % 5 AS run_id, {_O} AS o FROM item)
SELECT run_id, count(*) FILTER (o IN ('written', 'unchanged', 'skipped')) AS items_read, {", ".join(f"count(*) FILTER (o = '{x}') AS items_{x}" for x in ("written", "unchanged", "deleted", "skipped", "failed", "duplicate"))} FROM o GROUP BY run_id"""
SQL["constraint_faults"] = f"""{_with("run", "item", "connection")}
SELECT 'run status and completion' AS rule, count(*) FILTER ((status = 1) <> (completed_utc IS NULL)) AS faults FROM run UNION ALL SELECT 'run mode', count(*) FILTER (mode NOT IN (1, 2)) FROM run
UNION ALL SELECT 'run status', count(*) FILTER (status NOT BETWEEN 1 AND 5) FROM run UNION ALL SELECT 'item state', count(*) FILTER (state NOT BETWEEN 1 AND 3) FROM item
UNION ALL SELECT 'pending since', count(*) FILTER ((state = 2) <> (pending_since_utc IS NOT NULL)) FROM item UNION ALL SELECT 'deleted at', count(*) FILTER ((state = 3) <> (deleted_utc IS NOT NULL)) FROM item
UNION ALL SELECT 'expected interval', count(*) FILTER (expected_interval_minutes <= 0) FROM connection"""


def _word(c: str, words: dict[int, str]) -> str:
    return f"CASE {c} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in words.items()) + " END"


_MODE = {1: "full", 2: "incremental"}
_STATUS = {1: "running", 2: "succeeded", 3: "failed", 4: "abandoned", 5: "partial"}
_HISTORY = f"""history AS (SELECT run_id, connection_id, display_name, connector_key, {_word("mode", _MODE)} AS mode, {_word("status", _STATUS)} AS status, is_dry_run, started_utc, completed_utc,
 date_diff('second', started_utc, coalesce(completed_utc, {NOW})) AS duration_seconds, items_written, items_unchanged, items_deleted,
 cast(cast(100 AS decimal(4,1)) * items_unchanged / nullif(items_written + items_unchanged, 0) AS decimal(5,1)) AS unchanged_percent,
 cast(cast(items_written + items_unchanged AS decimal(20,1)) / nullif(date_diff('second', started_utc, completed_utc), 0) AS decimal(10,2)) AS items_per_second FROM run JOIN connection USING (connection_id))"""
SQL["run_history"] = f"{_with('run', 'connection')}, {_HISTORY} SELECT * FROM history"
_HEALTH = f"""
last_run AS (SELECT * FROM run WHERE NOT is_dry_run QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY started_utc DESC, run_id DESC) = 1),
last_good AS (SELECT * FROM run WHERE NOT is_dry_run AND status = 2 QUALIFY row_number() OVER (PARTITION BY connection_id ORDER BY completed_utc DESC, run_id DESC) = 1),
good_start AS (SELECT connection_id, max(started_utc) AS s FROM run WHERE NOT is_dry_run AND status = 2 GROUP BY ALL),
streak AS (SELECT connection_id, count(*) AS k FROM run LEFT JOIN good_start USING (connection_id) WHERE NOT is_dry_run AND status IN (3, 4, 5) AND (s IS NULL OR started_utc > s) GROUP BY ALL),
held AS (SELECT connection_id, count(*) FILTER (state = 1) AS live, count(*) FILTER (state = 2) AS pending FROM item GROUP BY ALL),
health AS (SELECT c.connection_id, display_name, connector_key, is_enabled, expected_interval_minutes, l.run_id AS last_run_id, {_word("l.status", _STATUS)} AS last_run_status, l.started_utc AS last_run_started_utc,
 g.completed_utc AS last_success_utc, date_diff('minute', g.completed_utc, {NOW}) AS minutes_since_last_success, coalesce(k, 0) AS consecutive_failures, g.items_written AS last_success_items_written,
 g.items_unchanged AS last_success_items_unchanged, g.items_deleted AS last_success_items_deleted, coalesce(live, 0) AS live_item_count, coalesce(pending, 0) AS pending_delete_count,
 CASE WHEN NOT is_enabled THEN 'disabled' WHEN l.run_id IS NULL THEN 'never run' WHEN l.status = 1 THEN 'running' WHEN coalesce(k, 0) > 0 THEN 'failing' WHEN l.status = 5 THEN 'items refused'
  WHEN date_diff('minute', g.completed_utc, {NOW}) > 2 * expected_interval_minutes THEN 'late' WHEN coalesce(pending, 0) > 0 THEN 'deletes pending' ELSE 'healthy' END AS health
 FROM connection c LEFT JOIN last_run l ON l.connection_id = c.connection_id LEFT JOIN last_good g ON g.connection_id = c.connection_id LEFT JOIN streak s ON s.connection_id = c.connection_id LEFT JOIN held h ON h.connection_id = c.connection_id)"""
_RCI = ("run", "connection", "item")
SQL["connection_health"] = f"{_with(*_RCI)}, {_HEALTH} SELECT * FROM health"
_PENDING = f"""pending AS (SELECT i.connection_id, item_id, item_type, i.last_seen_run, date_diff('minute', pending_since_utc, {NOW}) AS age_minutes, r.started_utc AS last_seen_run_started_utc
 FROM item i JOIN connection c ON c.connection_id = i.connection_id LEFT JOIN run r ON r.run_id = i.last_seen_run WHERE state = 2)"""
SQL["pending_deletes"] = f"{_with(*_RCI)}, {_PENDING} SELECT item_id, last_seen_run, age_minutes, last_seen_run_started_utc FROM pending"
SQL["item_inventory"] = f"""{_with("item", "connection")} SELECT item_id, display_name, CASE state WHEN 1 THEN 'live' WHEN 2 THEN 'pending delete' ELSE 'deleted' END AS state, upper(content_hash) AS content_hash_hex,
 date_diff('day', last_written_utc, {NOW}) AS days_since_last_write FROM item JOIN connection USING (connection_id)"""
SQL["throttle_summary"] = f"""{_with("throttle_event", "run", "connection")} SELECT run_id, connection_id, display_name, started_utc AS run_started_utc, {_word("mode", _MODE)} AS mode, count(*) AS throttle_events,
 count(*) FILTER (status_code = 429) AS refusals_429, count(*) FILTER (status_code BETWEEN 500 AND 599) AS server_errors, cast(sum(coalesce(retry_after_seconds, 0)) AS bigint) AS total_retry_after_seconds,
 max(coalesce(retry_after_seconds, 0)) AS max_retry_after_seconds, count(DISTINCT date_diff('minute', started_utc, occurred_utc)) AS distinct_minutes, min(occurred_utc) AS first_event_utc, max(occurred_utc) AS last_event_utc,
 max(attempt_number) AS deepest_retry FROM throttle_event JOIN run USING (run_id) JOIN connection USING (connection_id) GROUP BY run_id, connection_id, display_name, started_utc, mode"""
_DAILY = f"""daily AS (SELECT connection_id, display_name, cast(started_utc AS date) AS activity_date, count(*) AS runs, count(*) FILTER (status = 2) AS succeeded, count(*) FILTER (status IN (3, 4, 5)) AS failed,
 cast(sum(items_written) AS bigint) AS items_written, cast(sum(items_unchanged) AS bigint) AS items_unchanged, cast(sum(items_deleted) AS bigint) AS items_deleted,
 cast(cast(100 AS decimal(4,1)) * sum(items_unchanged) / nullif(sum(items_written) + sum(items_unchanged), 0) AS decimal(5,1)) AS unchanged_percent,
 cast(avg(CASE WHEN status = 2 THEN date_diff('second', started_utc, completed_utc) END) AS decimal(10,1)) AS avg_duration_seconds
 FROM run JOIN connection USING (connection_id) WHERE NOT is_dry_run GROUP BY ALL)"""
SQL["daily_activity"] = f"{_with('run', 'connection')}, {_DAILY} SELECT * FROM daily"
SQL["daily_trend"] = f"""{_with("run", "connection")}, {_DAILY}, days AS (SELECT cast(unnest(generate_series(DATE '2001-07-05', DATE '2001-08-03', INTERVAL 1 DAY)) AS date) AS activity_date)
SELECT activity_date, cast(coalesce(sum(runs), 0) AS bigint) AS runs, cast(coalesce(sum(failed), 0) AS bigint) AS failed, cast(coalesce(sum(items_written), 0) AS bigint) AS items_written FROM days LEFT JOIN daily USING (activity_date) GROUP BY ALL"""
_IN = f"started_utc >= {NOW} - INTERVAL 720 HOUR AND NOT is_dry_run"
_SUM = lambda c: f"cast(coalesce(sum({c}) FILTER ({_IN}), 0) AS bigint)"
SQL["dashboard_tiles"] = f"""{_with(*_RCI)}, {_HEALTH},
r AS (SELECT count(*) FILTER (status = 1) AS runs_in_progress, {_SUM("items_written")} AS items_written_in_window, {_SUM("items_unchanged")} AS items_unchanged_in_window, {_SUM("items_deleted")} AS items_deleted_in_window,
 count(*) FILTER ({_IN} AND status IN (3, 4, 5)) AS failed_runs_in_window, count(*) FILTER ({_IN}) AS runs_in_window,
 cast(100 * {_SUM("items_unchanged")} / nullif({_SUM("items_written")} + {_SUM("items_unchanged")}, 0) AS decimal(5,1)) AS unchanged_percent_in_window FROM run)
SELECT (SELECT count(*) FROM connection WHERE is_enabled) AS connections_enabled, (SELECT count(*) FROM health WHERE health = 'healthy') AS connections_healthy,
 (SELECT count(*) FROM health WHERE health IN ('failing', 'late', 'items refused')) AS connections_needing_attention, r.*, (SELECT count(*) FROM item WHERE state = 1) AS live_items,
 (SELECT count(*) FROM item WHERE state = 2) AS pending_deletes, (SELECT count(*) FROM item WHERE state = 3) AS tombstones FROM r"""
SQL["list_runs"] = f"""{_with("run", "connection")}, {_HISTORY}, f AS (SELECT * FROM history WHERE status = 'succeeded' AND NOT is_dry_run AND started_utc >= TIMESTAMP '2000-01-01' AND started_utc < TIMESTAMP '2001-01-01')
SELECT run_id, started_utc, (SELECT count(*) FROM f) AS total_rows FROM f ORDER BY started_utc DESC, run_id DESC LIMIT 25 OFFSET 25"""
SQL["list_items"] = f"""{_with("item")}, f AS (SELECT * FROM item WHERE item_id LIKE 'doc1%' AND state = 1 AND unchanged_streak >= 5)
SELECT connection_id, item_id, unchanged_streak, (SELECT count(*) FROM f) AS total_rows FROM f ORDER BY connection_id, item_id LIMIT 40"""
SQL["list_pending_deletes"] = f"""{_with(*_RCI)}, {_PENDING}, f AS (SELECT * FROM pending WHERE age_minutes >= 1000) SELECT item_id, age_minutes, (SELECT count(*) FROM f) AS total_rows
 FROM f ORDER BY age_minutes DESC, connection_id, item_id LIMIT 10"""
SQL["list_throttle_events"] = f"""{_with("throttle_event")}, f AS (SELECT * FROM throttle_event WHERE run_id = 7) SELECT throttle_event_id, occurred_utc, (SELECT count(*) FROM f) AS total_rows FROM f ORDER BY occurred_utc, throttle_event_id LIMIT 50"""
SQL["newest_runs"] = f"{_with('run', 'connection')}, {_HISTORY} SELECT run_id, status, started_utc FROM history ORDER BY started_utc DESC, run_id DESC LIMIT 10"
SQL["item_mix"] = f"""{_with("item")} SELECT connection_id, item_type, count(*) AS items, count(*) FILTER (state = 1) AS live, count(*) FILTER (state = 2) AS pending_delete, count(*) FILTER (state = 3) AS tombstoned,
 cast(sum(content_bytes) AS bigint) AS content_bytes, cast(sum(unchanged_streak) / count(*) AS decimal(14,5)) AS avg_unchanged_streak, max(unchanged_streak) AS max_unchanged_streak FROM item GROUP BY ALL"""
_RANK = "coalesce(list_position(['failing', 'items refused', 'late', 'deletes pending', 'never run', 'running', 'healthy'], health), 8)"
SQL["health_counts"] = f"{_with(*_RCI)}, {_HEALTH} SELECT health, count(*) AS connections, min({_RANK}) AS rank FROM health GROUP BY health"
SQL["alerts"] = f"""{_with(*_RCI)}, {_HEALTH}, h AS (SELECT *, coalesce(expected_interval_minutes > 0, false) AS has, minutes_since_last_success AS m FROM health WHERE is_enabled)
SELECT connection_id, 'NoExpectedInterval' AS condition, 'ticket' AS severity, false AS transient FROM h WHERE NOT has
UNION ALL SELECT connection_id, 'NeverSucceeded', CASE WHEN live_item_count > 0 THEN 'page' ELSE 'ticket' END, false FROM h WHERE m IS NULL
UNION ALL SELECT connection_id, 'Stale', 'page', false FROM h WHERE m > CASE WHEN has THEN greatest(3 * expected_interval_minutes, 60) ELSE 1440 END
UNION ALL SELECT connection_id, 'Failing', CASE WHEN consecutive_failures >= 3 THEN 'page' ELSE 'ticket' END, false FROM h WHERE consecutive_failures > 0
UNION ALL SELECT connection_id, 'ItemsRefused', 'ticket', true FROM h WHERE health = 'items refused' OR last_run_status = 'partial'
UNION ALL SELECT connection_id, 'DeletesPending', 'ticket', true FROM h WHERE pending_delete_count > 0"""
SQL["stuck_deletes"] = f"{_with(*_RCI)}, {_PENDING} SELECT connection_id, item_type, count(*) AS items, max(age_minutes) AS max_age_minutes FROM pending WHERE age_minutes > 1000 GROUP BY ALL"
SQL["deletion_rate"] = f"""{_with("item")}, l AS (SELECT count(*) FILTER (state = 1) AS live FROM item), g AS (SELECT cast(deleted_utc AS date) AS day, count(*) AS deleted FROM item WHERE deleted_utc IS NOT NULL GROUP BY ALL)
SELECT day, deleted, live, cast(cast(100 AS decimal(4,1)) * deleted / live AS decimal(9,2)) AS percent_of_live FROM g, l ORDER BY percent_of_live DESC, day LIMIT 30"""
SQL["sweep_forensics"] = f"{_with('item')} SELECT connection_id, item_type, count(*) AS missing, min(item_id) AS first_id FROM item WHERE state = 1 AND last_seen_run < 100 GROUP BY ALL"
SQL["principal_policy"] = f"""{_with("connection", "principal")} SELECT connection_id, display_name, count(source_key) AS cached, count(source_key) FILTER (object_id IS NULL) AS absences, count(source_key) FILTER (expires_utc <= {NOW}) AS expired,
 cast(coalesce(sum(hit_count), 0) AS bigint) AS hits FROM connection LEFT JOIN principal USING (connection_id) GROUP BY connection_id, display_name"""
SQL["schedule_budget"] = f"""{_with("connection")} SELECT cast(sum(coalesce(expected_interval_minutes, 60)) AS bigint) AS minutes, 4 AS max_writers, 4 * count(*) AS all_writers,
 sum(coalesce(expected_interval_minutes, 60)) <= 100000 AS fits FROM connection"""
_SKETCH = """
b AS (SELECT *, CASE WHEN v <= 1 THEN 0 ELSE least((length(bin(v)) - 1) * 4 + ((v - (1::bigint << (length(bin(v)) - 1))) * 4) // (1::bigint << (length(bin(v)) - 1)), 191) END AS bucket FROM s),
h AS (SELECT k1, k2, bucket, count(*) AS n, sum(v) AS total, max(v) AS top, count(*) FILTER (v > 0) AS non_zero FROM b GROUP BY ALL),
w AS (SELECT *, sum(n) OVER g AS cnt, max(top) OVER g AS mx, sum(n) OVER (PARTITION BY k1, k2 ORDER BY bucket) AS upto, 1::bigint << (bucket // 4) AS low FROM h WINDOW g AS (PARTITION BY k1, k2)),
x AS (SELECT *, CASE WHEN bucket = 0 THEN 0 WHEN low // 4 = 0 THEN low ELSE low + (bucket % 4) * (low // 4) END AS lo, CASE WHEN bucket = 0 THEN 2 WHEN low // 4 = 0 THEN 1 ELSE low // 4 END AS width FROM w),
p AS (SELECT k1, k2, max(cnt) AS sample_count, sum(total) AS total, max(mx) AS max, sum(non_zero) AS non_zero, """ + ", ".join(
    f"max(CASE WHEN upto >= greatest(ceil({f} * cnt), 1) AND upto - n < greatest(ceil({f} * cnt), 1) THEN least(lo + cast(floor(width * ((greatest(ceil({f} * cnt), 1) - (upto - n)) / n)) AS bigint), mx) END) AS p{round(f * 100)}" for f in (0.5, 0.95, 0.99)
) + " FROM x GROUP BY k1, k2)"
SQL["timing_percentiles"] = f"""WITH s AS (SELECT event_type AS k1, 0 AS k2, cast(trunc(value * 1000) AS bigint) AS v FROM events), {_SKETCH}
SELECT k1 AS event_type, cast(sample_count AS bigint) AS sample_count, cast(total AS bigint) AS total, max, cast(non_zero AS bigint) AS non_zero, p50, p95, p99 FROM p"""
_MS = lambda c: f"cast({c} / 1000 AS decimal(18,1)) AS {c}_ms"
SQL["phase_shares"] = f"""WITH s AS (SELECT event_id % 5 AS k1, CASE WHEN event_type = 'click' THEN 'row_total' ELSE event_type END AS k2, cast(trunc(value * 1000) AS bigint) AS v FROM events), {_SKETCH}
SELECT p.k1 AS run_id, p.k2 AS phase, cast(p.sample_count AS bigint) AS sample_count, {", ".join(_MS("p." + c).replace("AS p.", "AS ") for c in ("total", "p50", "p95", "p99", "max"))},
 cast(p.total * 100 / nullif(q.total, 0) AS decimal(9,1)) AS share_percent FROM p LEFT JOIN p q ON q.k1 = p.k1 AND q.k2 = 'row_total'"""
SQL["timing_verdict"] = """WITH s AS (SELECT event_id % 40 AS run_id, cast(trunc(value * 10) AS bigint) AS v FROM events), t AS (SELECT run_id, sum(v) AS whole, sum(CASE WHEN run_id % 3 = 0 THEN v * 0.5 ELSE 0 END) AS back,
 sum(CASE WHEN run_id % 2 = 0 THEN v * 0.7 ELSE 0 END) AS fly FROM s GROUP BY run_id) SELECT run_id, CASE WHEN trunc(back) * 100 / whole >= 40 THEN 'throttle-bound' WHEN trunc(fly) / whole >= 0.5 THEN 'latency-bound' ELSE 'neither' END AS verdict FROM t"""

_IDX = """,
ix AS (SELECT item_id, last_written_utc - INTERVAL 1 SECOND * (content_bytes % 5) AS lm FROM item WHERE content_bytes % 9 <> 0),
src AS (SELECT item_id, last_written_utc AS lm, state = 3 AS gone FROM item WHERE content_bytes % 11 <> 0)"""
SQL["source_index"] = f"""{_with("item")}{_IDX} SELECT s.item_id, CASE WHEN gone AND x.item_id IS NOT NULL THEN 'ORPHAN' WHEN gone THEN 'OK' WHEN x.item_id IS NULL THEN 'MISSING' WHEN s.lm > x.lm + INTERVAL 2 SECOND THEN 'STALE' ELSE 'OK' END AS verdict
 FROM src s LEFT JOIN ix x ON x.item_id = s.item_id UNION ALL SELECT item_id, 'INVENTORY-ONLY' FROM item WHERE state = 1 AND content_bytes % 11 = 0"""
SQL["inventory_index"] = f"""{_with("item")}{_IDX} SELECT i.item_id, CASE WHEN state = 1 AND x.item_id IS NULL THEN 'LOST' WHEN state <> 1 AND x.item_id IS NOT NULL THEN 'ORPHAN' ELSE 'OK' END AS verdict FROM item i LEFT JOIN ix x ON x.item_id = i.item_id"""
SQL["source_inventory"] = f"""{_with("item")} SELECT item_id, CASE WHEN content_bytes % 3 = 0 THEN 'NEVER-WRITTEN' ELSE 'RESURRECTED' END AS verdict FROM item WHERE content_bytes % 11 <> 0 AND (content_bytes % 3 = 0 OR state <> 1)"""
SQL["view_parity"] = f"""{_with("item")} SELECT item_id, CASE WHEN content_bytes % 8 = 0 THEN 'only in second' WHEN content_bytes % 12 = 0 THEN 'only in first' ELSE 'differs' END AS verdict FROM item
 WHERE (content_bytes % 8 = 0) <> (content_bytes % 12 = 0) OR (content_bytes % 8 <> 0 AND content_bytes % 12 <> 0 AND content_bytes % 5 = 0)"""


def _mark(cap: int) -> str:
    before, after = TRUNCATION_MARK.format(cap=cap, size="\x00").split("\x00")
    q = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    return f"{q(before)} || strlen(text) || {q(after)}"


SQL["truncate_utf8"] = f"""WITH m AS (SELECT doc_id, text, {_mark(1024)} AS mark FROM documents),
k AS (SELECT *, 1024 - strlen(mark) AS room FROM m), n AS (SELECT *, CASE WHEN strlen(text) <= 1024 THEN 0 ELSE (SELECT max(i) FROM range(greatest(room - 700, 0), room + 1) r(i) WHERE strlen(substr(text, 1, i)) <= room) END AS lo FROM k)
, o AS (SELECT *, CASE WHEN strlen(text) <= 1024 THEN text ELSE substr(text, 1, lo) || mark END AS content FROM n)
SELECT doc_id, content, strlen(text) AS original_bytes, strlen(content) AS final_bytes, strlen(text) > 1024 AS truncated FROM o"""
SQL["strip_markup"] = r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script\b[^>]*>.*?</script>', ' ', 'g'), '(?is)<style\b[^>]*>.*?</style>', ' ', 'g'), '(?s)<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS prose FROM pages"""


# Written by hand, not from the implementation: each pattern with what stands in its place.
_SECRETS = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
 '(?i)-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*?-----END [A-Z ]*PRIVATE KEY-----', '[private key [redacted]]', 'g'),
 '(?i)eyJ[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]{5,}\.[A-Za-z0-9_\-]*', '[token [redacted]]', 'g'),
 '(?i)\bBearer\s+[A-Za-z0-9._~+/\-]+=*', 'Bearer [token [redacted]]', 'g'),
 '(?i)([A-Za-z][A-Za-z0-9 _.]{1,40}=[^;]{0,200};\s*){2,}', '[connection string [redacted]] ', 'g'),
 '(?i)\b(password|pwd|user\s*id|uid|client[_\s]?secret|access[_\s]?token|api[_\s]?key|secret)\s*=\s*[^;,\s"]*', '\1=[redacted]', 'g')"""
SQL["scrub_secrets"] = rf"""SELECT doc_id, sha256({_SECRETS}) AS scrubbed_sha256, regexp_matches(text, '(?i)-----BEGIN [A-Z ]*PRIVATE KEY-----[\s\S]*-----END [A-Z ]*PRIVATE KEY-----')
 OR regexp_matches(text, '(?i)eyJ[A-Za-z0-9_\-]{{5,}}\.[A-Za-z0-9_\-]{{5,}}\.') OR regexp_matches(text, '(?i)\bBearer\s+[A-Za-z0-9._~+/\-]')
 OR regexp_matches(text, '(?i)([A-Za-z][A-Za-z0-9 _.]{{1,40}}=[^;]{{0,200}};\s*){{2}}')
 OR regexp_matches(text, '(?i)\b(password|pwd|user\s*id|uid|client[_\s]?secret|access[_\s]?token|api[_\s]?key|secret)\s*=') AS had_secret FROM documents"""
_N = "(n_chars * 977)"
SQL["formats"] = f"""SELECT doc_id, CASE WHEN {_N} < 1000 THEN cast({_N} AS varchar) WHEN {_N} < 1000000 THEN printf('%.1fk', round({_N} / 1e3, 1)) WHEN {_N} < 1000000000 THEN printf('%.1fM', round({_N} / 1e6, 1)) ELSE printf('%.1fB', round({_N} / 1e9, 1)) END AS count_word,
 CASE WHEN {_N} < 1024 THEN {_N} || ' B' WHEN {_N} < 1048576 THEN printf('%.1f KB', round({_N} / 1024.0::double, 1)) WHEN {_N} < 1073741824 THEN printf('%.1f MB', round({_N} / 1048576.0::double, 1)) ELSE printf('%.1f GB', round({_N} / 1073741824.0::double, 1)) END AS bytes_word,
 CASE WHEN n_chars < 60 THEN n_chars || 's' WHEN n_chars < 3600 THEN n_chars // 60 || 'm ' || n_chars % 60 || 's' ELSE n_chars // 3600 || 'h ' || n_chars // 60 % 60 || 'm' END AS duration_word,
 CASE WHEN n_chars < 60 THEN n_chars || 'm' WHEN n_chars < 1440 THEN n_chars // 60 || 'h' ELSE n_chars // 1440 || 'd' END AS age_word FROM documents"""
SQL["sensitivity"] = """SELECT doc_id, CASE WHEN toxic = 1 THEN 'Closed' WHEN quality = 0 THEN 'Low' WHEN quality = 1 THEN 'Open' END AS label, toxic IS NULL OR toxic = 1 AS refused,
 CASE WHEN toxic IS NULL THEN 'unlabelled' WHEN toxic = 1 THEN 'label not indexable' END AS why FROM documents LEFT JOIN labels USING (doc_id)"""
SQL["posix_read_groups"] = """WITH m AS (SELECT doc_id, source, doc_id % 8 AS g, doc_id // 8 % 8 AS o, doc_id % 3 AS k FROM documents)
SELECT doc_id, CASE WHEN g & 4 = 0 THEN '' WHEN k = 0 THEN source || ',audit' WHEN k = 1 THEN '' ELSE source END AS readers,
 CASE WHEN g & 1 = 0 THEN '' WHEN k = 0 THEN source WHEN k = 1 THEN 'ops' ELSE source END AS traversers, o & 4 <> 0 AS world FROM m"""
_AFTER = "(last_modified > TIMESTAMP '2000-01-01' OR (last_modified = TIMESTAMP '2000-01-01' AND engagement_id > 10))"
SQL["soft_delete_scan"] = f"{_with('engagements')} SELECT engagement_id, last_modified FROM engagements WHERE NOT is_deleted AND {_AFTER}"
SQL["soft_delete_changes"] = f"{_with('engagements')} SELECT engagement_id, last_modified, is_deleted AS is_delete FROM engagements WHERE {_AFTER}"

_TABLES = """SELECT DISTINCT 'db' || doc_id % 7 AS database, lang || doc_id % 40 AS "table" FROM documents"""
_GRANTED = """list_sort(list_filter([CASE WHEN database = 'db1' THEN 'analysts' END, CASE WHEN "table" LIKE 'en%' THEN 'english' END, CASE WHEN database = 'db4' AND "table" LIKE 'es%' THEN 'spain' END,
  CASE WHEN database = 'db5' THEN 'readers' END, CASE WHEN database = 'db6' AND "table" LIKE 'fr%' THEN 'fr' END, CASE WHEN database = 'db0' AND "table" NOT LIKE 'en%' THEN 'rest' END], lambda x: x IS NOT NULL))"""
_ROUTED = """SELECT database, "table", CASE WHEN reason IS NULL THEN 'index' ELSE 'live query' END AS verdict, reason, CASE WHEN reason IS NULL THEN array_to_string(groups, ',') ELSE '' END AS groups FROM r"""
SQL["route_tables"] = f"""WITH t AS ({_TABLES}), g AS (SELECT *, {_GRANTED} AS groups FROM t),
r AS (SELECT *, CASE WHEN database = 'db2' AND "table" = 'fr1' THEN 'row filter' WHEN database = 'db3' AND "table" LIKE 'de2%' THEN 'mask' WHEN database = 'db4' AND "table" LIKE 'es%' THEN 'deny'
  WHEN database = 'db5' THEN 'column grant' WHEN len(groups) = 0 THEN 'no group' END AS reason FROM g) {_ROUTED}"""
SQL["route_catalogue"] = f"""WITH t AS ({_TABLES}), g AS (SELECT *, {_GRANTED} AS groups FROM t),
r AS (SELECT *, CASE WHEN database = 'db4' AND "table" LIKE 'es%' THEN 'deny' WHEN len(groups) = 0 THEN 'no group' END AS reason FROM g) {_ROUTED}"""
SQL["route_databases"] = """WITH t AS (SELECT DISTINCT 'db' || doc_id % 7 AS database FROM documents)
SELECT database, CASE database WHEN 'db4' THEN 'live query' ELSE 'index' END AS verdict, CASE database WHEN 'db4' THEN 'deny' END AS reason,
 CASE database WHEN 'db0' THEN 'english,rest' WHEN 'db1' THEN 'analysts,english' WHEN 'db4' THEN '' WHEN 'db5' THEN 'english,readers' WHEN 'db6' THEN 'fr' ELSE 'english' END AS groups FROM t"""
SQL["route_paths"] = """SELECT '/data/' || source || '/' || lang || '/f' || doc_id AS path, CASE WHEN lang = 'fr' THEN 'live query' ELSE 'index' END AS verdict, CASE WHEN lang = 'fr' THEN 'deny' END AS reason,
 CASE WHEN lang = 'fr' THEN '' WHEN lang = 'en' AND doc_id < 10 THEN 'short,staff' ELSE 'staff' END AS groups FROM documents"""
SQL["describable_columns"] = f"""WITH t AS ({_TABLES}) SELECT database, "table", CASE WHEN database = 'db5' THEN 'id,name' END AS columns FROM t"""
SQL["unreadable_policies"] = """SELECT n_nationkey::BIGINT AS id, n_name AS name, CASE WHEN n_nationkey % 5 = 0 OR n_nationkey % 7 = 2 THEN 'refuse' ELSE 'warn' END AS effect FROM nation
WHERE n_nationkey % 6 <> 3 AND (n_nationkey % 5 = 0 OR n_nationkey % 7 = 2 OR n_nationkey % 4 = 1)"""
SQL["traverse_gates"] = """SELECT CASE WHEN doc_id % 2 = 1 THEN '/data/' || source || '/f' || doc_id ELSE '/open/f' || doc_id END AS path,
 CASE WHEN doc_id % 2 = 0 THEN NULL WHEN source LIKE '%1' THEN 'ops' ELSE 'ops,staff' END AS gate, doc_id % 2 = 0 AS everyone FROM documents"""

SQL["file_grants"] = """WITH m AS (SELECT doc_id AS i, source, doc_id % 8 & 4 <> 0 AS g, doc_id // 8 % 8 & 4 <> 0 AND doc_id % 5 <> 0 AS everyone FROM documents)
SELECT '/f' || i AS path, array_to_string(list_sort(list_filter([CASE WHEN g AND (i % 4 <> 0 OR source = 'src0') AND source NOT LIKE '%3' THEN 'o-' || source END, CASE WHEN g AND i % 3 = 0 THEN 'o-audit' END,
 CASE WHEN i % 7 = 0 THEN 'o-extra' END, CASE WHEN everyone THEN 'o-all' END], lambda x: x IS NOT NULL)), ',') AS acl FROM m"""
SQL["lineage_visible"] = """WITH down AS (SELECT n_nationkey AS a, (7 * n_nationkey + 3) % 25 AS b FROM nation UNION SELECT n_nationkey, (7 * ((n_nationkey + 1) % 25) + 3) % 25 FROM nation WHERE n_nationkey % 3 = 0),
links AS (SELECT a, 'downstream' AS direction, b FROM down WHERE a <> b UNION SELECT b, 'upstream', a FROM down WHERE a <> b)
SELECT 'd' || a AS guid, direction, string_agg(n_name, ',' ORDER BY n_name) AS names FROM links JOIN nation ON n_nationkey = b WHERE b % 5 = 0 OR (a % 5 <> 0 AND a % 2 = b % 2) GROUP BY a, direction"""
SQL["item_state"] = f"{_with('item')} SELECT connection_id, item_id, content_hash, acl_hash FROM item WHERE state = 1 AND cast(substr(item_id, 4) AS bigint) % 3 = 0"
SQL["register_connections"] = f"""{_with('connection')} SELECT connection_id, CASE WHEN is_enabled THEN lower(display_name) ELSE display_name END AS display_name, is_enabled FROM connection
UNION ALL SELECT 'conn99', display_name, is_enabled FROM connection WHERE connection_id = 'conn3'"""
SQL["finish_run"] = f"""{_with('run')} SELECT run_id, CASE run_id WHEN 970 THEN 5 ELSE status END AS status, CASE run_id WHEN 970 THEN TIMESTAMP '2001-08-03 00:00:00' ELSE completed_utc END AS completed_utc,
 CASE run_id WHEN 970 THEN 7 ELSE items_written END AS items_written, CASE run_id WHEN 970 THEN 2 ELSE items_failed END AS items_failed FROM run"""
SQL["replace_run_rows"] = f"""{_with('throttle_event')}, again AS (SELECT run_id, throttle_event_id FROM throttle_event WHERE run_id < 5 AND throttle_event_id % 2 = 0)
SELECT run_id, throttle_event_id, status_code FROM throttle_event WHERE run_id NOT IN (SELECT run_id FROM again) UNION ALL SELECT run_id, throttle_event_id, 0 FROM again"""
SQL["purged_items"] = f"{_with('item')} SELECT connection_id, item_id, state FROM item WHERE NOT (state = 3 AND deleted_utc < TIMESTAMP '2001-07-04 00:00:00')"
SQL["incremental_items"] = f"""{_with(*_H)}{_LIVE}{_ELM}, i AS (SELECT 'cust' || customer_id AS item_id, 'Customer' AS item_type, em FROM ce WHERE NOT is_deleted
UNION ALL SELECT 'eng' || ee.engagement_id, 'Engagement', ee.em FROM ee JOIN c ON c.customer_id = ee.customer_id WHERE NOT ee.is_deleted
UNION ALL SELECT 'time' || te.entry_id, 'TimeEntry', te.em FROM te JOIN e ON e.engagement_id = te.engagement_id JOIN c ON c.customer_id = e.customer_id WHERE NOT te.is_deleted)
SELECT item_id, item_type, em AS effective_modified FROM i WHERE em > TIMESTAMP '2000-06-01' OR (em = TIMESTAMP '2000-06-01' AND item_id > 'eng')"""
SQL["hash_version_due"] = f"""{_with('connection')} SELECT connection_id, CASE WHEN negative_ttl_minutes = 30 OR length(display_name) % 2 = 1 THEN 1 ELSE 0 END AS previous_version, 1 AS current_version,
 negative_ttl_minutes <> 30 AND length(display_name) % 2 = 0 AS changed FROM connection"""
SQL["begin_run"] = f"""{_with('run', 'checkpoint')} SELECT run_id, mode, CASE status WHEN 1 THEN 4 ELSE status END AS status, CASE status WHEN 1 THEN {NOW} ELSE completed_utc END AS completed_utc, items_written FROM run WHERE connection_id = 'conn4'
UNION ALL SELECT 1000000000, CASE WHEN EXISTS (SELECT 1 FROM run WHERE connection_id = 'conn4' AND status = 2 AND mode = 1 AND NOT is_dry_run AND completed_utc >= {NOW} - INTERVAL 7 DAY)
 AND EXISTS (SELECT 1 FROM checkpoint WHERE connection_id = 'conn4') THEN 2 ELSE 1 END, 1, NULL, 0"""
SQL["heartbeat"] = f"{_with('run')} SELECT run_id, CASE WHEN run_id = 97 THEN greatest(heartbeat_utc, {NOW}) ELSE heartbeat_utc END AS heartbeat_utc FROM run"
SQL["full_run"] = f"""{_with('item')}, i AS (SELECT *, content_bytes % 9 <> 0 AS here, state = 1 AND (content_bytes % 7 <> 0 OR upper(content_hash) = content_hash) AS same FROM item WHERE connection_id = 'conn3')
SELECT item_id, CASE WHEN here THEN 1 ELSE 3 END AS state, first_seen_run, CASE WHEN here THEN 1000000000 ELSE last_seen_run END AS last_seen_run,
 CASE WHEN here AND same THEN unchanged_streak + 1 WHEN here THEN 0 ELSE unchanged_streak END AS unchanged_streak, cast(NULL AS timestamp) AS pending_since_utc,
 CASE WHEN here THEN NULL WHEN state = 3 THEN deleted_utc ELSE {NOW} END AS deleted_utc FROM i"""
SQL["inventory_index_errors"] = f"""{_with("item")}{_IDX} SELECT i.item_id, CASE WHEN content_bytes % 10 = 3 THEN 'ERROR' WHEN state = 1 AND x.item_id IS NULL THEN 'LOST' WHEN state <> 1 AND x.item_id IS NOT NULL THEN 'ORPHAN' ELSE 'OK' END AS verdict
 FROM item i LEFT JOIN ix x ON x.item_id = i.item_id"""
SQL["missing_items_sample"] = f"{_with('item')} SELECT connection_id, item_type, item_id, last_seen_run FROM item WHERE state = 1 AND last_seen_run < 100 ORDER BY connection_id, item_id LIMIT 10"
SQL["table_counts"] = "SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem"
SQL["recent_activity"] = f"{_with('run', 'connection')}, {_DAILY} SELECT * FROM daily WHERE activity_date >= DATE '2001-07-04'"
SQL["route_many_tables"] = f"""WITH t AS ({_TABLES}), p AS (SELECT p_partkey AS id, p_partkey % 6 AS k, p_partkey // 6 % 5 AS j FROM part WHERE p_partkey % 17 <> 4),
v AS (SELECT id, k, j, CASE k WHEN 0 THEN 'db' || id % 7 WHEN 1 THEN 'db%' WHEN 2 THEN '%' || id % 7 WHEN 3 THEN 'd_' || id % 7 WHEN 4 THEN 'db' || id % 7 ELSE '%' END AS base,
 CASE j WHEN 0 THEN 'en' || id % 40 WHEN 1 THEN 'fr' || id % 4 || '%' WHEN 2 THEN '%' || id % 10 WHEN 3 THEN '%e%1%' ELSE '%' END AS name, CASE WHEN k = 0 AND j = 0 THEN id % 3 ELSE 0 END AS kind FROM p),
m AS (SELECT database, "table", v.* FROM t JOIN v ON (lower(database) LIKE base) <> (k = 4) AND lower("table") LIKE name),
back AS (SELECT DISTINCT database, "table", 'g' || id % 50 AS g FROM m WHERE id % 31 = 3 AND kind = 0),
given AS (SELECT DISTINCT database, "table", unnest(['g' || id % 50, 'h' || id % 3]) AS g FROM m WHERE kind = 0),
sole AS (SELECT database, "table", id, unnest(['g' || id % 50, 'h' || id % 3]) AS g FROM m WHERE kind = 0 AND id % 211 = 5 AND k = 0),
kept AS (SELECT * FROM given WHERE NOT EXISTS (SELECT 1 FROM back b WHERE b.database = given.database AND b."table" = given."table" AND b.g = given.g)
 AND (SELECT count(DISTINCT id) FROM sole s WHERE s.database = given.database AND s."table" = given."table")
   = (SELECT count(DISTINCT id) FROM sole s WHERE s.database = given.database AND s."table" = given."table" AND s.g = given.g AND (s.g NOT LIKE 'g%' OR s.id % 31 <> 3))),
f AS (SELECT database, "table", bool_or(kind = 2) AS filtered, bool_or(kind = 1) AS masked, bool_or(k = 0 AND id % 4 = 1) AS denied FROM m GROUP BY ALL),
l AS (SELECT database, "table", string_agg(g, ',' ORDER BY g) AS groups FROM kept GROUP BY ALL),
r AS (SELECT t.*, CASE WHEN filtered THEN 'row filter' WHEN masked THEN 'mask' WHEN denied THEN 'deny' WHEN groups IS NULL THEN 'no group' END AS reason, groups FROM t LEFT JOIN f USING (database, "table") LEFT JOIN l USING (database, "table"))
SELECT database, "table", CASE WHEN reason IS NULL THEN 'index' ELSE 'live query' END AS verdict, reason, CASE WHEN reason IS NULL THEN groups ELSE '' END AS groups FROM r"""
SQL["route_many_paths"] = """WITH t AS (SELECT '/data/' || source || '/' || lang || '/f' || doc_id AS path FROM documents), p AS (SELECT s_suppkey AS s, s_suppkey % 5 AS k, ['en', 'fr', 'de', 'es'][s_suppkey % 4 + 1] AS lang FROM supplier),
v AS (SELECT s, k, CASE k WHEN 1 THEN '/data/[^/]*/' || lang WHEN 2 THEN '/data/src' || s % 20 || '/en/f[^/]' WHEN 3 THEN '/data/src[^/]/' || lang || '/f1[^/]*' ELSE '/data/src' || s % 20 END AS body, k = 4 AND s % 7 < 2 AS but, s % 13 = 0 AND k IN (1, 2) AS deny FROM p),
m AS (SELECT path, s, deny, regexp_full_match(path, body || CASE WHEN k IN (0, 4) THEN '(/.*)?' ELSE '' END) <> but AS grants, deny AND regexp_full_match(path, body || '(/.*)?') AS denies FROM t, v),
a AS (SELECT path, bool_or(denies) AS denied, string_agg(DISTINCT 'g' || s % 30, ',' ORDER BY 'g' || s % 30) FILTER (grants) AS groups FROM m GROUP BY path)
SELECT path, CASE WHEN denied THEN 'live query' ELSE 'index' END AS verdict, CASE WHEN denied THEN 'deny' END AS reason, CASE WHEN denied THEN '' ELSE coalesce(groups, '') END AS groups FROM a"""
SQL["full_run_guarded"] = f"""{_with("item")}, lost AS (SELECT * FROM (VALUES ('conn3', 3), ('conn4', 60), ('conn6', 8)) v(connection_id, k)),
i AS (SELECT item.*, content_bytes % k <> 0 AS here, state = 1 AND (content_bytes % 7 <> 0 OR upper(content_hash) = content_hash) AS same FROM item JOIN lost USING (connection_id)),
n AS (SELECT connection_id, count(*) FILTER (here AND NOT same) AS items_written, count(*) FILTER (here AND same) AS items_unchanged, count(*) FILTER (NOT here AND state IN (1, 2)) AS items_deleted,
 count(*) FILTER (NOT here AND state = 1) * 100 > 10 * count(*) FILTER (here OR state = 1) AS refused FROM i GROUP BY connection_id)
SELECT connection_id, item_id, CASE WHEN refused THEN state WHEN here THEN 1 ELSE 3 END AS state, CASE WHEN here AND NOT refused THEN 1000000000 ELSE last_seen_run END AS last_seen_run,
 CASE WHEN refused THEN unchanged_streak WHEN here AND same THEN unchanged_streak + 1 WHEN here THEN 0 ELSE unchanged_streak END AS unchanged_streak,
 CASE WHEN NOT refused THEN items_written END AS items_written, CASE WHEN NOT refused THEN items_unchanged END AS items_unchanged, CASE WHEN NOT refused THEN items_deleted END AS items_deleted FROM i JOIN n USING (connection_id)"""
SQL["seek_runs"] = f"""{_with('run', 'connection')}, {_HISTORY} SELECT run_id, started_utc, completed_utc, cast((row_number() OVER (ORDER BY completed_utc DESC NULLS LAST, run_id) - 1) // 400 + 1 AS int) AS page
 FROM history WHERE connection_id IN ('conn3', 'conn8')"""
SQL["resume_items"] = f"""{_with(*_H)}{_LIVE}{_ELM}, i AS (SELECT 'cust' || ce.customer_id AS item_id, 'Customer' AS item_type, 1 AS level, em, ce.customer_id AS id, coalesce(n, 0) AS child_count FROM ce LEFT JOIN per_customer p ON p.customer_id = ce.customer_id WHERE NOT is_deleted
UNION ALL SELECT 'eng' || ee.engagement_id, 'Engagement', 2, ee.em, ee.engagement_id, coalesce(n, 0) FROM ee JOIN c ON c.customer_id = ee.customer_id LEFT JOIN per_engagement p ON p.engagement_id = ee.engagement_id WHERE NOT ee.is_deleted
UNION ALL SELECT 'time' || te.entry_id, 'TimeEntry', 3, te.em, te.entry_id, 0 FROM te JOIN e ON e.engagement_id = te.engagement_id JOIN c ON c.customer_id = e.customer_id WHERE NOT te.is_deleted)
SELECT item_id, item_type, level, em AS effective_modified, CASE WHEN em < TIMESTAMP '2000-09-01' THEN em END AS marker, cast(child_count AS int) AS child_count FROM i
WHERE (em, level, id) > (TIMESTAMP '2000-06-01', 2, 3000)"""


def _cut_at(text: str, cap: str) -> str:
    """A text cut to a cap of bytes, with its mark, as a scalar expression over columns."""
    before, middle, after = TRUNCATION_MARK.format(cap="\x00", size="\x00").split("\x00")
    q = lambda s: "'" + s.replace("\n", "' || chr(10) || '") + "'"
    mark = f"({q(before)} || {cap} || {q(middle)} || strlen({text}) || {q(after)})"
    room = f"greatest({cap} - strlen({mark}), 0)"
    return f"CASE WHEN strlen({text}) <= {cap} THEN {text} ELSE substr({text}, 1, (SELECT max(i) FROM range(greatest({room} // 4, 0), {room} + 1) r(i) WHERE strlen(substr({text}, 1, i)) <= {room})) || {mark} END"


SQL["fitted_items"] = f"""WITH d AS (SELECT 'doc' || doc_id AS item_id, repeat(source, CASE WHEN doc_id % 5 = 0 THEN doc_id % 400 ELSE 1 END) AS owner, text AS content FROM documents),
a AS (SELECT *, {_cut_at("content", "1200")} AS c1 FROM d), b AS (SELECT *, strlen(to_json({{'item_id': item_id, 'owner': owner, 'content': c1}})::varchar) AS s1 FROM a),
g AS (SELECT *, s1 > 1440 AS over, strlen(c1) - (s1 - 1440) AS budget FROM b), h AS (SELECT *, CASE WHEN NOT over THEN c1 WHEN budget > 0 THEN {_cut_at("c1", "budget")} END AS c2 FROM g),
z AS (SELECT *, strlen(to_json({{'item_id': item_id, 'owner': owner, 'content': c2}})::varchar) AS s2 FROM h), w AS (SELECT *, CASE WHEN c2 IS NULL THEN 'no room for content' WHEN s2 > 1500 THEN 'too large' END AS skipped FROM z)
SELECT item_id, CASE WHEN skipped IS NULL THEN c2 END AS content, strlen(content) AS original_bytes, CASE WHEN skipped IS NULL THEN strlen(c2) END AS final_bytes, strlen(content) > 1200 OR over AS truncated, CASE WHEN c2 IS NOT NULL THEN s2 END AS item_bytes, skipped FROM w"""
SQL["cascade_probes"] = f"""{_with(*_H)}{_ELM},
pc AS (SELECT customer_id AS id, count(*) AS n, min(engagement_id) AS child FROM ee JOIN ce USING (customer_id) WHERE ce.em < {NOW} GROUP BY ALL ORDER BY n, id LIMIT 1),
pe AS (SELECT engagement_id AS id, count(*) AS n, min(entry_id) AS child, arg_min(te.em, entry_id) < {NOW} AS past FROM te JOIN ee USING (engagement_id) WHERE ee.em < {NOW} GROUP BY ALL ORDER BY n, id LIMIT 1),
pt AS (SELECT min(entry_id) AS id FROM te WHERE em < {NOW}),
v AS (SELECT * FROM (VALUES ('sound', true, true, true), ('alone', true, false, false), ('one level', true, true, false), ('children only', false, true, true), ('backwards', false, false, false)) x(variant, own, child, below)),
k AS (SELECT (SELECT n FROM pc) AS children, (SELECT count(*) FROM te JOIN ee USING (engagement_id) WHERE customer_id = (SELECT id FROM pc) AND te.em < {NOW}) AS grandchildren),
r AS (SELECT variant, 'update of a customer reaches its engagement' AS "check", id, first AS child_id, own AS own_moved, v.child AS child_moved, NULL::BIGINT AS stale, own AND v.child AS fine FROM v, (SELECT id, child FROM pc) p(id, first)
UNION ALL SELECT variant, 'update of a engagement reaches its entry', id, first, own, v.child AND past, NULL, own AND v.child AND past FROM v, (SELECT id, child, past FROM pe) p(id, first, past)
UNION ALL SELECT variant, 'update of a entry', id, NULL, own, NULL, NULL, own FROM v, pt
UNION ALL SELECT variant, 'no older child: engagement<customer', NULL, NULL, NULL, NULL, CASE WHEN own AND NOT child THEN children ELSE 0 END, NOT (own AND NOT child) FROM v, k
UNION ALL SELECT variant, 'no older child: entry<engagement', NULL, NULL, NULL, NULL, CASE WHEN child AND NOT below THEN grandchildren ELSE 0 END, NOT (child AND NOT below) OR grandchildren = 0 FROM v, k
UNION ALL SELECT variant, 'no older child: entry<customer', NULL, NULL, NULL, NULL, CASE WHEN own AND NOT below THEN grandchildren ELSE 0 END, NOT (own AND NOT below) OR grandchildren = 0 FROM v, k)
SELECT * EXCLUDE (fine), CASE WHEN fine THEN 'ok' ELSE 'fail' END AS verdict FROM r"""
_RESOLVED = f"""w AS (SELECT c_custkey AS k, 'conn' || c_nationkey AS connection_id, 'g' || c_custkey AS name FROM customer WHERE c_custkey % 23 <> 0),
a AS (SELECT w.connection_id, name, CASE WHEN k % 7 = 0 THEN 'run' WHEN k % 10 = 0 THEN 'map' WHEN p.source_key IS NOT NULL THEN 'store' ELSE 'directory' END AS provenance,
 CASE WHEN k % 7 = 0 THEN CASE WHEN k % 14 = 0 THEN 'run' || k END WHEN k % 10 = 0 THEN 'abcdef01-2345-6789-abcd-' || lpad(k::varchar, 12, '0') WHEN p.source_key IS NOT NULL THEN object_id WHEN k % 3 = 0 THEN 'dir' || k END AS object_id
 FROM w LEFT JOIN (SELECT * FROM principal WHERE expires_utc > {NOW}) p ON p.connection_id = w.connection_id AND p.source_key = w.name)"""
SQL["resolve_order"] = f"{_with('principal')}, {_RESOLVED} SELECT connection_id, name, object_id, provenance FROM a"
SQL["resolve_order_store"] = f"""{_with('principal', 'connection')}, {_RESOLVED}, n AS (SELECT a.*, CASE WHEN object_id IS NULL THEN greatest(least(720, coalesce(negative_ttl_minutes, 60)), 1) ELSE 720 END AS minutes FROM a LEFT JOIN connection USING (connection_id) WHERE provenance = 'directory')
SELECT connection_id, name AS source_key, object_id, {NOW} + INTERVAL 1 MINUTE * minutes AS expires_utc, 0 AS hit_count FROM n
UNION ALL SELECT connection_id, source_key, object_id, expires_utc, hit_count FROM principal WHERE (connection_id, source_key) NOT IN (SELECT (connection_id, name) FROM n)"""
SQL["bad_rows"] = """WITH r AS (SELECT doc_id AS i, n_chars, row_number() OVER () AS ordinal FROM documents), o AS (SELECT *, CASE WHEN i % 71 = 3 THEN 'skipped' WHEN i % 53 = 7 OR i % 61 = 9 THEN 'bad' ELSE 'mapped' END AS outcome FROM r)
SELECT ordinal, outcome, CASE WHEN outcome = 'bad' THEN CASE WHEN i % 53 = 7 THEN 'bytes: not a bigint' ELSE 'modified: not a timestamp' END END AS error, CASE WHEN outcome = 'mapped' THEN 'doc' || i END AS item_id,
 CASE WHEN outcome = 'mapped' THEN n_chars END AS bytes, CASE WHEN outcome = 'mapped' AND i % 4 <> 0 THEN TIMESTAMP '2001-02-03 04:05:06' END AS modified FROM o"""
SQL["stream_inventory"] = """WITH r AS (SELECT doc_id AS i, source, CASE WHEN doc_id % 3 = 0 THEN 2 WHEN doc_id % 2 = 0 THEN 1 ELSE 0 END AS last,
 doc_id % 2 = 0 AND doc_id % 5 = 1 AS one, doc_id % 3 = 0 AND (doc_id % 5 = 2) AS two, doc_id % 2 = 0 AS at1, doc_id % 3 = 0 AS at2 FROM documents),
b AS (SELECT *, one AS w1, at2 AND (two OR one) AS w2 FROM r)
SELECT 'conn' || i % 3 AS connection_id, 'doc' || i AS item_id, sha256(CASE WHEN at2 THEN CASE WHEN two THEN source || '2' ELSE source END WHEN one THEN source || '1' ELSE source END) AS content_hash, 0::BIGINT AS first_seen_run, last::BIGINT AS last_seen_run,
 CASE WHEN w2 THEN 2 WHEN w1 THEN 1 ELSE 0 END::BIGINT AS last_written_run, 1 AS state, CASE WHEN w2 THEN 0 ELSE (CASE WHEN at2 THEN 1 ELSE 0 END) + (CASE WHEN w1 THEN 0 WHEN at1 THEN 1 ELSE 0 END) END AS unchanged_streak FROM b"""
SQL["health_by_severity"] = f"""{_with(*_RCI)}, {_HEALTH} SELECT connection_id, display_name, health, cast(row_number() OVER (ORDER BY {_RANK}, display_name) AS int) AS place FROM health"""


def _measures(part: str, rel: str, name: str, numbers: str) -> str:
    return " UNION ALL ".join(f"SELECT '{part}' AS part, {name} AS name, '{n}' AS measure, cast({n} AS decimal(20,1)) AS value FROM {rel}" for n in numbers.split())


def _as(key: str) -> str:
    """Another query's SQL as a table expression of its own."""
    return f"({SQL[key]})"


SQL["run_detail"] = f"""WITH h AS (SELECT * FROM {_as("run_history")} WHERE run_id = 3), t AS (SELECT *, cast(cast(100 AS decimal(4,1)) * items_unchanged / nullif(items_written + items_unchanged, 0) AS decimal(5,1)) AS unchanged_percent FROM {_as("type_totals")} WHERE run_id = 3),
p AS (SELECT * FROM {_as("phase_shares")} WHERE run_id = 3), o AS (SELECT * FROM {_as("throttle_summary")} WHERE run_id = 3)
{_measures("run", "h", "run_id::varchar", "duration_seconds items_written items_unchanged items_deleted unchanged_percent items_per_second")}
UNION ALL {_measures("types", "t", "run_id || ' ' || item_type", "items_written items_unchanged items_deleted items_skipped items_failed items_duplicate bytes_written unchanged_percent")}
UNION ALL {_measures("phases", "p", "run_id || ' ' || phase", "sample_count total_ms p50_ms p95_ms p99_ms max_ms share_percent")}
UNION ALL {_measures("throttles", "o", "run_id || ' ' || connection_id", "throttle_events refusals_429 server_errors total_retry_after_seconds max_retry_after_seconds distinct_minutes deepest_retry")}"""
SQL["connection_detail"] = f"""{_with(*_RCI, "checkpoint")}, {_HEALTH}, {_DAILY}, h AS (SELECT * FROM health WHERE connection_id = 'conn4'), a AS (SELECT * FROM daily WHERE connection_id = 'conn4' AND activity_date >= DATE '2001-08-03' - 400), k AS (SELECT * FROM checkpoint WHERE connection_id = 'conn4'),
m AS (SELECT item_type, count(*) AS items, count(*) FILTER (state = 1) AS live, count(*) FILTER (state = 2) AS pending_delete, count(*) FILTER (state = 3) AS tombstoned, sum(content_bytes) AS content_bytes,
 cast(sum(unchanged_streak) / count(*) AS decimal(14,5)) AS avg_unchanged_streak, max(unchanged_streak) AS max_unchanged_streak FROM item WHERE connection_id = 'conn4' GROUP BY item_type)
{_measures("health", "h", "connection_id || ' ' || health", "expected_interval_minutes last_run_id minutes_since_last_success consecutive_failures last_success_items_written last_success_items_unchanged last_success_items_deleted live_item_count pending_delete_count")}
UNION ALL {_measures("mix", "m", "item_type", "items live pending_delete tombstoned content_bytes avg_unchanged_streak max_unchanged_streak")}
UNION ALL {_measures("activity", "a", "activity_date::varchar", "runs succeeded failed items_written items_unchanged items_deleted unchanged_percent avg_duration_seconds")}
UNION ALL {_measures("checkpoint", "k", "connection_id || ' ' || marker_key", "run_id run_count")}"""
SQL["dangerous_tag_policies"] = "SELECT n_nationkey::BIGINT AS id, n_name AS name FROM nation WHERE n_nationkey % 5 <> 3 AND (n_nationkey % 4 = 0 OR n_nationkey % 6 = 1 OR n_nationkey % 7 = 2)"
SQL["record_throttles"] = f"""{_with("throttle_event")} SELECT * FROM throttle_event UNION ALL SELECT -event_id, 12, 429, NULL, 'item', CASE WHEN event_id % 3 = 0 THEN 7 ELSE 1 END, CASE WHEN event_id % 2 = 0 THEN ts ELSE {NOW} END FROM events WHERE event_type = 'error'"""
SQL["planned_modes"] = f"""{_with("connection")}, f AS (SELECT * FROM {_as("full_due")} WHERE connection_id <> 'conn7')
SELECT c.connection_id, CASE WHEN negative_ttl_minutes = 60 AND full_due IS NOT NULL AND NOT full_due THEN 2 ELSE 1 END AS mode FROM connection c LEFT JOIN f ON f.connection_id = c.connection_id"""
_PAIR = lambda name, value: f"CASE WHEN {value} IS NULL THEN ''::BLOB ELSE {_frame(repr(name))} || {_frame(value)} END"
SQL["content_hash_types"] = f"""WITH i AS (SELECT 'e' || event_id AS item_id, event_type, CASE WHEN event_id % 7 <> 0 THEN cast(cast(event_id % 100 AS double) / 8 AS varchar) END AS share, CASE WHEN event_id % 5 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '0Z' END AS seen,
 cast(event_id AS varchar) AS number, CASE event_id % 3 WHEN 0 THEN event_type || chr(31) || 'x' || event_id % 4 WHEN 1 THEN '' END AS tags, CASE WHEN event_id % 2 = 0 THEN event_type ELSE '' END AS content FROM events)
SELECT item_id, sha256({_frame("item_id")} || {_frame("event_type")} || {_PAIR("number", "number")} || {_PAIR("seen", "seen")} || {_PAIR("share", "share")} || {_PAIR("tags", "tags")} || {_frame("content")}) AS content_hash FROM i"""
SQL["name_parts"] = """SELECT doc_id, CASE WHEN i % 3 <> 0 THEN 't' || i ELSE '' END || CASE WHEN i % 6 = 1 THEN '.col' ELSE '' END || CASE WHEN i % 4 <> 0 AND i % 3 <> 0 THEN '@c' ELSE '' END AS object,
 'db' || i % 5 || CASE WHEN i % 3 = 0 AND i % 4 <> 0 THEN '@c' ELSE '' END AS database, CASE WHEN i % 4 <> 0 THEN cast(i % 2 AS varchar) ELSE '' END AS cluster,
 CASE WHEN len(p) = 2 THEN p[1] ELSE 'default' END AS table_database, CASE WHEN len(p) = 2 THEN p[2] ELSE array_to_string(p, '.') END AS "table", CASE WHEN i % 2 = 0 THEN 'last' ELSE i::varchar END AS a, 'd=e' AS c, 2 AS pairs,
 CASE WHEN i % 4 <> 0 THEN 'one|' || lang || '|two' END AS tags, f AS file_name, CASE i % 3 WHEN 0 THEN '.pdf' WHEN 1 THEN '.txt' ELSE '.' || i END AS extension, '/data/' || source AS folder, 'https://x/' || i || '/view' AS link,
 'pdata' || source || 'Report' || i || CASE i % 3 WHEN 0 THEN 'PDF' WHEN 1 THEN 'txt' ELSE '' END AS key
FROM (SELECT *, doc_id AS i, list_filter([CASE WHEN doc_id % 2 <> 1 THEN 'sales' END, CASE WHEN doc_id % 3 <> 1 THEN 'orders' END, CASE WHEN doc_id % 5 <> 1 THEN 'part' END], lambda x: x IS NOT NULL) AS p,
 'Report.' || doc_id || CASE doc_id % 3 WHEN 0 THEN '.PDF' WHEN 1 THEN '.txt' ELSE '' END AS f FROM documents)"""
SQL["gathered_files"] = """WITH l AS (SELECT '/in/' || source || '/' || CASE doc_id % 10 WHEN 3 THEN '.' WHEN 7 THEN '_' ELSE '' END || 'f' || doc_id || ['.txt', '.HTML', '.bin', '.docx', '.txt.tmp', ''][doc_id % 6 + 1] AS path,
 TIMESTAMP '2001-01-01' + INTERVAL 1 MINUTE * (doc_id % 50) AS modified, doc_id AS i FROM documents)
SELECT path, modified FROM l WHERE i % 11 <> 5 AND i % 10 NOT IN (3, 7) AND i % 6 IN (0, 1, 3) AND (modified, path) > (TIMESTAMP '2001-01-01 00:20:00', '/in/src2')"""
SQL["unchanged_crawl"] = f"""{_with(*_H)}{_LIVE}, i AS (SELECT 'Customer' AS item_type, 'unchanged' AS action FROM c UNION ALL SELECT 'Engagement', 'unchanged' FROM e JOIN c ON c.customer_id = e.customer_id
 UNION ALL SELECT DISTINCT ON (entry_id) 'TimeEntry', CASE WHEN entry_id % 7 = 0 THEN 'write' ELSE 'unchanged' END FROM t JOIN e ON e.engagement_id = t.engagement_id JOIN c ON c.customer_id = e.customer_id)
SELECT item_type, action, count(*) AS items FROM i GROUP BY ALL"""
