"""Tables of the domain derived from the star-schema tables, in SQL that Spark and DuckDB both run.

The same text builds the inputs of a query and of its check, so the two start from equal rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Later than the last order.
AS_OF = "2001-08-03 00:00:00"

SQL = {
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, concat('C', cast(c_custkey AS string)) AS customer_code, c_mktsegment AS industry, n_name AS region,
               concat('Manager ', cast(c_nationkey AS string)) AS account_manager, concat('m', cast(c_nationkey AS string), '@example.com') AS account_manager_email,
               concat('Segment ', c_mktsegment) AS notes, TIMESTAMP '1999-06-01 00:00:00' + (c_custkey % 700) * INTERVAL '1' DAY AS last_modified, c_custkey % 17 = 0 AS is_deleted
        FROM customer JOIN nation ON n_nationkey = c_nationkey""",
    "engagements": """
        SELECT o_orderkey AS engagement_id, o_custkey AS customer_id, concat('E', cast(o_orderkey AS string)) AS engagement_code, concat('Order ', cast(o_orderkey AS string)) AS engagement_name,
               o_orderpriority AS practice, o_orderstatus AS status, cast(o_orderdate AS date) AS start_date,
               CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE cast(o_orderdate + INTERVAL '30' DAY AS date) END AS end_date, cast(o_totalprice AS decimal(18,2)) AS contract_value,
               concat('PM ', cast(o_orderkey % 50 AS string)) AS project_manager, concat('Scope ', o_orderpriority) AS scope, o_orderdate AS last_modified, o_orderkey % 23 = 0 AS is_deleted
        FROM orders""",
    "entries": """
        SELECT l_orderkey * 100000000000 + l_partkey * 100000 + l_suppkey * 10 + l_linenumber AS entry_id, l_orderkey AS engagement_id,
               concat('Consultant ', cast(l_suppkey AS string)) AS consultant_name, concat('c', cast(l_suppkey AS string), '@example.com') AS consultant_email, cast(l_shipdate AS date) AS work_date,
               cast(1 + cast(l_quantity AS int) % 24 AS decimal(5,2)) AS hours, l_returnflag <> 'R' AS billable, l_linestatus AS work_type, concat('Part ', cast(l_partkey AS string)) AS narrative,
               l_shipdate AS last_modified, l_returnflag = 'R' AND l_linenumber = 7 AS is_deleted
        FROM lineitem""",
    "connection": """
        SELECT concat('conn', cast(n_nationkey AS string)) AS connection_id, concat('region', cast(n_regionkey AS string)) AS connector_key, n_name AS display_name,
               CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE 1440 * (1 + n_nationkey % 3) END AS expected_interval_minutes, n_nationkey % 7 <> 6 AS is_enabled,
               CASE WHEN n_nationkey % 4 = 0 THEN 30 ELSE 60 END AS negative_ttl_minutes
        FROM nation""",
    "run": """
        SELECT o.o_orderkey AS run_id, concat('conn', cast(c.c_nationkey AS string)) AS connection_id, 1 + o.o_orderkey % 2 AS mode,
               CASE WHEN o.o_orderkey % 97 = 0 THEN 1 WHEN o.o_orderstatus = 'F' THEN 2 WHEN o.o_orderkey % 3 = 0 THEN 3 WHEN o.o_orderkey % 3 = 1 THEN 5 ELSE 4 END AS status,
               o.o_orderkey % 11 = 0 AS is_dry_run, o.o_orderdate + (o.o_orderkey % 1440) * INTERVAL '1' MINUTE AS started_utc,
               CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderdate + (o.o_orderkey % 1440) * INTERVAL '1' MINUTE + (o.o_orderkey % 5400) * INTERVAL '1' SECOND END AS completed_utc,
               o.o_orderdate + (o.o_orderkey % 1500) * INTERVAL '1' MINUTE AS heartbeat_utc,
               coalesce(l.n_written, 0) AS items_written, coalesce(l.n_unchanged, 0) AS items_unchanged, coalesce(l.n_deleted, 0) AS items_deleted, o.o_orderkey % 5 AS items_failed
        FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
        LEFT JOIN (SELECT l_orderkey, count(CASE WHEN l_returnflag = 'N' THEN 1 END) AS n_written, count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_unchanged,
                          count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_deleted FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey""",
    "item": """
        SELECT concat('conn', cast(doc_id % 25 AS string)) AS connection_id, concat('doc', cast(doc_id AS string)) AS item_id, lang AS item_type,
               sha2_hex(concat(source, cast(doc_id % 50 AS string))) AS content_hash, sha2_hex(lang) AS acl_hash, n_chars AS content_bytes,
               doc_id % 900 + 1 AS first_seen_run, doc_id % 1000 + 5 AS last_seen_run, doc_id % 950 + 3 AS last_written_run,
               TIMESTAMP '2001-01-01 00:00:00' + (doc_id % 200) * INTERVAL '1' DAY AS last_written_utc,
               CASE WHEN doc_id % 13 = 0 THEN 3 WHEN doc_id % 10 = 0 THEN 2 ELSE 1 END AS state,
               CASE WHEN doc_id % 13 <> 0 AND doc_id % 10 = 0 THEN TIMESTAMP '2001-08-01 00:00:00' + (doc_id % 2000) * INTERVAL '1' MINUTE END AS pending_since_utc,
               CASE WHEN doc_id % 13 = 0 THEN TIMESTAMP '2001-07-01 00:00:00' + (doc_id % 30) * INTERVAL '1' DAY END AS deleted_utc, cast(doc_id % 30 AS int) AS unchanged_streak
        FROM documents""",
    "throttle_event": """
        SELECT event_id AS throttle_event_id, event_id % 50 AS run_id, CASE WHEN event_type = 'error' THEN 503 WHEN event_type = 'click' THEN 429 ELSE 504 END AS status_code,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE cast(event_id % 60 AS int) END AS retry_after_seconds, 'batch' AS endpoint, 1 + event_id % 5 AS attempt_number, ts AS occurred_utc
        FROM events WHERE event_type IN ('error', 'click')""",
    "principal": """
        SELECT concat('conn', cast(c_nationkey AS string)) AS connection_id, 'group' AS source_type, concat('g', cast(c_custkey AS string)) AS source_key,
               CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE concat('object', cast(c_custkey AS string)) END AS object_id,
               TIMESTAMP '2001-08-02 12:00:00' + (c_custkey % 2000) * INTERVAL '1' MINUTE AS expires_utc, c_custkey % 9 AS hit_count
        FROM customer WHERE c_nationkey < 20""",
    "checkpoint": """
        SELECT concat('conn', cast(n_nationkey AS string)) AS connection_id, TIMESTAMP '2001-03-01 00:00:00' + n_nationkey * INTERVAL '1' DAY AS marker_time,
               concat('doc', cast(n_nationkey AS string)) AS marker_key, cast(n_nationkey * 10 AS bigint) AS run_id, cast(3 AS bigint) AS run_count
        FROM nation WHERE n_nationkey % 3 <> 0""",
}
TABLES = {
    "customers": ("customer", "nation"), "engagements": ("orders",), "entries": ("lineitem",), "connection": ("nation",), "run": ("orders", "customer", "lineitem"), "item": ("documents",),
    "throttle_event": ("events",), "principal": ("customer",), "checkpoint": ("nation",),
}


def fixture(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived table over the Parquet tables in sf_dir."""
    import re

    sql = SQL[name].replace("sha2_hex(lang)", "sha2(lang, 256)").replace("sha2_hex(concat(source, cast(doc_id % 50 AS string)))", "sha2(concat(source, cast(doc_id % 50 AS string)), 256)")
    tables = {}
    for t in TABLES[name]:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", sql)
        tables[t] = spark.read.parquet(f"{sf_dir}/{t}.parquet")
    return spark.sql(sql, **tables)


def with_fixtures(*names: str) -> str:
    """The same tables as common table expressions for DuckDB."""
    return "WITH " + ",\n".join(f"{n} AS ({SQL[n].replace('sha2_hex(', 'sha256(')})" for n in names)
