"""The registered queries in SQL (DuckDB), written from the semantics, not from the Spark code."""

from __future__ import annotations

BASE = """base AS (
  SELECT event_id, ts AS kafka_timestamp,
    concat('u_', CAST(user_id AS VARCHAR)) AS user_id,
    CASE event_type WHEN 'signup' THEN 'add_to_cart' WHEN 'error' THEN 'INVALID_EVENT' ELSE event_type END AS event_type,
    concat('p_', CAST(event_id % 1000 AS VARCHAR)) AS product_id,
    CASE CAST(props->>'$.k' AS INT) % 6 WHEN 0 THEN 'book' WHEN 1 THEN 'toy' WHEN 2 THEN '3c'
      WHEN 3 THEN 'fashion' WHEN 4 THEN 'beauty' END AS category,
    CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 15 = 0 THEN -100 ELSE CAST(floor(value) AS BIGINT) END AS price,
    CASE WHEN event_id % 17 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS event_time,
    CASE CAST(props->>'$.k' AS INT) % 4 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' WHEN 2 THEN 'web' END AS device
  FROM events)"""


def chain(tag: str = "", where: str = "true", extra: str | None = None) -> str:
    """CTEs from the records to valid and bad events, names ending in ``tag``, over the records that satisfy ``where``."""
    tail = f" || CASE WHEN event_id % 11 = 0 THEN '{extra}' ELSE '' END" if extra else ""
    return f"""raw{tag} AS (
  SELECT event_id, copy_no, kafka_timestamp,
    '{{"user_id":"' || user_id || '","event_type":"' || event_type || '","product_id":"' || product_id || '","category":'
    || coalesce('"' || category || '"', 'null') || ',"price":' || coalesce(CAST(price AS VARCHAR), 'null')
    || ',"event_time":' || coalesce('"' || event_time || '"', 'null')
    || ',"device":' || coalesce('"' || device || '"', 'null'){tail} || '}}' AS raw_value
  FROM base CROSS JOIN (SELECT 0 AS copy_no UNION ALL SELECT 1) c
  WHERE (copy_no = 0 OR event_id % 5 = 0) AND ({where})),
parsed{tag} AS (
  SELECT raw_value->>'$.user_id' AS user_id, raw_value->>'$.event_type' AS event_type,
    raw_value->>'$.product_id' AS product_id, raw_value->>'$.category' AS category,
    CAST(raw_value->>'$.price' AS BIGINT) AS price,
    strptime(raw_value->>'$.event_time', '%Y-%m-%dT%H:%M:%SZ') AS event_time,
    kafka_timestamp, raw_value->>'$.device' AS device
  FROM raw{tag}),
hashed{tag} AS (
  SELECT *, sha256(concat_ws('||', coalesce(user_id, '__NULL__'), coalesce(event_type, '__NULL__'),
    coalesce(product_id, '__NULL__'), coalesce(category, '__NULL__'), coalesce(CAST(price AS VARCHAR), '__NULL__'),
    coalesce(CAST(event_time AS VARCHAR), '__NULL__'), coalesce(device, '__NULL__'))) AS event_hash
  FROM parsed{tag}),
deduped{tag} AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_hash ORDER BY kafka_timestamp) AS place FROM hashed{tag})
  WHERE place = 1),
checked{tag} AS (SELECT *, {REASONS} AS error_reasons FROM deduped{tag}),
valid{tag} AS (SELECT * EXCLUDE (error_reasons) FROM checked{tag} WHERE len(error_reasons) = 0),
bad{tag} AS (SELECT * FROM checked{tag} WHERE len(error_reasons) > 0)"""


REASONS = """list_filter([
    CASE WHEN event_time IS NULL THEN 'event_time_is_null' END,
    CASE WHEN price IS NULL THEN 'price_is_null' END,
    CASE WHEN price < 0 THEN 'price_is_negative' END,
    CASE WHEN event_type IS NULL THEN 'event_type_is_null' END,
    CASE WHEN event_type NOT IN ('view', 'click', 'purchase', 'add_to_cart') THEN 'invalid_event_type' END
  ], lambda x: x IS NOT NULL)"""

CLEAN_COLUMNS = "user_id, event_type, product_id, category, price, event_time, kafka_timestamp, device, event_hash"
FIRST = "event_id % 2 = 0 OR event_id % 10 = 1"
SECOND = "event_id % 2 = 1"

BRONZE_SELECT = """SELECT raw_value->>'$.user_id' AS user_id, raw_value->>'$.event_type' AS event_type,
    raw_value->>'$.product_id' AS product_id, raw_value->>'$.category' AS category,
    CAST(CAST(raw_value->>'$.price' AS INT) AS BIGINT) AS price,
    strptime(raw_value->>'$.event_time', '%Y-%m-%dT%H:%M:%SZ') AS event_time,
    kafka_timestamp, raw_value, 'test-topic' AS kafka_topic,
    CAST(event_id % 3 AS INT) AS kafka_partition, CAST(event_id * 2 + copy_no AS BIGINT) AS kafka_offset"""

REPAIRED = f"""repaired AS (
  SELECT user_id,
    CASE WHEN list_contains(error_reasons, 'invalid_event_type') THEN 'view' ELSE event_type END AS event_type,
    product_id, category,
    CASE WHEN list_contains(error_reasons, 'price_is_negative') THEN abs(price) ELSE price END AS price,
    CASE WHEN list_contains(error_reasons, 'event_time_is_null') THEN kafka_timestamp ELSE event_time END AS event_time,
    kafka_timestamp, device
  FROM bad),
repaired_once AS (
  SELECT * EXCLUDE (place) FROM (
    SELECT *, row_number() OVER (PARTITION BY event_hash ORDER BY kafka_timestamp) AS place FROM (
      SELECT *, sha256(concat_ws('||', coalesce(user_id, '__NULL__'), coalesce(event_type, '__NULL__'),
        coalesce(product_id, '__NULL__'), coalesce(category, '__NULL__'), coalesce(CAST(price AS VARCHAR), '__NULL__'),
        coalesce(CAST(event_time AS VARCHAR), '__NULL__'), coalesce(device, '__NULL__'))) AS event_hash FROM repaired))
  WHERE place = 1),
replayed AS (
  SELECT {CLEAN_COLUMNS} FROM valid
  UNION ALL
  SELECT {CLEAN_COLUMNS} FROM repaired_once r WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.event_hash = r.event_hash))"""

WINDOW_BOUNDS = """time_bucket(INTERVAL 5 MINUTE, event_time) AS {start},
    time_bucket(INTERVAL 5 MINUTE, event_time) + INTERVAL 5 MINUTE AS {end}"""

TYPE_COUNTS = """CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS {0}view{1},
    CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS {0}click{1},
    CAST(sum(CASE WHEN event_type = 'add_to_cart' THEN 1 ELSE 0 END) AS BIGINT) AS {0}add_to_cart{1},
    CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS {0}purchase{1}"""
REVENUE = "sum(CASE WHEN event_type = 'purchase' THEN CAST(price AS DOUBLE) ELSE 0.0 END)"


def window_count(dimension: str, source: str = "valid") -> str:
    return f"""SELECT {dimension}, count(*) AS count, {WINDOW_BOUNDS.format(start='window_start', end='window_end')}
  FROM {source} WHERE {dimension} IS NOT NULL GROUP BY ALL"""


def revenue(source: str = "valid") -> str:
    return f"""SELECT CAST(sum(price) AS BIGINT) AS revenue, {WINDOW_BOUNDS.format(start='window_start', end='window_end')}
  FROM {source} WHERE price IS NOT NULL GROUP BY ALL"""


def active_users(source: str = "valid") -> str:
    return f"""SELECT count(DISTINCT user_id) AS active_user_count,
    {WINDOW_BOUNDS.format(start='window_start', end='window_end')}
  FROM {source} WHERE user_id IS NOT NULL GROUP BY ALL"""


def conversion(dimension: str, source: str = "valid") -> str:
    rates = ", ".join(
        f"CASE WHEN view_count > 0 THEN {part} / view_count ELSE 0.0 END AS {rate}"
        for rate, part in (
            ("ctr", "click_count"),
            ("add_to_cart_rate", "add_to_cart_count"),
            ("purchase_conversion_rate", "purchase_count"),
        )
    )
    return f"""SELECT start_time, end_time, {dimension}, view_count, click_count, add_to_cart_count, purchase_count,
    {rates}, revenue, active_user_count
  FROM (SELECT {WINDOW_BOUNDS.format(start='start_time', end='end_time')},
      coalesce({dimension}, 'unknown') AS {dimension}, {TYPE_COUNTS.format('', '_count')},
      {REVENUE} AS revenue, count(DISTINCT user_id) AS active_user_count
    FROM {source} WHERE event_time IS NOT NULL GROUP BY 1, 2, 3)"""


def user_activity(source: str = "valid") -> str:
    return f"""SELECT {WINDOW_BOUNDS.format(start='start_time', end='end_time')}, user_id,
    {TYPE_COUNTS.format('', '_count')}, {REVENUE} AS revenue, max(event_time) AS last_active_time
  FROM {source} WHERE event_time IS NOT NULL GROUP BY 1, 2, 3"""


def user_metrics(source: str = "valid") -> str:
    return f"""SELECT user_id, {TYPE_COUNTS.format('total_', '')}, {REVENUE} AS total_revenue,
    max(event_time) AS last_active_time FROM {source} GROUP BY user_id"""


def favorite(value: str, expression: str, source: str = "valid") -> str:
    return f"""SELECT user_id, {value} AS favorite_{value} FROM (
    SELECT user_id, {value}, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, {value} ASC NULLS LAST) AS rn
    FROM (SELECT user_id, {expression} AS {value}, count(*) AS n FROM {source} GROUP BY 1, 2)) WHERE rn = 1"""


def profile(source: str = "valid") -> str:
    return f"""SELECT m.user_id, total_view, total_click, total_add_to_cart, total_purchase, total_revenue,
    favorite_category, favorite_device, last_active_time
  FROM ({user_metrics(source)}) m
  LEFT JOIN ({favorite('category', 'category', source)}) c ON c.user_id = m.user_id
  LEFT JOIN ({favorite('device', "coalesce(device, 'unknown')", source)}) d ON d.user_id = m.user_id"""


QUEUE = """queue AS (
  SELECT 'silver_to_gold_events' AS pipeline_name, date_trunc('hour', event_time) AS start_time,
    date_trunc('hour', event_time) + INTERVAL 1 HOUR AS end_time, false AS processed, max(kafka_timestamp) AS updated_at
  FROM valid GROUP BY ALL),
queue_state AS (
  SELECT pipeline_name, start_time, end_time, did AS processed,
    CASE WHEN did THEN start_time + INTERVAL 118 MINUTE ELSE updated_at END AS updated_at
  FROM (SELECT *, extract(hour FROM start_time) < 12 AND updated_at <= start_time + INTERVAL 58 MINUTE AS did FROM queue))"""

LOG = """log AS (
  SELECT t.table_name, CAST(d.day AS BIGINT) AS snapshot_id, d.at AS committed_at
  FROM (SELECT dayofyear(ts) AS day, max(ts) AS at FROM events GROUP BY 1) d
  CROSS JOIN (SELECT 'bronze.kafka_events' AS table_name UNION ALL SELECT 'silver.bronze_clean') t),
expired AS (
  SELECT table_name, snapshot_id, committed_at FROM (
    SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY committed_at DESC) AS rn FROM log)
  WHERE rn > 3 AND committed_at < TIMESTAMP '2024-01-31' - INTERVAL 5 DAY)"""


def counts(tag: str = "") -> str:
    return f"""CAST((SELECT count(*) FROM raw{tag}) AS BIGINT) AS total_count,
    CAST((SELECT count(*) FROM valid{tag}) AS BIGINT) AS valid_count,
    CAST((SELECT count(*) FROM bad{tag}) AS BIGINT) AS bad_count,
    CAST((SELECT count(*) FROM raw{tag}) - (SELECT count(*) FROM checked{tag}) AS BIGINT) AS duplicate_removed_count"""


def summary(tag: str, snapshot_id: int) -> str:
    return f"SELECT 'bronze_to_silver_events' AS pipeline_name, CAST({snapshot_id} AS BIGINT) AS snapshot_id, {counts(tag)}"


def sql(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *(ctes or (chain(),))]) + "\n" + select


def keys_of(tag: str) -> str:
    return f"""keys{tag} AS (SELECT DISTINCT unnest(json_keys(raw_value)) AS column_name FROM raw{tag})"""


EXPECTED = "['user_id', 'event_type', 'product_id', 'category', 'price', 'event_time', 'device']"
TWO = (chain("_1", FIRST), chain("_2", SECOND))
COUPON, CAMPAIGN = ',"coupon":"x"', ',"coupon":"y","campaign":"z"'
MERGED = f"""SELECT {CLEAN_COLUMNS} FROM valid_1 UNION ALL
  SELECT {CLEAN_COLUMNS} FROM valid_2 s WHERE NOT EXISTS (SELECT 1 FROM valid_1 t WHERE t.event_hash = s.event_hash)"""
MESSAGE = """'Data Quality Alert' || chr(10) || 'Pipeline: ' || pipeline_name || chr(10) || 'Snapshot: ' || snapshot_id
    || chr(10) || 'Total: ' || total_count || chr(10) || 'Valid: ' || valid_count || chr(10) || 'Bad: ' || bad_count
    || chr(10) || 'Bad Rate: ' || printf('%.2f', bad_rate * 100) || '%'
    || chr(10) || 'Duplicate Removed: ' || duplicate_removed_count
    || chr(10) || 'Duplicate Rate: ' || printf('%.2f', duplicate_rate * 100) || '%'"""


def metrics(tag: str, snapshot_id: int) -> str:
    return f"""SELECT pipeline_name, CAST(snapshot_id AS VARCHAR) AS snapshot_id, total_count, valid_count, bad_count,
    CASE WHEN total_count > 0 THEN bad_count / total_count ELSE 0.0 END AS bad_rate, duplicate_removed_count,
    CASE WHEN total_count > 0 THEN duplicate_removed_count / total_count ELSE 0.0 END AS duplicate_rate
  FROM ({summary(tag, snapshot_id)})"""


def requests(*tags_and_status: tuple[str, str]) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'bronze_to_silver_events' AS pipeline_name, column_name, 'new_column' AS change_type,
    '{status}' AS status FROM keys{tag} WHERE NOT list_contains({EXPECTED}, column_name)
    {"".join(f" AND column_name NOT IN (SELECT column_name FROM keys{earlier})" for earlier in seen)}"""
        for (tag, status), seen in zip(
            tags_and_status, [[t for t, _ in tags_and_status[:place]] for place in range(len(tags_and_status))]
        )
    )


def backfill() -> str:
    parts = (
        ("event_type_5min_count", window_count("event_type"), "event_type", "count"),
        ("category_5min_count", window_count("category"), "category", "count"),
        ("revenue_5min", revenue(), "CAST(NULL AS VARCHAR)", "revenue"),
        ("active_user_5min", active_users(), "CAST(NULL AS VARCHAR)", "active_user_count"),
    )
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, strftime(window_start, '%Y-%m-%d') AS dt, strftime(window_start, '%H') AS hour,
    window_start, {name} AS name, CAST({value} AS DOUBLE) AS value FROM ({select}) WHERE extract(hour FROM window_start) < 12"""
        for dataset, select, name, value in parts
    )


def gold_refresh() -> str:
    none, source = "CAST(NULL AS VARCHAR)", "replayed"
    total = "view_count + click_count + add_to_cart_count + purchase_count"
    lifetime = "total_view + total_click + total_add_to_cart + total_purchase"
    name = "user_id || '/' || coalesce(favorite_category, '-') || '/' || favorite_device"
    parts = (
        ("event_type_5min_count", window_count("event_type", source), "window_start", "event_type", "count", "0.0"),
        ("category_5min_count", window_count("category", source), "window_start", "category", "count", "0.0"),
        ("revenue_5min", revenue(source), "window_start", none, "revenue", "0.0"),
        ("active_user_5min", active_users(source), "window_start", none, "active_user_count", "0.0"),
        ("device_5min_summary", conversion("device", source), "start_time", "device",
         f"{total} + active_user_count", "ctr + revenue"),
        ("category_conversion_5min", conversion("category", source), "start_time", "category",
         f"{total} + active_user_count", "purchase_conversion_rate + revenue"),
        ("user_activity_5min_summary", user_activity(source), "start_time", "user_id", total, "revenue"),
        ("user_profile", profile(source), "CAST(NULL AS TIMESTAMP)", name, lifetime, "total_revenue"),
    )
    return " UNION ALL ".join(
        f"""SELECT '{dataset}' AS dataset, {start} AS start_time, {label} AS name, CAST({number} AS BIGINT) AS number,
    CAST({amount} AS DOUBLE) AS amount FROM ({select})"""
        for dataset, select, start, label, number, amount in parts
    )


LISTING = """files AS (
  SELECT concat('clean/day=', dayofyear(ts), '/part-', event_id % (dayofyear(ts) % 13 + 1)) AS file_path,
    count(*) AS record_count, CAST(sum(strlen(event_type) + strlen(props)) AS BIGINT) AS file_size_in_bytes
  FROM events GROUP BY 1)"""

ORACLE: dict[str, str] = {
    "bronze_parse": sql(f"{BRONZE_SELECT} FROM raw"),
    "bronze_ingest_stream": sql(f"{BRONZE_SELECT} FROM raw"),
    "incremental_snapshot_read": sql(f"{BRONZE_SELECT} FROM raw", chain("", SECOND)),
    "latest_snapshot": f"WITH {LOG} SELECT max(snapshot_id) AS snapshot_id FROM log WHERE table_name = 'bronze.kafka_events'",
    "latest_state": f"WITH {LOG} SELECT max(snapshot_id) AS last_snapshot_id FROM log WHERE table_name = 'bronze.kafka_events'",
    "gold_partition_backfill": sql(backfill()),
    "merge_insert_clean": sql(MERGED, *TWO),
    "merge_insert_multikey": sql(
        requests(("_1", "pending"), ("_2", "again")),
        chain("_1", "true", COUPON), keys_of("_1"), chain("_2", "true", CAMPAIGN), keys_of("_2"),
    ),
    "mark_replayed": sql(
        """SELECT event_hash, true AS is_replayed, 'replay_20240131000000' AS replay_batch_id, true AS has_time FROM bad_1
  UNION ALL SELECT event_hash, false, NULL, false FROM bad_2""",
        *TWO,
    ),
    "overwrite_partitions": sql(
        f"""SELECT * FROM ({window_count('event_type', 'valid_2')}) UNION ALL
  SELECT * FROM ({window_count('event_type', 'valid_1')})
  WHERE date_trunc('hour', window_start) NOT IN (SELECT date_trunc('hour', event_time) FROM valid_2)""",
        *TWO,
    ),
    "mark_partitions_processed": sql("SELECT * FROM queue_state", chain(), QUEUE),
    "silver_project": sql("SELECT * FROM parsed"),
    "event_hash": sql("SELECT user_id, product_id, kafka_timestamp, event_hash FROM hashed"),
    "validate_events": sql(
        f"SELECT event_hash, kafka_timestamp, array_to_string({REASONS}, ',') AS error_reasons FROM hashed"
    ),
    "silver_clean": sql(f"SELECT {CLEAN_COLUMNS} FROM valid"),
    "quarantine_events": sql(
        """SELECT user_id, event_type, product_id, category, price, event_time, device, kafka_timestamp, event_hash,
    kafka_timestamp AS created_at, kafka_timestamp AS quarantine_at, false AS is_replayed,
    CAST(NULL AS TIMESTAMP) AS replayed_at, CAST(NULL AS VARCHAR) AS replay_batch_id,
    array_to_string(error_reasons, ',') AS error_reasons FROM bad"""
    ),
    "time_range_filter": sql(
        f"""SELECT {CLEAN_COLUMNS} FROM valid
  WHERE event_time >= TIMESTAMP '2024-01-05 06:30:00' AND event_time < TIMESTAMP '2024-01-20 18:00:00'"""
    ),
    "replay_candidates": sql(
        """SELECT event_hash, false AS is_replayed, array_to_string(error_reasons, ',') AS error_reasons
  FROM bad WHERE NOT list_contains(error_reasons, 'event_time_is_null')"""
    ),
    "pending_range_semi_join": sql(
        f"""SELECT {CLEAN_COLUMNS} FROM valid v WHERE EXISTS (
    SELECT 1 FROM queue_state q WHERE NOT q.processed AND v.event_time >= q.start_time AND v.event_time < q.end_time)""",
        chain(), QUEUE,
    ),
    "event_type_5min_count": sql(window_count("event_type")),
    "category_5min_count": sql(window_count("category")),
    "revenue_5min": sql(revenue()),
    "active_user_5min": sql(active_users()),
    "device_5min_summary": sql(conversion("device")),
    "category_conversion_5min": sql(conversion("category")),
    "user_activity_5min_summary": sql(user_activity()),
    "user_metrics": sql(user_metrics()),
    "user_category_counts": sql("SELECT user_id, category, count(*) AS count FROM valid GROUP BY 1, 2"),
    "user_device_counts": sql(
        "SELECT user_id, coalesce(device, 'unknown') AS device, count(*) AS count FROM valid GROUP BY 1, 2"
    ),
    "favorite_category": sql(favorite("category", "category")),
    "favorite_device": sql(favorite("device", "coalesce(device, 'unknown')")),
    "user_profile": sql(profile()),
    "quality_summary": sql(summary("", 1)),
    "error_reason_counts": sql(
        """SELECT error_reason, count(*) AS count FROM (SELECT unnest(error_reasons) AS error_reason FROM bad) GROUP BY 1"""
    ),
    "dedup_events": sql(f"SELECT {CLEAN_COLUMNS} FROM deduped"),
    "schema_drift": sql(
        f"""SELECT 'bronze_to_silver_events' AS pipeline_name, array_to_string(list_sort(found), ',') AS observed_columns,
    array_to_string(list_sort(list_filter({EXPECTED}, lambda x: NOT list_contains(found, x))), ',') AS missing_columns,
    array_to_string(list_sort(list_filter(found, lambda x: NOT list_contains({EXPECTED}, x))), ',') AS new_columns
  FROM (SELECT list(column_name) AS found FROM keys)
  WHERE len(list_filter(found, lambda x: NOT list_contains({EXPECTED}, x))) > 0""",
        chain("", "true", COUPON), keys_of(""),
    ),
    "schema_change_requests": sql(
        f"""SELECT *, CAST(NULL AS TIMESTAMP) AS approved_at, CAST(NULL AS TIMESTAMP) AS applied_at
  FROM ({requests(('_1', 'pending'), ('_2', 'pending'))})""",
        chain("_1", "true", COUPON), keys_of("_1"), chain("_2", "true", CAMPAIGN), keys_of("_2"),
    ),
    "incremental_run": sql(MERGED, *TWO),
    "incremental_run_summary": sql(f"{summary('_1', 1)} UNION ALL {summary('_2', 2)}", *TWO),
    "affected_partitions": sql(
        "SELECT pipeline_name, start_time, end_time, processed FROM queue", chain(), QUEUE
    ),
    "pending_partitions": sql(
        "SELECT DISTINCT start_time, end_time FROM queue_state WHERE NOT processed", chain(), QUEUE
    ),
    "repair_events": sql(f"SELECT {CLEAN_COLUMNS} FROM repaired_once", chain(), REPAIRED),
    "replay_clean": sql(f"SELECT {CLEAN_COLUMNS} FROM replayed", chain(), REPAIRED),
    "replay_summary": sql(
        """SELECT 'replay_20240131000000' AS replay_batch_id, source_error_reason, count(*) AS candidate_count,
    count(*) AS repaired_count, CAST(0 AS BIGINT) AS skipped_count
  FROM (SELECT unnest(error_reasons) AS source_error_reason FROM bad) GROUP BY 2"""
    ),
    "gold_refresh": sql(gold_refresh(), chain(), REPAIRED),
    "late_data_recompute": sql(conversion("device")),
    "data_quality_metrics": sql(metrics("_2", 2), *TWO),
    "quality_alerts": sql(
        f"""SELECT pipeline_name, snapshot_id, bad_rate, duplicate_rate, {MESSAGE} AS message
  FROM ({metrics('', 1)}) WHERE bad_rate > 0.05 OR duplicate_rate > 0.10"""
    ),
    "compacted_rows_equal": sql(MERGED, *TWO),
    "file_stats_summary": f"""WITH {LISTING}
SELECT count(*) AS file_count, CAST(sum(record_count) AS BIGINT) AS total_records,
  CAST(sum(file_size_in_bytes) AS BIGINT) AS total_bytes FROM files""",
    "largest_files": f"WITH {LISTING} SELECT * FROM files ORDER BY file_size_in_bytes DESC, file_path LIMIT 20",
    "compaction_plan": f"""WITH {LISTING},
sizes AS (
  SELECT split_part(file_path, '/part', 1) AS directory, count(*) AS file_count,
    CAST(sum(file_size_in_bytes) AS BIGINT) AS total_bytes FROM files GROUP BY 1)
SELECT *, (total_bytes + 2047) // 2048 AS target_file_count, file_count > (total_bytes + 2047) // 2048 AS rewrite FROM sizes""",
    "expired_snapshots": f"WITH {LOG} SELECT * FROM expired",
    "orphan_files": f"""WITH {LOG},
listing AS (
  SELECT CAST(dayofyear(ts) AS BIGINT) AS snapshot_id, user_id, max(ts) AS modified_at, count(*) AS size
  FROM events GROUP BY 1, 2)
SELECT 'bronze/' || snapshot_id || '/' || user_id AS path, modified_at, size FROM listing
WHERE modified_at < TIMESTAMP '2024-01-31' - INTERVAL 3 DAY
  AND snapshot_id IN (SELECT snapshot_id FROM expired WHERE table_name = 'bronze.kafka_events')""",
}
