"""SQL counterparts of the queries, written for DuckDB and independent of the Spark code."""

from __future__ import annotations

_BASE = r"""
base AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k FROM events
),
clean AS (
  SELECT user_id, ts AS created_at, CAST(event_id AS VARCHAR) AS event_id, event_type,
    concat('session_', CAST(user_id AS VARCHAR), '_',
           CAST(CAST(floor(day(ts) / 2) AS INT) AS VARCHAR)) AS session_id,
    concat('/page/', CAST(k % 18 AS VARCHAR)) AS url,
    CASE k % 5 WHEN 0 THEN 'DESKTOP' WHEN 1 THEN 'ANDROID' WHEN 2 THEN 'IOS'
               WHEN 3 THEN 'MOBILE' END AS device_type,
    CASE event_type WHEN 'signup' THEN 'SIGNUP_CLICK' WHEN 'purchase' THEN 'CHECKOUT_VIEW'
                    WHEN 'error' THEN NULL ELSE upper(event_type) END AS event_title,
    CASE WHEN k % 7 = 0 THEN NULL ELSE concat('#el-', CAST(k % 16 AS VARCHAR)) END AS element_id,
    NULLIF(CAST(event_id % 1920 AS INT), 0) AS x,
    NULLIF(CAST((event_id * 7) % 1080 AS INT), 0) AS y
  FROM base
),
cat AS (
  SELECT *, CAST(created_at AS DATE) AS date,
    CASE WHEN event_type IN ('view', 'VIEW') THEN 'view'
         WHEN event_type IN ('click', 'CLICK') THEN 'click'
         WHEN lower(event_title) LIKE '%view%' THEN 'view'
         WHEN lower(event_title) LIKE '%click%' THEN 'click'
         ELSE 'other' END AS category
  FROM clean
)"""

_RAW = r"""
raw AS (
  SELECT CASE WHEN i % 41 = 0 THEN NULL WHEN i % 43 = 0 THEN -1 ELSE user_id END AS user_id,
    created_at,
    CASE WHEN i % 47 = 0 THEN '' ELSE event_id END AS id,
    CASE WHEN i % 53 = 0 THEN NULL WHEN i % 59 = 0 THEN 'SCROLL' WHEN i % 2 = 0 THEN 'CLICK'
         ELSE 'view' END AS type,
    CASE WHEN i % 61 = 0 THEN TIMESTAMP '2030-01-01 00:00:00' ELSE created_at END AS received_at,
    CASE WHEN i % 67 = 0 THEN '' ELSE session_id END AS session_id,
    CASE WHEN i % 71 = 0 THEN NULL ELSE url END AS url,
    CASE WHEN i % 73 = 0 THEN 'WATCH' ELSE lower(device_type) END AS device_type,
    CASE WHEN i % 79 = 0 THEN '' ELSE 'agent' END AS user_agent, event_title,
    CASE WHEN i % 5 = 0 THEN element_id ELSE concat('#el-', event_id) END AS element_id, x, y
  FROM (SELECT *, CAST(event_id AS BIGINT) AS i FROM clean) z
)"""


def _text(c: str) -> str:
    return (
        f"strftime({c}, '%Y-%m-%d %H:%M:%S') || CASE WHEN strftime({c}, '%f') = '000000' THEN '' "
        f"ELSE '.' || strftime({c}, '%f') END"
    )


_CHECKED = rf"""
ruled AS (
  SELECT *, concat_ws('; ',
    CASE WHEN coalesce(id, '') = '' THEN 'Event ID is required' END,
    CASE WHEN coalesce(type, '') = '' THEN 'Event type is required' END,
    CASE WHEN coalesce(type, '') <> '' AND upper(type) NOT IN ('VIEW', 'CLICK')
         THEN 'Invalid event type: ' || type END,
    CASE WHEN user_id IS NULL THEN 'User ID is required' END,
    CASE WHEN user_id <= 0 THEN 'User ID must be positive: ' || CAST(user_id AS VARCHAR) END,
    CASE WHEN coalesce(session_id, '') = '' THEN 'Session ID is required' END,
    CASE WHEN coalesce(url, '') = '' THEN 'URL is required' END,
    CASE WHEN coalesce(user_agent, '') = '' THEN 'User agent is required' END,
    CASE WHEN created_at IS NULL THEN 'Created at timestamp is required' END,
    CASE WHEN created_at > TIMESTAMP '2024-01-25 00:00:00'
         THEN 'Created at timestamp is in the future: ' || {_text('created_at')} END,
    CASE WHEN received_at > TIMESTAMP '2024-01-25 00:00:00'
         THEN 'Received at timestamp is in the future: ' || {_text('received_at')} END,
    CASE WHEN coalesce(device_type, '') <> ''
              AND upper(device_type) NOT IN ('DESKTOP', 'MOBILE', 'TABLET', 'ANDROID', 'IOS')
         THEN 'Invalid device type: ' || device_type END,
    CASE WHEN coalesce(type, '') <> '' AND coalesce(element_id, '') = ''
         THEN 'Element ID is required for events' END) AS errors
  FROM raw
),
checked AS (
  SELECT *, CASE WHEN errors = '' THEN 'VALID'
    WHEN errors LIKE '%required%' OR errors LIKE '%Invalid event type%'
      OR errors LIKE '%User ID must be positive%' THEN 'INVALID'
    ELSE 'SUSPICIOUS' END AS status
  FROM ruled
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


def _activity(source: str, prefix: str = "") -> str:
    """CTEs that end in {prefix}activity(date, dau, wau, mau) over a frame."""
    p = prefix
    return f"""
{p}d AS (SELECT DISTINCT CAST(created_at AS DATE) AS date, user_id FROM {source}),
{p}days AS (SELECT DISTINCT date FROM {p}d),
{p}w AS (SELECT a.date, count(DISTINCT user_id) AS n FROM {p}days a
         JOIN {p}d b ON b.date BETWEEN a.date - 6 AND a.date GROUP BY a.date),
{p}m AS (SELECT a.date, count(DISTINCT user_id) AS n FROM {p}days a
         JOIN {p}d b ON b.date BETWEEN a.date - 29 AND a.date GROUP BY a.date),
{p}dd AS (SELECT date, count(DISTINCT user_id) AS n FROM {p}d GROUP BY date),
{p}activity AS (
  SELECT {p}dd.date, CAST({p}dd.n AS BIGINT) AS dau, CAST({p}w.n AS BIGINT) AS wau,
         CAST({p}m.n AS BIGINT) AS mau
  FROM {p}dd JOIN {p}w ON {p}dd.date = {p}w.date JOIN {p}m ON {p}dd.date = {p}m.date
)"""


_RATIOS = """CAST(wau AS DOUBLE) / CAST(dau AS DOUBLE) AS wau_to_dau_ratio,
  CAST(mau AS DOUBLE) / CAST(dau AS DOUBLE) AS mau_to_dau_ratio"""

_SESSIONS = """
sessions AS (
  SELECT session_id, arg_min(user_id, (created_at, event_id)) AS user_id,
    CAST(min(created_at) AS DATE) AS date, min(created_at) AS start_time,
    max(created_at) AS end_time,
    CAST(least(date_diff('microsecond', min(created_at), max(created_at)), 86400000000) AS BIGINT)
      AS duration_us,
    CAST(count(*) AS BIGINT) AS event_count
  FROM clean GROUP BY session_id
),
session_days AS (
  SELECT date,
    CAST(sum(duration_us) AS DOUBLE) / count(*) / 1e6 AS avg_duration_seconds,
    median(duration_us) / 1e6 AS median_duration_seconds,
    coalesce(stddev_samp(duration_us / 1e6), 0) AS std_duration_seconds,
    CAST(sum(event_count) AS BIGINT) AS total_events, CAST(count(*) AS BIGINT) AS session_count,
    CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users
  FROM sessions GROUP BY date
)"""

_ELEMENTS = """
elements AS (
  SELECT element_id, CAST(max(created_at) AS DATE) AS date,
    CAST(count(*) FILTER (category = 'view') AS BIGINT) AS views,
    CAST(count(*) FILTER (category = 'click') AS BIGINT) AS clicks,
    coalesce(avg(x) FILTER (category = 'click'), 0) AS avg_x,
    coalesce(avg(y) FILTER (category = 'click'), 0) AS avg_y
  FROM cat WHERE element_id IS NOT NULL AND element_id <> '' GROUP BY element_id
)"""

_DEVICES = """
totals AS (
  SELECT date, count(DISTINCT user_id) AS users, count(DISTINCT session_id) AS sessions,
         count(event_id) AS events FROM cat GROUP BY date
),
per_device AS (
  SELECT date, device_type, count(DISTINCT user_id) AS users,
         count(DISTINCT session_id) AS sessions, count(event_id) AS events
  FROM cat WHERE device_type IS NOT NULL GROUP BY date, device_type
)"""

_PAGES = """
page_views AS (
  SELECT date, url, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions, count(event_id) AS view_count
  FROM cat WHERE category = 'view' GROUP BY date, url
),
page_clicks AS (
  SELECT date, url, count(event_id) AS click_count FROM cat WHERE category = 'click'
  GROUP BY date, url
),
ranked AS (
  SELECT v.date, v.url, CAST(unique_users AS BIGINT) AS unique_users,
    CAST(unique_sessions AS BIGINT) AS unique_sessions, CAST(view_count AS BIGINT) AS view_count,
    CAST(coalesce(click_count, 0) AS BIGINT) AS click_count,
    CAST(coalesce(click_count, 0) AS DOUBLE) / CAST(view_count AS DOUBLE) * 100.0
      AS conversion_rate,
    CAST(dense_rank() OVER (PARTITION BY v.date ORDER BY view_count DESC) AS INT) AS rank
  FROM page_views v LEFT JOIN page_clicks c ON v.date = c.date AND v.url = c.url
)"""

_COPIES = """
copies AS (
  SELECT user_id, created_at, event_id AS id, event_type AS type, session_id, url, device_type,
         event_title, element_id, x, y, 0 AS src FROM clean
  UNION ALL
  SELECT user_id, created_at, event_id, event_type, session_id, '/copy' || url, device_type,
         event_title, element_id, x, y, 1 FROM clean WHERE CAST(event_id AS BIGINT) % 3 = 0
)"""
_COPY_COLUMNS = """user_id, created_at, id, type, session_id, url, device_type, event_title,
  element_id, x, y, CAST(src AS INT) AS src"""

# The CSV lines: what the accepted ones hold.
_CSV = """
csv AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, event_id AS i,
    CASE WHEN event_id % 23 = 0 THEN 'field count is not 23'
         WHEN event_id % 17 = 0 OR user_id <= 0 THEN 'user id is not positive'
         WHEN event_type NOT IN ('view', 'click') THEN 'type is not view or click' END AS reason
  FROM events
)"""
_CSV_SELECT = """
SELECT CASE WHEN i % 13 <> 0 THEN CAST(i AS VARCHAR) END AS id, CAST(user_id AS INT) AS user_id,
  date_trunc('millisecond', ts) AS created_at, event_type AS type,
  date_trunc('second', ts) AS received_at, 'session_' || CAST(user_id AS VARCHAR) AS session_id,
  '/page/' || CAST(k AS VARCHAR) AS url, CAST(NULL AS VARCHAR) AS referrer,
  'DESKTOP' AS device_type, 'Agent/5.0 (X, like "Y")' AS user_agent, 'Title' AS event_title,
  CASE WHEN i % 7 <> 0 THEN '#el-' || CAST(k AS VARCHAR) END AS element_id,
  CAST(i % 1920 AS INT) AS x,
  CASE WHEN i % 19 <> 0 THEN CAST(i % 1080 AS INT) END AS y,
  CAST(1920 AS INT) AS viewport_width, value AS scroll_position, i AS timestamp_offset,
  CASE WHEN i % 11 <> 0 THEN 'a,b' END AS tag,
  CAST(CASE WHEN i % 11 <> 0 THEN 4 ELSE 0 END AS INT) AS metadata_size
FROM csv WHERE reason IS NULL"""

_MESSAGES = """
sent AS (
  SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k, event_id AS i,
    CASE WHEN event_id % 31 = 0 THEN 'no url' WHEN event_id % 37 = 0 THEN 'extra'
         WHEN event_id % 41 = 0 THEN 'junk' WHEN event_id % 43 = 0 THEN 'no payload'
         ELSE 'full' END AS kind
  FROM events
),
topic AS (
  SELECT *, CASE kind WHEN 'junk' THEN 'not a JSON object' WHEN 'no url' THEN 'missing key'
                      WHEN 'extra' THEN 'unknown key' END AS reason FROM sent
),
bodies AS (
  SELECT *, CASE WHEN kind = 'junk' THEN 'not a valid body'
                 WHEN i % 3 <> 1 THEN 'created_at is not an ISO time'
                 WHEN i % 29 = 0 THEN 'received_at is not an ISO time' END AS reason FROM sent
)"""


def _message_select(source: str, with_id: bool, received: str) -> str:
    def payload(expression: str) -> str:
        return f"CASE WHEN kind <> 'no payload' THEN {expression} END"

    own_id = "CAST(i AS VARCHAR) AS id," if with_id else ""
    return f"""
SELECT {own_id} CAST(user_id AS INT) AS user_id,
  CASE WHEN i % 3 = 2 THEN date_trunc('second', ts) ELSE date_trunc('millisecond', ts) END AS created_at,
  upper(event_type) AS type, {received} AS received_at,
  'session_' || CAST(user_id AS VARCHAR) AS session_id,
  CASE WHEN kind <> 'no url' THEN '/page/' || CAST(k AS VARCHAR) END AS url,
  CAST(NULL AS VARCHAR) AS referrer, 'IOS' AS device_type, 'Agent' AS user_agent,
  {payload("upper(event_type)")} AS event_title,
  {payload("'#el-' || CAST(k AS VARCHAR)")} AS element_id,
  {payload("CAST(i % 1920 AS INT)")} AS x, {payload("CAST(i % 1080 AS INT)")} AS y,
  CAST(NULL AS INT) AS viewport_width, {payload("value")} AS scroll_position,
  {payload("i")} AS timestamp_offset, {payload("CAST(k AS VARCHAR)")} AS metadata_k,
  {payload("CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END")} AS metadata_even,
  {payload("'[' || CAST(k AS VARCHAR) || ',' || CAST(k AS VARCHAR) || ']'")} AS metadata_pair
FROM {source} WHERE reason IS NULL"""


_RECEIVED = """CASE WHEN i % 29 = 0 THEN TIMESTAMP '2024-01-25 00:00:00'
  ELSE date_trunc('second', ts) END"""

_TREND_SINCE = "WHERE date >= DATE '2024-01-30' - 30 ORDER BY 1"

ORACLES: dict[str, str] = {}

# --- scans ----------------------------------------------------------------------------------

ORACLES["raw_range_scan"] = _with(_BASE, _RAW) + """
SELECT user_id, created_at, id, type, received_at, url FROM raw
WHERE created_at >= TIMESTAMP '2024-01-24 00:00:00' AND created_at < TIMESTAMP '2024-01-25 00:00:00'"""

ORACLES["clean_range_scan"] = _with(_BASE) + """
SELECT * FROM clean
WHERE created_at BETWEEN TIMESTAMP '2024-01-20 00:00:00' AND TIMESTAMP '2024-01-30 00:00:00'"""

# --- marts ----------------------------------------------------------------------------------

ORACLES["user_activity_daily"] = _with(_BASE, _activity("clean")) + f"""
SELECT date, dau, wau, mau, {_RATIOS} FROM activity"""

_RECENT = """
recent AS (SELECT * FROM clean
  WHERE created_at BETWEEN TIMESTAMP '{low}' AND TIMESTAMP '2024-01-30 00:00:00')"""

ORACLES["rolling_active_users_windowed"] = (
    _with(_BASE, _RECENT.format(low="2024-01-20 00:00:00"), _activity("recent"))
    + " SELECT date, dau, wau, mau FROM activity"
)

ORACLES["user_activity_with_warmup"] = (
    _with(_BASE, _RECENT.format(low="2023-12-22 00:00:00"), _activity("recent"))
    + f" SELECT date, dau, wau, mau, {_RATIOS} FROM activity WHERE date >= DATE '2024-01-20'"
)

ORACLES["element_conversion"] = _with(_BASE, _ELEMENTS) + """
SELECT element_id, date, views, clicks, avg_x, avg_y,
  CASE WHEN views > 0 THEN CAST(clicks AS DOUBLE) / CAST(views AS DOUBLE) * 100.0
             ELSE 0.0 END AS conversion_rate,
  CAST(views + clicks AS BIGINT) AS total_interactions
FROM elements"""

ORACLES["page_conversion"] = _with(_BASE) + """,
p AS (
  SELECT url, CAST(max(created_at) AS DATE) AS date,
    CAST(count(*) FILTER (category = 'view') AS BIGINT) AS views,
    CAST(count(*) FILTER (category = 'click') AS BIGINT) AS clicks,
    CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users,
    CAST(count(DISTINCT session_id) AS BIGINT) AS unique_sessions
  FROM cat GROUP BY url
)
SELECT *, CASE WHEN views > 0 THEN CAST(clicks AS DOUBLE) / CAST(views AS DOUBLE) * 100.0
                     ELSE 0.0 END AS conversion_rate FROM p"""

ORACLES["event_category_counts"] = _with(_BASE) + """
SELECT category, CAST(count(*) AS BIGINT) AS events FROM cat GROUP BY category"""

ORACLES["session_rollup"] = _with(_BASE, _SESSIONS) + " SELECT * FROM sessions"

ORACLES["session_metrics_daily"] = _with(_BASE, _SESSIONS) + """
SELECT date, avg_duration_seconds,
  median_duration_seconds,
  round(std_duration_seconds, 5) AS std_duration_seconds, total_events, session_count,
  unique_users, avg_duration_seconds / 60.0 AS avg_duration_minutes,
  median_duration_seconds / 60.0 AS median_duration_minutes
FROM session_days"""

ORACLES["visit_rollup"] = _with(_BASE) + """
SELECT date, session_id, user_id, device_type, min(created_at) AS first_at,
  max(created_at) AS last_at, CAST(count(*) AS BIGINT) AS events,
  CAST(count(event_id) AS BIGINT) AS identified_events
FROM cat GROUP BY date, session_id, user_id, device_type"""

ORACLES["device_distribution_daily"] = _with(_BASE, _DEVICES) + """
SELECT p.date, device_type, CAST(p.users AS BIGINT) AS unique_users,
  CAST(p.sessions AS BIGINT) AS unique_sessions, CAST(p.events AS BIGINT) AS device_events,
  CAST(p.users AS DOUBLE) / CAST(t.users AS DOUBLE) * 100.0 AS user_percentage,
  CAST(p.sessions AS DOUBLE) / CAST(t.sessions AS DOUBLE) * 100.0 AS session_percentage,
  CAST(p.events AS DOUBLE) / CAST(t.events AS DOUBLE) * 100.0 AS event_percentage
FROM per_device p LEFT JOIN totals t ON p.date = t.date"""

ORACLES["top_pages_daily"] = _with(_BASE, _PAGES) + " SELECT * FROM ranked WHERE rank <= 10"
ORACLES["page_ranks_daily"] = _with(_BASE, _PAGES) + " SELECT * FROM ranked"

ORACLES["extract_profile"] = _with(_BASE) + """
SELECT CAST(count(*) AS BIGINT) AS events, min(created_at) AS first_event,
  max(created_at) AS last_event, CAST(count(DISTINCT user_id) AS BIGINT) AS unique_users,
  CAST(count(DISTINCT session_id) AS BIGINT) AS unique_sessions FROM clean"""

ORACLES["activity_summary"] = _with(_BASE, _activity("clean")) + """
SELECT min(dau) AS min_dau, max(dau) AS max_dau, avg(dau) AS avg_dau FROM activity"""

ORACLES["session_summary"] = _with(_BASE, _SESSIONS) + """
SELECT CAST(sum(session_count) AS BIGINT) AS sessions,
  min(avg_duration_seconds) AS min_avg_duration,
  max(avg_duration_seconds) AS max_avg_duration FROM session_days"""

# --- validation -----------------------------------------------------------------------------

_VALIDATED = _with(_BASE, _RAW, _CHECKED)

ORACLES["validation_errors"] = _VALIDATED + """
SELECT user_id, created_at, id, status, errors FROM checked"""

ORACLES["validation_status_counts"] = _VALIDATED + """
SELECT status, CAST(count(*) AS BIGINT) AS events FROM checked GROUP BY status"""

ORACLES["validation_rule_counts"] = _VALIDATED + """,
one AS (SELECT status, unnest(string_split(errors, '; ')) AS error FROM checked WHERE errors <> '')
SELECT split_part(error, ':', 1) AS rule, status, CAST(count(*) AS BIGINT) AS events
FROM one GROUP BY 1, 2"""

ORACLES["clean_events"] = _VALIDATED + """
SELECT user_id, created_at, id, type, session_id, url, device_type, event_title, element_id, x, y,
  TIMESTAMP '2024-01-25 00:00:00' AS loaded_at, TIMESTAMP '2025-01-24 00:00:00' AS expires_at
FROM (SELECT *, row_number() OVER (
        PARTITION BY id, user_id, session_id, type, created_at, coalesce(x, 0), coalesce(y, 0)
        ORDER BY url NULLS FIRST, element_id NULLS FIRST) AS n
      FROM checked WHERE status <> 'INVALID') WHERE n = 1"""

ORACLES["invalid_events"] = _VALIDATED + """
SELECT user_id, id, type, session_id, created_at AS event_time,
  TIMESTAMP '2024-01-25 00:00:00' AS processed_at, errors AS validation_error,
  TIMESTAMP '2024-02-01 00:00:00' AS expires_at
FROM checked WHERE status <> 'VALID'"""

ORACLES["load_report"] = _VALIDATED + """,
c AS (SELECT DISTINCT id, user_id, session_id, type, created_at, coalesce(x, 0) AS x,
             coalesce(y, 0) AS y FROM checked WHERE status <> 'INVALID'),
n AS (
  SELECT (SELECT count(*) FROM c) AS clean,
    (SELECT count(*) FROM c WHERE user_id IS NULL OR created_at IS NULL OR id IS NULL) AS clean_bad,
    (SELECT count(*) FROM checked WHERE status <> 'VALID') AS invalid,
    (SELECT count(*) FROM checked WHERE status <> 'VALID' AND (user_id IS NULL OR id IS NULL))
      AS invalid_bad,
    (SELECT count(*) FROM (SELECT DISTINCT user_id, created_at, id FROM checked
       WHERE user_id IS NOT NULL AND created_at IS NOT NULL AND coalesce(id, '') <> '')) AS gone,
    (SELECT count(*) FROM checked
       WHERE user_id IS NULL OR created_at IS NULL OR coalesce(id, '') = '') AS kept
),
lines AS (
  SELECT 'clean' AS sink, clean AS total, clean_bad AS failed FROM n
  UNION ALL SELECT 'invalid', invalid, invalid_bad FROM n
  UNION ALL SELECT 'deletion', gone + kept, kept FROM n
  UNION ALL SELECT 'overall', clean + invalid, clean_bad + invalid_bad FROM n
)
SELECT sink, CAST(total AS BIGINT) AS total, CAST(total - failed AS BIGINT) AS loaded,
  CAST(failed AS BIGINT) AS failed,
  round(CASE WHEN total = 0 THEN 0 ELSE CAST(total - failed AS DOUBLE) / total * 100.0 END, 2)
    AS success_rate
FROM lines"""

# --- keyed state ----------------------------------------------------------------------------

ORACLES["invalid_state"] = _VALIDATED + """
SELECT user_id, id, CASE WHEN bool_or(TRY_CAST(id AS BIGINT) % 3 = 0) THEN TIMESTAMP '2024-01-25 00:00:00'
                         ELSE TIMESTAMP '2024-01-24 00:00:00' END AS processed_at
FROM checked WHERE status <> 'VALID' GROUP BY user_id, id"""
ORACLES["dedup_hash"] = _with(_BASE) + f"""
SELECT event_id AS id, md5(concat_ws('_', event_id, CAST(user_id AS VARCHAR), session_id,
  event_type, {_text('created_at')}, CAST(coalesce(x, 0) AS VARCHAR),
  CAST(coalesce(y, 0) AS VARCHAR))) AS dedup_hash FROM clean"""

ORACLES["dedup_first_seen"] = _with(_BASE, _COPIES) + f"""
SELECT {_COPY_COLUMNS} FROM (SELECT *, row_number() OVER (
  PARTITION BY id, user_id, session_id, type, created_at, coalesce(x, 0), coalesce(y, 0)
  ORDER BY src, url) AS n FROM copies) WHERE n = 1"""

ORACLES["upsert_last_write_wins"] = _with(_BASE, _COPIES) + f"""
SELECT {_COPY_COLUMNS} FROM (SELECT *, row_number() OVER (
  PARTITION BY user_id, created_at, id ORDER BY src DESC) AS n FROM copies) WHERE n = 1"""

ORACLES["delete_processed"] = _with(_BASE, _RAW) + """
SELECT user_id, created_at, id, type, url FROM raw
WHERE NOT (created_at >= TIMESTAMP '2024-01-24 00:00:00'
           AND created_at < TIMESTAMP '2024-01-25 00:00:00'
           AND user_id IS NOT NULL AND coalesce(id, '') <> '')"""

ORACLES["late_rows"] = _with(_BASE, _RAW) + """
SELECT user_id, created_at, id FROM raw WHERE created_at < TIMESTAMP '2024-01-24 00:00:00'"""

ORACLES["expire_rows"] = _VALIDATED + """
SELECT id, created_at AS processed_at, created_at + INTERVAL 7 DAY AS expires_at FROM checked
WHERE status <> 'VALID' AND created_at + INTERVAL 7 DAY > TIMESTAMP '2024-01-25 00:00:00'"""

ORACLES["latest_snapshot"] = _with(
    _BASE,
    """
one AS (SELECT * FROM clean WHERE created_at >= TIMESTAMP '2024-01-01 00:00:00'
                              AND created_at < TIMESTAMP '2024-01-20 00:00:00'),
two AS (SELECT * FROM clean WHERE created_at >= TIMESTAMP '2024-01-15 00:00:00'
                              AND created_at < TIMESTAMP '2024-01-30 00:00:00')""",
    _activity("one", "a"),
    _activity("two", "b"),
) + """
SELECT *, TIMESTAMP '2024-01-20 00:00:00' AS calculation_timestamp FROM aactivity
WHERE date < DATE '2024-01-15'
UNION ALL
SELECT *, TIMESTAMP '2024-01-30 00:00:00' FROM bactivity"""

# --- ingest ---------------------------------------------------------------------------------

ORACLES["csv_ingest"] = _with(_CSV) + _CSV_SELECT
ORACLES["csv_ingest_two_quotes"] = ORACLES["csv_ingest"]
ORACLES["csv_rejects"] = _with(_CSV) + """
SELECT reason AS reject_reason, CAST(count(*) AS BIGINT) AS events FROM csv
WHERE reason IS NOT NULL GROUP BY reason"""

ORACLES["topic_decode"] = _with(_MESSAGES) + _message_select("topic", True, _RECEIVED)
ORACLES["topic_rejects"] = _with(_MESSAGES) + """
SELECT reason AS reject_reason, CAST(count(*) AS BIGINT) AS events FROM topic
WHERE reason IS NOT NULL GROUP BY reason"""
ORACLES["json_ingest"] = _with(_MESSAGES) + _message_select(
    "bodies", False, "date_trunc('second', ts)"
)
ORACLES["json_rejects"] = _with(_MESSAGES) + """
SELECT reason AS reject_reason, CAST(count(*) AS BIGINT) AS events FROM bodies
WHERE reason IS NOT NULL GROUP BY reason"""

ORACLES["union_feeds"] = _with(_MESSAGES, _CSV) + """,
feeds AS (
  SELECT 'topic' AS source, ts, user_id FROM topic WHERE reason IS NULL
  UNION ALL SELECT 'http', ts, user_id FROM bodies WHERE reason IS NULL
  UNION ALL SELECT 'csv', ts, user_id FROM csv WHERE reason IS NULL
)
SELECT source, CAST(ts AS DATE) AS date, CAST(count(*) AS BIGINT) AS events,
  CAST(count(DISTINCT user_id) AS BIGINT) AS users FROM feeds GROUP BY 1, 2"""

ORACLES["stream_counts"] = _with(_MESSAGES) + """
SELECT 'topic' AS source, CAST(i % 4 AS BIGINT) AS batch_id,
  CAST(count(*) FILTER (reason IS NULL) AS BIGINT) AS accepted,
  CAST(count(*) FILTER (reason IS NOT NULL) AS BIGINT) AS refused,
  round(100.0::DOUBLE * count(*) FILTER (reason IS NULL) / count(*), 2) AS success_rate
FROM topic GROUP BY i % 4"""
ORACLES["stream_replay"] = _with(_MESSAGES) + """
SELECT CAST(i AS VARCHAR) AS id, CAST(user_id AS INT) AS user_id, CAST(1 AS BIGINT) AS copies
FROM topic WHERE reason IS NULL"""

ORACLES["metadata_map"] = """
WITH good AS (SELECT event_id, user_id, regexp_extract(props, '([0-9]+)', 1) AS k FROM events
              WHERE event_id % 5 <> 0 AND event_id % 7 <> 0 AND event_id % 11 <> 0)
SELECT event_id, 'props' AS key, '{"k":' || k || '}' AS value FROM good
UNION ALL SELECT event_id, 'user', CAST(user_id AS VARCHAR) FROM good
UNION ALL SELECT event_id, 'none', 'null' FROM good
UNION ALL SELECT event_id, 'on', 'true' FROM good"""

ORACLES["parse_timestamps"] = """
WITH p AS (SELECT event_id, event_id % 8 AS m, ts, date_trunc('second', ts) AS sec,
                  date_trunc('millisecond', ts) AS milli FROM events)
SELECT event_id,
  CASE m WHEN 2 THEN ts WHEN 3 THEN milli WHEN 6 THEN ts WHEN 7 THEN NULL ELSE sec END
    AS message_time,
  CASE WHEN m IN (0, 1) THEN sec WHEN m = 2 THEN ts END AS csv_time,
  CASE m WHEN 0 THEN sec WHEN 2 THEN ts END AS iso_time
FROM p"""

ORACLES["safe_casts"] = """
SELECT event_id,
  CASE WHEN event_id % 4 IN (0, 1) THEN event_id END AS as_int,
  CASE event_id % 4 WHEN 0 THEN CAST(event_id AS DOUBLE) WHEN 1 THEN CAST(event_id AS DOUBLE)
                    WHEN 2 THEN CAST(event_id AS DOUBLE) + 0.5 END AS as_double,
  CASE event_id % 4 WHEN 0 THEN 'a"b ' || CAST(event_id AS VARCHAR)
                    WHEN 1 THEN CAST(event_id AS VARCHAR) END AS as_string
FROM events"""

ORACLES["stream_ingest_dedup"] = (
    _with(_MESSAGES)
    + "SELECT * EXCLUDE (metadata_k, metadata_even, metadata_pair) FROM ("
    + _message_select("topic", True, _RECEIVED)
    + ")"
)

ORACLES["stream_late_rows"] = """
SELECT CAST(user_id AS INTEGER) AS user_id, ts AS created_at, CAST(event_id AS VARCHAR) AS id FROM events
UNION ALL SELECT CAST(max(user_id) AS INTEGER), TIMESTAMP '2030-01-01 00:00:00', 'ahead' FROM events"""

ORACLES["stream_kept_repeats"] = """
SELECT CAST(user_id AS INTEGER) AS user_id, ts AS created_at, CAST(event_id AS VARCHAR) AS id,
  DATE '2024-01-25' + CAST(event_id % 2 * 10 AS INTEGER) AS arrived_on
FROM events"""

ORACLES["stream_repeats_report"] = """
SELECT CAST(user_id AS INTEGER) AS user_id, count(*) AS held, CAST(0 AS BIGINT) AS dropped_0,
  CAST(0 AS BIGINT) AS dropped_1, (SELECT count(*) FROM events) AS dropped_2
FROM events GROUP BY user_id"""

ORACLES["upsert_with_metadata"] = """
SELECT event_id, 'last' AS k, CAST(event_id AS VARCHAR) AS n, CAST(2 AS INTEGER) AS size FROM events"""

ORACLES["csv_drop_stored"] = ORACLES["csv_stream_stored"] = ORACLES["csv_ingest"]
ORACLES["csv_stream_stored_two_quotes"] = ORACLES["csv_ingest_two_quotes"]
ORACLES["sql_safe_casts"] = ORACLES["safe_casts"]

# --- cleaning jobs --------------------------------------------------------------------------

_CLEANED = _VALIDATED + """
SELECT CAST(user_id AS INTEGER) AS user_id, created_at, id, type, session_id,
  CASE WHEN CAST(id AS BIGINT) % 3 = 0 THEN '/copy' || url ELSE url END AS url,
  device_type, event_title, element_id, x, y, TIMESTAMP '2024-01-25 00:00:00' AS loaded_at
FROM checked WHERE status <> 'INVALID'"""
ORACLES["stream_clean"] = _CLEANED
# A batch run looks at rows before its own time only.
ORACLES["bucketed_state"] = f"""SELECT * EXCLUDE (loaded_at) FROM ({_CLEANED})
WHERE created_at < TIMESTAMP '2024-01-25 00:00:00'"""
ORACLES["clean_resweep"] = _VALIDATED + """
SELECT CAST(user_id AS INTEGER) AS user_id, created_at, id, CAST(count(*) AS BIGINT) AS copies
FROM checked WHERE status <> 'INVALID' AND created_at < TIMESTAMP '2024-01-25 00:00:00'
GROUP BY user_id, created_at, id"""
ORACLES["compact_raw_state"] = _with(_BASE, _RAW) + """
SELECT CAST(user_id AS INTEGER) AS user_id, created_at, id,
  CAST(CASE WHEN created_at < TIMESTAMP '2024-01-23 00:00:00' THEN 1 ELSE 2 * count(*) END AS BIGINT) AS copies
FROM raw WHERE created_at >= TIMESTAMP '2024-01-23 00:00:00' OR user_id IS NULL OR coalesce(id, '') = ''
GROUP BY user_id, created_at, id"""

# --- stored marts ---------------------------------------------------------------------------

# Ten days before the first of the two runs.
_STORED_SINCE = "date >= DATE '2024-01-12'"
ORACLES["stored_user_activity"] = f"SELECT * FROM ({ORACLES['user_activity_daily']}) WHERE {_STORED_SINCE}"
ORACLES["stored_session_metrics"] = f"SELECT * FROM ({ORACLES['session_metrics_daily']}) WHERE {_STORED_SINCE}"
ORACLES["stored_device_distribution"] = (
    f"SELECT * FROM ({ORACLES['device_distribution_daily']}) WHERE {_STORED_SINCE}"
)
ORACLES["stored_top_pages"] = f"SELECT * FROM ({ORACLES['top_pages_daily']}) WHERE {_STORED_SINCE}"
ORACLES["stored_element_conversion"] = ORACLES["element_conversion"].replace(
    _ELEMENTS, _ELEMENTS.replace("FROM cat WHERE", "FROM cat WHERE date >= DATE '2024-01-21' AND")
)

# --- dashboard ------------------------------------------------------------------------------


def _trend(column: str, table: str) -> str:
    return f" SELECT date AS time, {column} FROM {table} {_TREND_SINCE}"


for _name in ("mean", "median"):
    _metric = "avg" if _name == "mean" else _name
    ORACLES[f"dash_{_name}_session_minutes"] = _with(_BASE, _SESSIONS) + _trend(
        f"{_metric}_duration_seconds / 60.0 AS {_metric}_duration_minutes",
        "session_days",
    )
ORACLES["dash_session_counts"] = _with(_BASE, _SESSIONS) + _trend("session_count", "session_days")
for _name in ("dau", "wau", "mau"):
    ORACLES[f"dash_{_name}"] = _with(_BASE, _activity("clean")) + _trend(_name, "activity")
ORACLES["dash_latest_wau"] = _with(_BASE, _activity("clean")) + """
SELECT date AS time, wau FROM activity ORDER BY date DESC LIMIT 1"""

ORACLES["dash_top_pages"] = _with(_BASE, _PAGES) + """
SELECT url, CAST(sum(view_count) AS BIGINT) AS total_views FROM ranked
WHERE date >= DATE '2024-01-30' - 7 AND rank <= 10
GROUP BY url ORDER BY total_views DESC, url LIMIT 10"""

for _name, _column in (("users", "users"), ("events", "events")):
    ORACLES[f"dash_device_{_name}"] = _with(_BASE, _DEVICES) + f"""
SELECT device_type, CAST(sum({_column}) AS BIGINT) AS total_{_name} FROM per_device
WHERE date = DATE '2024-01-30' GROUP BY device_type"""

_VIEWED = "FROM elements WHERE date >= DATE '2024-01-30' - 7 AND views > 0"
_RATIO = "CAST(sum(clicks) AS DOUBLE) / CAST(sum(views) AS DOUBLE) AS conversion_rate"
ORACLES["dash_overall_click_ratio"] = _with(_BASE, _ELEMENTS) + f" SELECT {_RATIO} {_VIEWED}"
ORACLES["dash_element_click_ratio"] = _with(_BASE, _ELEMENTS) + f"""
SELECT element_id, {_RATIO} {_VIEWED} GROUP BY element_id
ORDER BY conversion_rate DESC, element_id LIMIT 20"""

for _name in [n for n in ORACLES if n.startswith("dash_")]:
    ORACLES[f"sql_{_name}"] = ORACLES[_name]
