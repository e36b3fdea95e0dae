"""DuckDB SQL for every catalog query, over the driver's pre-registered views.

The log-shaped inputs are re-derived here from ``events`` with plain SQL
(window ``row_number`` for offsets, JSON functions for payloads), so the
Spark plans are checked against an independent formulation.
"""
from __future__ import annotations

from sluice.plans.catalog import (AS_OF, AS_OF_DATE, CRITICAL_DROP_RATE, ERROR_CAP, WAIT_START,
                                  WAIT_TIMEOUT_HOURS)
from sluice.sources.fixtures import USERS_DECLARED

LONG_RE = "^[+-]?[0-9]+$"
DEC_RE = r"^[+-]?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$"
DATE_RE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
TS_RE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?$"
BOOL_RE = "^(true|false)$"


def safe_long(x: str) -> str:
    return f"(CASE WHEN regexp_matches({x}, '{LONG_RE}') THEN TRY_CAST({x} AS BIGINT) END)"


def _payload(faults: bool) -> str:
    uid = "CAST(event_id AS VARCHAR)"
    city = "('C' || CAST(user_id % 12 AS VARCHAR))"
    dob, ts, amount, extra = "dob_txt", "ts_txt", "amount_txt", "''"
    if faults:
        uid = f"(CASE WHEN m = 11 THEN '\"BAD_ID\"' ELSE {uid} END)"
        dob = "(CASE WHEN m = 12 THEN 'INVALID_DATE' ELSE dob_txt END)"
        ts = "(CASE WHEN m = 13 THEN 'INVALID_TS' ELSE ts_txt END)"
        amount = "(CASE WHEN m = 14 THEN '123456789.129' ELSE amount_txt END)"
        city = f"(CASE WHEN m = 15 THEN repeat('x', 120) ELSE {city} END)"
        extra = "(CASE WHEN m = 16 THEN ',\"Loyalty_Tier\":\"gold\",\"Signup_Day\":\"2024-02-01\"' ELSE '' END)"
    full = (
        "'{\"USER_ID\":' || " + uid +
        " || ',\"First_Name\":\"F' || CAST(user_id AS VARCHAR)"
        " || '\",\"last_name\":\"L' || CAST(event_id % 97 AS VARCHAR)"
        " || '\",\"Email\":\"u' || CAST(event_id AS VARCHAR) || '@example.com'"
        " || '\",\"phone_number\":\"+1555' || lpad(CAST(user_id AS VARCHAR), 7, '0')"
        " || '\",\"ADDRESS\":\"' || CAST(event_id % 1000 AS VARCHAR) || ' Main St\\nApt ' || CAST(user_id AS VARCHAR)"
        " || '\",\"country\":\"' || event_type"
        " || '\",\"City\":\"' || " + city +
        " || '\",\"STATE\":\"S' || CAST(user_id % 50 AS VARCHAR)"
        " || '\",\"registration_date\":\"' || " + ts +
        " || '\",\"date_of_birth\":\"' || " + dob +
        " || '\",\"order_amount\":' || " + amount +
        " || ',\"props\":' || props || " + extra + " || '}'"
    )
    if not faults:
        return full
    return (
        "CASE m WHEN 1 THEN 'not-json' WHEN 2 THEN '{broken json: ' WHEN 3 THEN '' "
        "WHEN 4 THEN 'null' WHEN 5 THEN '[1, 2, 3]' WHEN 6 THEN '{}' WHEN 7 THEN NULL "
        "WHEN 8 THEN '{\"USER_ID\":' || CAST(event_id AS VARCHAR) || ',\"country\":\"' || event_type || '\"}' "
        "WHEN 9 THEN '{\"USER_ID\":' || CAST(event_id AS VARCHAR) || ',\"First_Name\":null,\"City\":null,\"order_amount\":null}' "
        "WHEN 10 THEN '{\"USER_ID\":' || CAST(event_id AS VARCHAR) || ',\"City\":\"first\",\"CITY\":\"second\",\"country\":\"' || event_type || '\"}' "
        f"ELSE {full} END"
    )


def _pick(col: str) -> str:
    """Last key equal to ``col`` ignoring case, as text (NULL if absent)."""
    return (f"(CASE WHEN is_obj THEN json_extract_string(value, '$.\"' || "
            f"list_filter(ks, lambda k: lower(k) = '{col}')[-1] || '\"') END)")


def _typed(col: str, typ: str) -> str:
    raw = f"raw_{col}"
    if typ == "bigint":
        return safe_long(raw)
    if typ.startswith("decimal"):
        return f"(CASE WHEN regexp_matches({raw}, '{DEC_RE}') THEN TRY_CAST({raw} AS DECIMAL(10,2)) END)"
    if typ == "date":
        return f"(CASE WHEN regexp_matches({raw}, '{DATE_RE}') THEN TRY_CAST({raw} AS DATE) END)"
    if typ == "timestamp_ntz":
        return f"(CASE WHEN regexp_matches({raw}, '{TS_RE}') THEN TRY_CAST({raw} AS TIMESTAMP) END)"
    if col == "address":
        return f"regexp_replace({raw}, '\\r?\\n', ', ', 'g')"
    return raw


def _kind(typ: str) -> str:
    if typ.startswith("decimal"):
        return "decimal"
    return {"timestamp_ntz": "timestamp"}.get(typ, typ)


def _reasons() -> str:
    rs = ["CASE WHEN value IS NULL THEN 'null_value' END",
          "CASE WHEN value IS NOT NULL AND NOT is_obj THEN 'not_an_object' END"]
    for col, typ, n in USERS_DECLARED:
        if typ != "string":
            rs.append(f"CASE WHEN raw_{col} IS NOT NULL AND {col} IS NULL THEN '{col}:invalid_{_kind(typ)}' END")
        if n is not None:
            rs.append(f"CASE WHEN length({col}) > {n} THEN '{col}:too_long' END")
    return "list_filter([" + ", ".join(rs) + "], lambda x: x IS NOT NULL)"


DECLARED_NAMES = ", ".join(f"'{c}'" for c, _, _ in USERS_DECLARED)

CTES: dict[str, tuple[str, tuple[str, ...]]] = {
    "log_src": (f"""
  SELECT event_id, ts, user_id, event_type, value, props,
         event_type || '_events' AS topic,
         CAST(user_id % 3 AS INTEGER) AS "partition",
         CAST(row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY event_id) - 1 AS BIGINT) AS "offset",
         CAST(user_id AS VARCHAR) AS "key",
         ts AS "timestamp",
         CAST(epoch_us(ts) // 1000 + event_id % 5000 AS BIGINT) AS push_time,
         CAST(event_id % 50 AS INTEGER) AS m,
         CAST(CAST(DATE '1944-01-01' + CAST((user_id * 173) % 22000 AS INTEGER) AS DATE) AS VARCHAR) AS dob_txt,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ts_txt,
         printf('%.2f', value) AS amount_txt
  FROM events""", ()),
    "log_records": (f"""
  SELECT topic, "partition", "offset", "key", {_payload(False)} AS value, "timestamp", push_time
  FROM log_src""", ("log_src",)),
    "log_records_bad": (f"""
  SELECT topic, "partition", "offset", "key", {_payload(True)} AS value, "timestamp", push_time
  FROM log_src""", ("log_src",)),
    "log_records_dup": (f"""
  SELECT topic, "partition", "offset", "key", {_payload(False)} AS value, "timestamp", push_time FROM log_src
  UNION ALL
  SELECT topic, "partition", "offset", "key", {_payload(False)} AS value, "timestamp", push_time + 1000 FROM log_src WHERE event_id % 10 = 0""",
                        ("log_src",)),
    "users_landed": (f"""
  SELECT CAST(event_id AS BIGINT) AS user_id,
         'F' || CAST(user_id AS VARCHAR) AS first_name,
         'L' || CAST(event_id % 97 AS VARCHAR) AS last_name,
         'u' || CAST(event_id AS VARCHAR) || '@example.com' AS email,
         '+1555' || lpad(CAST(user_id AS VARCHAR), 7, '0') AS phone_number,
         CAST(event_id % 1000 AS VARCHAR) || ' Main St, Apt ' || CAST(user_id AS VARCHAR) AS address,
         'C' || CAST(user_id % 12 AS VARCHAR) AS city,
         'S' || CAST(user_id % 50 AS VARCHAR) AS state,
         event_type AS country,
         CAST(DATE '1944-01-01' + CAST((user_id * 173) % 22000 AS INTEGER) AS DATE) AS date_of_birth,
         ts AS registration_date,
         CAST(value AS DECIMAL(10,2)) AS order_amount,
         TIMESTAMP '{AS_OF}' AS ingestion_time
  FROM events""", ()),
    "bad_obj": ("""
  SELECT topic, "partition", "offset", "key", value, push_time,
         CASE WHEN json_valid(value) THEN json_type(value) = 'OBJECT' ELSE false END AS is_obj
  FROM log_records_bad""", ("log_records_bad",)),
    "bad_keys": ("""
  SELECT *, CASE WHEN is_obj THEN json_keys(value) END AS ks FROM bad_obj""", ("bad_obj",)),
    "bad_raw": ("SELECT *, " + ", ".join(f"{_pick(c)} AS raw_{c}" for c, _, _ in USERS_DECLARED)
                + " FROM bad_keys", ("bad_keys",)),
    "bad_typed": ("SELECT *, " + ", ".join(f"{_typed(c, t)} AS {c}" for c, t, _ in USERS_DECLARED)
                  + " FROM bad_raw", ("bad_raw",)),
    "bad_validated": (f"SELECT *, {_reasons()} AS reasons FROM bad_typed", ("bad_typed",)),
    "progress": ("""
  SELECT topic, "partition",
         CASE WHEN "partition" = 2 THEN NULL ELSE CAST(floor(max("offset") / 2) AS BIGINT) END AS committed
  FROM log_src GROUP BY topic, "partition\"""", ("log_src",)),
    "cs_hourly": ("""
  SELECT 'CH_P' || CAST("partition" AS VARCHAR) AS channel, "partition",
         date_trunc('hour', "timestamp") AS poll_ts,
         max("offset") AS hour_max_offset, count(*) AS n,
         count(*) FILTER (WHERE event_type = 'error' AND value > 150) AS n_err,
         max(CASE WHEN event_type = 'error' AND value > 150 THEN "offset" END) AS err_max_offset,
         avg(event_id % 5000) AS lat, avg(value) AS dur,
         count(*) FILTER (WHERE event_type = 'view' AND value > 250) AS bp
  FROM log_src GROUP BY 1, 2, 3""", ("log_src",)),
    "cs_run": ("""
  SELECT *,
         max(hour_max_offset) OVER w AS sent_offset,
         sum(n_err) OVER w AS rows_error_count,
         sum(n - n_err) OVER w AS rows_inserted_count,
         sum(bp) OVER w AS backpressure_rewind_count,
         sum(CASE WHEN n_err >= 1 AND n % 2 = 0 THEN 1 ELSE 0 END) OVER w AS channel_recovery_count,
         max(err_max_offset) OVER w AS err_upper
  FROM cs_hourly
  WINDOW w AS (PARTITION BY channel ORDER BY poll_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
               ("cs_hourly",)),
    "cs_prev": ("""
  SELECT *, lag(sent_offset) OVER (PARTITION BY channel ORDER BY poll_ts) AS prev_sent FROM cs_run""",
                ("cs_run",)),
    "cs_comm": ("""
  SELECT *, max(CASE WHEN hour(poll_ts) % 3 = 0 THEN prev_sent END) OVER (
             PARTITION BY channel ORDER BY poll_ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS committed_num
  FROM cs_prev""", ("cs_prev",)),
    "channel_status": ("""
  SELECT channel, poll_ts,
         CASE WHEN n_err >= 1 THEN 'ERR_CHANNEL_INVALID_ROWS' ELSE 'SUCCESS' END AS status_code,
         CAST(sent_offset AS BIGINT) AS sent_offset,
         CAST(sent_offset + n % 7 AS BIGINT) AS latest_consumer_offset,
         CASE WHEN channel = 'CH_P1' AND day(poll_ts) = 2 AND hour(poll_ts) = 5 THEN 'n/a'
              ELSE CAST(committed_num AS VARCHAR) END AS committed_token,
         CAST(rows_inserted_count AS BIGINT) AS rows_inserted_count,
         CAST(rows_error_count AS BIGINT) AS rows_error_count,
         round(lat, 3) AS avg_latency_ms,
         CASE WHEN rows_error_count > 0 THEN 'invalid row at offset ' || CAST(err_upper AS VARCHAR) END
              AS last_error_message,
         CAST(err_upper AS VARCHAR) AS last_error_offset_token_upper_bound,
         CAST(n AS BIGINT) AS put_records,
         round(dur, 3) AS put_duration_ms,
         CAST(backpressure_rewind_count AS BIGINT) AS backpressure_rewind_count,
         CAST(channel_recovery_count AS BIGINT) AS channel_recovery_count,
         CAST("partition" % 2 AS INTEGER) AS task_id,
         'client_' || CAST("partition" % 2 AS VARCHAR) AS client,
         'USERS' AS target_table
  FROM cs_comm""", ("cs_comm",)),
    "tower_daily": ("""
  SELECT 'TOWER_' || lpad(CAST(user_id % 12 AS VARCHAR), 2, '0') AS tower, CAST(ts AS DATE) AS day,
         count(*) AS call_volume,
         count(*) FILTER (WHERE event_type = 'error') AS dropped_calls,
         count(*) FILTER (WHERE event_type = 'error') / count(*) AS drop_rate,
         sum(value) AS data_usage_mb
  FROM events GROUP BY 1, 2""", ()),
    "growth": ("""
  SELECT channel, poll_ts, rows_error_count,
         lag(rows_error_count) OVER w AS prev_error_count,
         COALESCE(rows_error_count > lag(rows_error_count) OVER w, false) AS abort
  FROM channel_status WINDOW w AS (PARTITION BY channel ORDER BY poll_ts)""", ("channel_status",)),
    "lagv": (f"""
  SELECT channel, poll_ts, sent_highest, committed_token,
         sent_highest - {safe_long('committed_token')} AS offset_lag
  FROM (SELECT *, CAST(greatest(0, max(sent_offset) OVER (PARTITION BY channel ORDER BY poll_ts
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) AS BIGINT) AS sent_highest
        FROM channel_status)""", ("channel_status",)),
    "fits": ("""
  SELECT tower, max(x) AS last_index, max(day) AS last_day,
         regr_slope(drop_rate, x) AS dr_s, regr_intercept(drop_rate, x) AS dr_i,
         regr_slope(CAST(call_volume AS DOUBLE), x) AS cv_s, regr_intercept(CAST(call_volume AS DOUBLE), x) AS cv_i,
         regr_slope(data_usage_mb, x) AS du_s, regr_intercept(data_usage_mb, x) AS du_i
  FROM (SELECT *, CAST(date_diff('day', DATE '2024-01-01', day) AS DOUBLE) AS x FROM tower_daily)
  GROUP BY tower""", ("tower_daily",)),
    "fc": ("""
  SELECT tower, CAST(h AS INTEGER) AS h, CAST(last_day + CAST(h AS INTEGER) AS DATE) AS forecast_day,
         round(least(1.0, greatest(0.0, dr_i + dr_s * (last_index + h))), 6) AS drop_rate_fc,
         round(greatest(0.0, cv_i + cv_s * (last_index + h)), 6) AS call_volume_fc,
         round(greatest(0.0, du_i + du_s * (last_index + h)), 6) AS data_usage_fc
  FROM fits, range(1, 8) r(h)""", ("fits",)),
    "kv": ("""
  SELECT k AS "key", json_extract_string(value, '$."' || k || '"') AS v
  FROM (SELECT value, unnest(json_keys(value)) AS k FROM bad_obj WHERE is_obj)""", ("bad_obj",)),
    "inferred": (f"""
  SELECT "key",
         CASE WHEN bool_and(regexp_matches(v, '{LONG_RE}')) THEN 'BIGINT'
              WHEN bool_and(regexp_matches(v, '{DEC_RE}')) THEN 'DECIMAL'
              WHEN bool_and(regexp_matches(v, '{BOOL_RE}')) THEN 'BOOLEAN'
              WHEN bool_and(regexp_matches(v, '{DATE_RE}') AND TRY_CAST(v AS DATE) IS NOT NULL) THEN 'DATE'
              WHEN bool_and(regexp_matches(v, '{TS_RE}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'TIMESTAMP'
              WHEN bool_and(starts_with(v, '{{')) THEN 'OBJECT'
              WHEN bool_and(starts_with(v, '[')) THEN 'ARRAY'
              ELSE 'VARCHAR' END AS inferred_type,
         count(*) AS n_values
  FROM kv WHERE v IS NOT NULL GROUP BY "key\"""", ("kv",)),
    "envelopes": ("""
  SELECT topic, "offset", push_time, value AS body_text,
         '{"meta":{"offset":' || "offset" || ',"tags":["' || topic || '","p' || "partition" || '"],"pushes":[{"ms":'
         || push_time || '}]},"body":' || value || '}' AS value
  FROM bad_obj WHERE is_obj""", ("bad_obj",)),
    "path_nodes": ("""
  SELECT regexp_replace(regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[]', 'g'), '^\\$\\.', '') AS path, t.type AS kind,
         CASE WHEN t.type IN ('OBJECT', 'ARRAY') THEN CAST(t.value AS VARCHAR) ELSE json_extract_string(t.atom, '$') END AS v
  FROM envelopes e, json_tree(e.value) t WHERE t.fullkey <> '$' AND t.type <> 'NULL'""", ("envelopes",)),
    "path_types": (f"""
  SELECT path,
         CASE WHEN bool_and(kind = 'OBJECT') THEN 'OBJECT'
              WHEN bool_and(kind = 'ARRAY') THEN 'ARRAY'
              WHEN bool_or(kind IN ('OBJECT', 'ARRAY')) THEN 'VARCHAR'
              WHEN bool_and(regexp_matches(v, '{LONG_RE}')) THEN 'BIGINT'
              WHEN bool_and(regexp_matches(v, '{DEC_RE}')) THEN 'DECIMAL'
              WHEN bool_and(regexp_matches(v, '{BOOL_RE}')) THEN 'BOOLEAN'
              WHEN bool_and(regexp_matches(v, '{DATE_RE}') AND TRY_CAST(v AS DATE) IS NOT NULL) THEN 'DATE'
              WHEN bool_and(regexp_matches(v, '{TS_RE}') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) THEN 'TIMESTAMP'
              ELSE 'VARCHAR' END AS inferred_type,
         count(*) AS n_values
  FROM path_nodes GROUP BY path""", ("path_nodes",)),
}


def with_ctes(body: str, *names: str, local: tuple[tuple[str, str], ...] = ()) -> str:
    order: list[str] = []

    def visit(n):
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS ({CTES[n][0]}\n)" for n in order] + [f"{n} AS ({s})" for n, s in local]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


AGE = f"CAST(year(DATE '{AS_OF_DATE}') - year(date_of_birth) AS INTEGER)"
AGE_GROUP = (f"CASE WHEN {AGE} < 25 THEN '18-24' WHEN {AGE} < 35 THEN '25-34' WHEN {AGE} < 45 THEN '35-44' "
             f"WHEN {AGE} < 55 THEN '45-54' WHEN {AGE} < 65 THEN '55-64' ELSE '65+' END")
USERS_COLS = ("user_id, first_name, last_name, email, phone_number, address, city, state, country, "
              "date_of_birth, registration_date, CAST(order_amount AS DOUBLE) AS order_amount, ingestion_time")
LIMITED = [(c, n) for c, _, n in USERS_DECLARED if n is not None]
DUP_COLS = 'topic, "partition", "offset", "key", "value", "timestamp", push_time'
SAME = 'p.topic = t.topic AND p."partition" = t."partition"'
ISLANDS = (("present", """
SELECT DISTINCT topic, "partition", "offset" FROM log_records_dup
WHERE NOT (("partition" = 1 AND "offset" % 40 = 17) OR ("partition" = 2 AND "offset" % 500 = 100))"""),
           ("islands", """
SELECT topic, "partition", min("offset") AS lo, max("offset") AS hi FROM (
  SELECT *, "offset" - row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS g FROM present)
GROUP BY topic, "partition", g"""))
STARTS = (*ISLANDS, ("starts", """
SELECT topic, "partition", min(lo) AS first_offset, max(hi) AS highest_offset, count(*) AS n_intervals,
       coalesce(any_value(committed) + 1, min(lo)) AS s
FROM islands LEFT JOIN progress USING (topic, "partition") GROUP BY topic, "partition\""""),
          ("free", f"""
SELECT t.* FROM (SELECT topic, "partition", "offset" + 1 AS x FROM present UNION SELECT topic, "partition", s FROM starts) t
WHERE NOT EXISTS (SELECT 1 FROM present p WHERE {SAME} AND p."offset" = t.x)"""))
SAFE_TOKEN = safe_long("committed_token")


def _null_profile() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS null_count FROM bad_typed"
        for c, _, _ in USERS_DECLARED)


def _declared_values() -> str:
    return ", ".join(f"('{c}', '{t.upper()}', false)" for c, t, _ in USERS_DECLARED)


SQL: dict[str, str] = {
    "land_by_name": with_ctes(f"SELECT {USERS_COLS} FROM users_landed", "users_landed"),
    "sample_rows": with_ctes(f"SELECT {USERS_COLS} FROM users_landed ORDER BY user_id LIMIT 10", "users_landed"),
    "channel_assignment": with_ctes("""
SELECT topic, "partition", count(*) AS n_rows, min("offset") AS first_offset, max("offset") AS last_offset,
       upper(topic) || '_P' || CAST("partition" AS VARCHAR) AS channel
FROM log_src GROUP BY topic, "partition\"""", "log_src"),
    "committed_offsets": with_ctes("""
SELECT topic, "partition", CAST(max("offset") + 1 AS BIGINT) AS next_offset, count(*) AS landed_rows
FROM log_src GROUP BY topic, "partition\"""", "log_src"),
    "advanced_commits": with_ctes(f"""
SELECT channel, poll_ts, committed_token, {SAFE_TOKEN} + 1 AS commit_offset
FROM (SELECT *, last_value(committed_token IGNORE NULLS) OVER (
        PARTITION BY channel ORDER BY poll_ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev
      FROM channel_status)
WHERE committed_token IS NOT NULL AND committed_token IS DISTINCT FROM prev""", "channel_status"),
    "resume_from_committed": with_ctes("""
SELECT topic, "partition", min("offset") AS resume_offset, count(*) AS pending_rows, max(committed) AS committed
FROM log_src LEFT JOIN progress USING (topic, "partition")
WHERE committed IS NULL OR "offset" > committed
GROUP BY topic, "partition\"""", "log_src", "progress"),
    "commit_wait": with_ctes(f"""
SELECT channel, target_offset, committed_at,
       CASE WHEN committed_at <= TIMESTAMP '{WAIT_START}' + INTERVAL {WAIT_TIMEOUT_HOURS} HOUR
            THEN 'committed' ELSE 'timed_out' END AS wait_status
FROM targets LEFT JOIN reached USING (channel)""", "channel_status", local=(
        ("targets", f"SELECT channel, max(sent_offset) AS target_offset FROM channel_status "
                    f"WHERE poll_ts <= TIMESTAMP '{WAIT_START}' GROUP BY channel"),
        ("reached", f"SELECT channel, min(poll_ts) AS committed_at FROM channel_status JOIN targets USING (channel) "
                    f"WHERE poll_ts >= TIMESTAMP '{WAIT_START}' AND {SAFE_TOKEN} >= target_offset GROUP BY channel"))),
    "route_topics": with_ctes("""
SELECT topic,
       CASE WHEN topic = 'signup_events' THEN 'SIGNUPS'
            WHEN topic = 'purchase_events' THEN 'ORDERS'
            WHEN topic = 'view_events' THEN 'ORDERS'
            WHEN regexp_full_match(topic, 'c.*_events') THEN 'CLICKSTREAM'
            ELSE upper(regexp_replace(topic, '[^A-Za-z0-9_]', '_', 'g')) END AS target_table,
       count(*) AS n_records
FROM log_src GROUP BY 1, 2""", "log_src"),
    "error_cap": with_ctes(f"""
SELECT topic, "partition", max(stop_offset) AS stop_offset, count(*) AS rows_sent,
       count(*) FILTER (WHERE len(reasons) > 0) AS errors_seen
FROM bad_validated LEFT JOIN stops USING (topic, "partition")
WHERE stop_offset IS NULL OR "offset" <= stop_offset
GROUP BY topic, "partition\"""", "bad_validated", local=(
        ("stops", f"""SELECT topic, "partition", "offset" AS stop_offset FROM (
            SELECT topic, "partition", "offset",
                   row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS rn
            FROM bad_validated WHERE len(reasons) > 0) WHERE rn = {ERROR_CAP}"""),)),
    "parse_or_raw": with_ctes("""
SELECT topic, "partition", "offset", is_obj AS is_object,
       CASE WHEN NOT is_obj THEN value END AS raw_data,
       CASE WHEN is_obj THEN CAST(len(ks) AS INTEGER) END AS n_keys
FROM bad_keys""", "bad_keys"),
    "pipe_transform": with_ctes("""
SELECT event_id AS order_id, 'F' || CAST(user_id AS VARCHAR) AS customer_name,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS order_total, topic AS source_topic, "offset" AS kafka_offset
FROM log_src WHERE CAST(value AS DECIMAL(10,2)) > 100""", "log_src"),
    "json_paths": with_ctes("""
SELECT topic, "partition", "offset", CAST(json_extract_string(props, '$.k') AS INTEGER) AS props_k,
       'u' || CAST(event_id AS VARCHAR) || '@example.com' AS email, event_type AS country
FROM log_src""", "log_src"),
    "mask_columns": with_ctes("""
SELECT user_id, regexp_replace(email, '^[^@]*@', '***@') AS email,
       CASE WHEN length(phone_number) <= 4 THEN phone_number
            ELSE repeat('*', length(phone_number) - 4) || right(phone_number, 4) END AS phone_number,
       sha256(first_name) AS first_name
FROM users_landed""", "users_landed"),
    "record_metadata": with_ctes("""
SELECT topic AS meta_topic, CAST("partition" AS VARCHAR) AS meta_partition, "offset" AS meta_offset,
       CAST(epoch_us("timestamp") // 1000 AS BIGINT) AS meta_create_time, push_time AS meta_push_time,
       "key" AS meta_key
FROM log_src""", "log_src"),
    "sanitize_table_names": """
SELECT raw_topic, count(*) AS n_records, upper(regexp_replace(raw_topic, '[^A-Za-z0-9_]', '_', 'g')) AS table_name
FROM (SELECT event_type || '-prod.v' || CAST(user_id % 3 AS VARCHAR) AS raw_topic FROM events)
GROUP BY raw_topic""",
    "age_groups": with_ctes(f"""
SELECT user_id, date_of_birth, {AGE} AS age, {AGE_GROUP} AS age_group FROM users_landed""", "users_landed"),
    "semantic_filtered": with_ctes("""
SELECT city, count(user_id) AS total_users, CAST(sum(order_amount) AS DOUBLE) AS total_revenue
FROM users_landed WHERE state = 'S7' GROUP BY city""", "users_landed"),
    "validate_types": with_ctes("""
SELECT topic, "partition", "offset", array_to_string(tl, ';') AS type_errors, CAST(len(tl) AS INTEGER) AS n_type_errors
FROM (SELECT *, list_filter(reasons, lambda x: contains(x, ':invalid_')) AS tl FROM bad_validated)
WHERE len(tl) > 0""", "bad_validated"),
    "validate_lengths": with_ctes(
        "SELECT topic, \"partition\", \"offset\", array_to_string(ol, ';') AS too_long_columns, "
        "CAST(greatest(" + ", ".join(f"length({c})" for c, _ in LIMITED) + ") AS INTEGER) AS max_length_seen "
        "FROM (SELECT *, list_filter([" +
        ", ".join(f"CASE WHEN length({c}) > {n} THEN '{c}' END" for c, n in LIMITED) +
        "], lambda x: x IS NOT NULL) AS ol FROM bad_validated) WHERE len(ol) > 0", "bad_validated"),
    "error_table": with_ctes("""
SELECT topic, "partition", "offset", array_to_string(reasons, ';') AS error_reasons,
       CAST(len(reasons) AS INTEGER) AS n_reasons, make_timestamp(push_time * 1000) AS error_timestamp
FROM bad_validated WHERE len(reasons) > 0""", "bad_validated"),
    "recent_errors": with_ctes("""
SELECT topic, "partition", "offset", array_to_string(reasons, ';') AS error_reasons,
       CAST(len(reasons) AS INTEGER) AS n_reasons, make_timestamp(push_time * 1000) AS error_timestamp
FROM bad_validated WHERE len(reasons) > 0
ORDER BY error_timestamp DESC, topic, "partition", "offset" LIMIT 20""", "bad_validated"),
    "dead_letters": with_ctes("""
SELECT topic, "partition", "offset", "key", value, reasons[1] AS dlq_reason
FROM bad_validated WHERE len(reasons) > 0""", "bad_validated"),
    "infer_types": with_ctes('SELECT "key", inferred_type, n_values FROM inferred', "inferred"),
    "record_content": with_ctes("""
SELECT '{' || string_agg(CAST(to_json(k) AS VARCHAR) || ':' || regexp_replace(CAST(json_extract(value, '$."' || k || '"') AS VARCHAR), '^(-?[0-9]+)\\.0$', '\\1'), ',' ORDER BY k)
       || '}' AS record_content, topic AS meta_topic, "offset" AS meta_offset
FROM (SELECT topic, "partition", "offset", value, unnest(json_keys(value)) AS k FROM log_records)
GROUP BY topic, "partition", "offset\"""", "log_records"),
    "infer_paths": with_ctes("SELECT path, inferred_type, n_values FROM path_types", "path_types"),
    "land_nested": with_ctes("""
SELECT "offset" AS meta_offset, topic AS first_tag, push_time AS push_ms,
       TRY_CAST(json_extract_string(body_text, '$.props.k') AS BIGINT) AS props_k,
       json_extract_string(body_text, '$.date_of_birth') AS date_of_birth
FROM envelopes""", "envelopes"),
    "evolve_schema": with_ctes(f"""
SELECT * FROM (VALUES {_declared_values()}) t(column_name, data_type, is_new)
UNION ALL
SELECT lower("key") AS column_name,
       CASE WHEN count(DISTINCT inferred_type) = 1 THEN min(inferred_type) ELSE 'VARCHAR' END AS data_type,
       true AS is_new
FROM inferred WHERE lower("key") NOT IN ({DECLARED_NAMES}) GROUP BY lower("key")""", "inferred"),
    "unknown_fields": with_ctes(f"""
SELECT k AS unknown_key, count(*) AS n_records
FROM (SELECT unnest(json_keys(value)) AS k FROM bad_obj WHERE is_obj)
WHERE lower(k) NOT IN ({DECLARED_NAMES}) GROUP BY k""", "bad_obj"),
    "null_profile": with_ctes(_null_profile(), "bad_typed"),
    "malformed_classes": with_ctes("""
SELECT CASE WHEN value IS NULL THEN 'tombstone'
            WHEN trim(value) = '' THEN 'empty'
            WHEN is_obj THEN 'object'
            WHEN trim(value) = 'null' THEN 'null_literal'
            WHEN starts_with(trim(value), '[') THEN 'array'
            WHEN starts_with(trim(value), '{') THEN 'broken'
            ELSE 'text' END AS payload_class,
       count(*) AS n_records
FROM bad_obj GROUP BY 1""", "bad_obj"),
    "dedup_keep_first": with_ctes(f"""
SELECT {DUP_COLS} FROM (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY push_time) AS rn
  FROM log_records_dup) WHERE rn = 1""", "log_records_dup"),
    "drop_duplicated_keys": with_ctes(f"""
SELECT {DUP_COLS} FROM log_records_dup d
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT topic, "partition", "offset",
                        row_number() OVER (PARTITION BY topic, "partition", "offset" ORDER BY "offset") AS rn
                 FROM log_records_dup) x
  WHERE x.rn > 1 AND x.topic = d.topic AND x."partition" = d."partition" AND x."offset" = d."offset")""",
                                      "log_records_dup"),
    "duplicate_groups": with_ctes("""
SELECT topic, "partition", "offset", count(*) AS copies, min(push_time) AS first_push_time,
       max(push_time) AS last_push_time
FROM log_records_dup GROUP BY topic, "partition", "offset" HAVING count(*) > 1""", "log_records_dup"),
    "distinct_copy": with_ctes(f"""
SELECT DISTINCT {DUP_COLS} FROM log_records_dup""", "log_records_dup"),
    "row_count": with_ctes("SELECT count(*) AS total_rows FROM users_landed", "users_landed"),
    "dashboard_totals": with_ctes("""
SELECT count(*) AS total_rows, CAST(COALESCE(sum(order_amount), 0) AS DOUBLE) AS total_revenue
FROM users_landed""", "users_landed"),
    "dashboard_latest": with_ctes("""
SELECT max(user_id) AS latest_id, count(DISTINCT country) AS unique_countries FROM users_landed""",
                                  "users_landed"),
    "top_countries": with_ctes("""
SELECT country, CAST(sum(order_amount) AS DOUBLE) AS revenue FROM users_landed
GROUP BY country ORDER BY revenue DESC, country LIMIT 10""", "users_landed"),
    "run_summary": with_ctes("""
SELECT count(*) AS total_rows, CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
       count(DISTINCT country) AS unique_countries, min(registration_date) AS first_record,
       max(registration_date) AS last_record
FROM users_landed""", "users_landed"),
    "recent_records": with_ctes("""
SELECT user_id, first_name, last_name, email, country, CAST(order_amount AS DOUBLE) AS order_amount
FROM users_landed ORDER BY user_id DESC LIMIT 20""", "users_landed"),
    "cumulative_revenue": with_ctes("""
SELECT date_trunc('second', registration_date) AS time_bucket,
       CAST(sum(sum(order_amount)) OVER (ORDER BY date_trunc('second', registration_date)) AS DOUBLE)
         AS cumulative_revenue
FROM users_landed GROUP BY 1""", "users_landed"),
    "semantic_totals": with_ctes("""
SELECT count(user_id) AS total_users, CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
       round(CAST(avg(order_amount) AS DOUBLE), 4) AS avg_order_value,
       CAST(max(order_amount) AS DOUBLE) AS max_order, CAST(min(order_amount) AS DOUBLE) AS min_order,
       count(DISTINCT country) AS unique_countries, count(DISTINCT city) AS unique_cities,
       count(DISTINCT state) AS unique_states
FROM users_landed""", "users_landed"),
    "semantic_by_country": with_ctes("""
SELECT country, CAST(sum(order_amount) AS DOUBLE) AS total_revenue, count(user_id) AS total_users
FROM users_landed GROUP BY country ORDER BY total_revenue DESC, country LIMIT 5""", "users_landed"),
    "semantic_by_age_group": with_ctes(f"""
SELECT {AGE_GROUP} AS age_group, count(user_id) AS total_users,
       round(CAST(avg(order_amount) AS DOUBLE), 4) AS avg_order_value
FROM users_landed GROUP BY 1""", "users_landed"),
    "semantic_by_hour": with_ctes("""
SELECT date_trunc('hour', registration_date) AS registration_hour, count(user_id) AS total_users,
       CAST(sum(order_amount) AS DOUBLE) AS total_revenue
FROM users_landed GROUP BY 1""", "users_landed"),
    "channel_status": with_ctes("""
SELECT upper(topic) || '_P' || CAST("partition" AS VARCHAR) AS channel,
       count(*) FILTER (WHERE len(reasons) = 0) AS rows_inserted_count,
       count(*) FILTER (WHERE len(reasons) > 0) AS rows_error_count,
       arg_max(reasons[1], "offset") FILTER (WHERE len(reasons) > 0) AS last_error_message,
       CAST(max("offset") FILTER (WHERE len(reasons) > 0) AS VARCHAR) AS last_error_offset_token_upper_bound,
       CAST(max("offset") AS VARCHAR) AS latest_offset_token
FROM bad_validated GROUP BY topic, "partition\"""", "bad_validated"),
    "tower_daily": with_ctes("""
SELECT tower, day, call_volume, dropped_calls, round(drop_rate, 6) AS drop_rate,
       round(data_usage_mb, 4) AS data_usage_mb
FROM tower_daily""", "tower_daily"),
    "latency_profile": with_ctes("""
SELECT task_id, round(quantile_cont(put_duration_ms, 0.99), 3) AS put_duration_p99,
       round(avg(avg_latency_ms), 3) AS avg_latency_ms
FROM channel_status GROUP BY task_id""", "channel_status"),
    "rollup_users_daily": with_ctes("""
SELECT CAST(registration_date AS DATE) AS day, count(*) AS n_rows, count(DISTINCT country) AS unique_countries
FROM users_landed GROUP BY 1""", "users_landed"),
    "error_growth": with_ctes("SELECT * FROM growth", "growth"),
    "offset_lag": with_ctes("SELECT * FROM lagv", "lagv"),
    "metric_growth": with_ctes(f"""
SELECT channel, poll_ts,
       COALESCE(ingestion_lag - lag(ingestion_lag) OVER w > 0, false) AS lag_growing,
       COALESCE(backpressure_rewind_count - lag(backpressure_rewind_count) OVER w > 0, false) AS backpressure_growing,
       COALESCE(channel_recovery_count - lag(channel_recovery_count) OVER w > 0, false) AS recovery_growing
FROM (SELECT *, latest_consumer_offset - {SAFE_TOKEN} AS ingestion_lag FROM channel_status)
WINDOW w AS (PARTITION BY channel ORDER BY poll_ts)""", "channel_status"),
    "abort_point": with_ctes("""
SELECT channel, min(g.poll_ts) AS abort_ts, arg_min(sent_highest, g.poll_ts) AS sent_highest,
       arg_min(sent_highest, g.poll_ts) + 1 AS next_unsent_offset
FROM growth g JOIN lagv l USING (channel, poll_ts) WHERE abort GROUP BY channel""", "growth", "lagv"),
    "ingestion_lag": with_ctes(f"""
SELECT channel, poll_ts, latest_consumer_offset, {SAFE_TOKEN} AS persisted_offset,
       latest_consumer_offset - {SAFE_TOKEN} AS ingestion_lag
FROM channel_status""", "channel_status"),
    "unhealthy_channels": with_ctes("""
SELECT channel, time_bucket(INTERVAL 30 SECOND, poll_ts) AS check_period, arg_max(status_code, poll_ts) AS last_status,
       max(poll_ts) AS last_poll_ts
FROM channel_status GROUP BY 1, 2 HAVING arg_max(status_code, poll_ts) IS DISTINCT FROM 'SUCCESS'""", "channel_status"),
    "slowest_rows": with_ctes(f"""
SELECT topic, "partition", "offset", epoch_ms(TIMESTAMP '{AS_OF}') - push_time AS latency_ms
FROM log_src ORDER BY latency_ms DESC, topic, "partition", "offset" LIMIT 10""", "log_src"),
    "throughput": with_ctes("""
SELECT date_trunc('hour', "timestamp") AS window_start, topic, count(*) AS n_records,
       round(count(*) / 3600, 6) AS records_per_sec
FROM log_src GROUP BY 1, 2""", "log_src"),
    "assigned_partitions": with_ctes("""
SELECT task_id, count(DISTINCT channel) AS assigned_partitions FROM channel_status GROUP BY task_id""",
                                     "channel_status"),
    "client_leaks": with_ctes("""
SELECT count(DISTINCT client) AS clients, count(DISTINCT target_table) AS tables,
       count(DISTINCT client) > count(DISTINCT target_table) AS leak_suspected
FROM channel_status""", "channel_status"),
    "tower_forecast": with_ctes("SELECT * FROM fc", "fc"),
    "critical_towers": with_ctes(f"""
SELECT tower, round(avg(drop_rate_fc), 6) AS avg_drop_rate_fc, round(sum(data_usage_fc), 4) AS total_usage_fc,
       round(avg(drop_rate_fc), 6) > {CRITICAL_DROP_RATE} AS critical
FROM fc GROUP BY tower""", "fc"),
    "stream_land": with_ctes("SELECT topic, \"partition\", \"offset\", " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" if c == "order_amount" else c for c, _, _ in USERS_DECLARED)
        + " FROM bad_validated WHERE len(reasons) = 0", "bad_validated"),
    "stream_dedup": with_ctes("""
SELECT DISTINCT topic, "partition", "offset", "key", "value", "timestamp" FROM log_records_dup""", "log_records_dup"),
    "stream_dedup_intervals": with_ctes("""
SELECT DISTINCT topic, "partition", "offset", "key", "value", "timestamp" FROM log_records_dup""", "log_records_dup"),
    "offset_intervals": with_ctes("""
SELECT topic, "partition", lo, hi FROM islands""", "log_records_dup", local=ISLANDS),
    "contiguous_commits": with_ctes("""
SELECT topic, "partition", min(lo) AS first_offset, arg_min(hi, lo) + 1 AS next_offset, max(hi) AS highest_offset,
       count(*) AS n_intervals, CAST(max(hi) - min(lo) + 1 - sum(hi - lo + 1) AS BIGINT) AS missing,
       arg_min(hi, lo) < max(hi) AS held_back
FROM islands GROUP BY topic, "partition\"""", "log_records_dup", local=ISLANDS),
    "contiguous_from_progress": with_ctes(f"""
SELECT t.topic, t."partition", first_offset, min(x) AS next_offset, highest_offset, n_intervals,
       CAST(greatest(highest_offset + 1 - s, 0) - (SELECT count(*) FROM present p WHERE {SAME} AND p."offset" >= s) AS BIGINT) AS missing,
       min(x) <= highest_offset AS held_back
FROM starts t JOIN free p ON {SAME} AND x >= s
GROUP BY t.topic, t."partition", first_offset, highest_offset, n_intervals, s""", "log_records_dup", "progress", local=STARTS),
    "semantic_headline": with_ctes("""
SELECT count(user_id) AS total_users, CAST(sum(order_amount) AS DOUBLE) AS total_revenue,
       round(CAST(avg(order_amount) AS DOUBLE), 4) AS avg_order_value
FROM users_landed""", "users_landed"),
    "stream_dashboard": with_ctes("""
SELECT count(*) AS total_rows, CAST(COALESCE(sum(order_amount), 0) AS DOUBLE) AS total_revenue,
       max(user_id) AS latest_id, count(DISTINCT country) AS unique_countries
FROM users_landed""", "users_landed"),
    "counter_landing": """
SELECT event_id AS c1, CAST(event_id AS VARCHAR) AS c2,
       CASE WHEN event_id % 3 = 2 THEN date_trunc('millisecond', ts) ELSE ts END AS ts,
       CAST(event_id AS VARCHAR) AS offset_token
FROM events""",
    "counter_status": """
SELECT 'COUNTER_CHANNEL_P0' AS channel, count(*) AS rows_inserted_count, CAST(0 AS BIGINT) AS rows_error_count,
       CAST(NULL AS VARCHAR) AS last_error_message, CAST(NULL AS VARCHAR) AS last_error_offset_token_upper_bound,
       CAST(max(event_id) AS VARCHAR) AS latest_offset_token
FROM events""",
}


def _lst(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


# The streaming forms give the rows of their batch forms.
SQL |= {"stream_land_compacted": SQL["stream_land"], "stream_cumulative_revenue": SQL["cumulative_revenue"],
        "stream_top_countries": SQL["top_countries"], "stream_recent_records": SQL["recent_records"]}


def _register_cdr() -> None:
    from sluice.sources.fixtures import AREA_CODES, CALL_TYPES, CELL_TOWERS, DISPOSITIONS, NETWORKS, PLANS
    CTES["cdr_src"] = (f"""
  SELECT event_id, ts, user_id, event_type, value,
         '+1' || {_lst(AREA_CODES)}[user_id % 10 + 1] || lpad(CAST((user_id * 7919) % 10000000 AS VARCHAR), 7, '0')
           AS caller_number,
         '+1' || {_lst(AREA_CODES)}[event_id % 10 + 1] || lpad(CAST((event_id * 104729) % 10000000 AS VARCHAR), 7, '0')
           AS callee_number,
         {_lst(CALL_TYPES)}[event_id % 5 + 1] AS call_type,
         CASE WHEN event_type = 'error' THEN 'DROPPED' ELSE {_lst(DISPOSITIONS)}[(event_id // 5) % 4 + 1] END
           AS disposition,
         date_trunc('second', ts) AS call_start,
         {_lst(NETWORKS)}[user_id % 5 + 1] AS network_type,
         {_lst(CELL_TOWERS)}[user_id % 12 + 1] AS cell_tower_id,
         {_lst(PLANS)}[(user_id // 12) % 5 + 1] AS plan_type
  FROM events""", ())
    CTES["cdr_landed"] = ("""
  SELECT event_id AS record_id, caller_number, callee_number, call_type, disposition, call_start,
         call_start + to_seconds(dur) AS call_end, dur AS duration_seconds,
         CASE WHEN call_type = 'DATA' THEN CAST(printf('%.2f', value) AS DOUBLE) ELSE 0.0 END AS data_usage_mb,
         CAST(CAST((event_id % 1501) // 100 AS VARCHAR) || '.' || lpad(CAST(event_id % 1501 % 100 AS VARCHAR), 2, '0')
              AS DECIMAL(10,2)) AS charge_amount,
         network_type, cell_tower_id, plan_type, network_type = 'ROAMING' AS roaming, ts AS event_timestamp
  FROM (SELECT *, CAST(CASE WHEN call_type IN ('VOICE', 'VOICEMAIL') AND disposition = 'ANSWERED'
                            THEN 5 + (event_id * 37) % 3595 ELSE 0 END AS BIGINT) AS dur FROM cdr_src)""",
                          ("cdr_src",))
    CTES["cdr_daily"] = ("""
  SELECT cell_tower_id AS tower, CAST(call_start AS DATE) AS day, count(*) AS call_volume,
         count(*) FILTER (WHERE disposition = 'DROPPED') AS dropped_calls,
         count(*) FILTER (WHERE disposition = 'DROPPED') / count(*) AS drop_rate,
         sum(data_usage_mb) AS data_usage_mb
  FROM cdr_landed GROUP BY 1, 2""", ("cdr_landed",))
    CTES["cdr_fits"] = (CTES["fits"][0].replace("FROM tower_daily", "FROM cdr_daily"), ("cdr_daily",))
    CTES["cdr_fc"] = (CTES["fc"][0].replace("FROM fits", "FROM cdr_fits"), ("cdr_fits",))
    cols = ", ".join("CAST(charge_amount AS DOUBLE) AS charge_amount" if c == "charge_amount" else c
                     for c in ("record_id", "caller_number", "callee_number", "call_type", "disposition",
                               "call_start", "call_end", "duration_seconds", "data_usage_mb", "charge_amount",
                               "network_type", "cell_tower_id", "plan_type", "roaming", "event_timestamp"))
    SQL["cdr_landing"] = with_ctes(f"SELECT {cols} FROM cdr_landed", "cdr_landed")
    SQL["cdr_tower_daily"] = with_ctes("""
SELECT tower, day, call_volume, dropped_calls, round(drop_rate, 6) AS drop_rate,
       round(data_usage_mb, 4) AS data_usage_mb FROM cdr_daily""", "cdr_daily")
    SQL["cdr_tower_forecast"] = with_ctes("SELECT * FROM cdr_fc", "cdr_fc")
    SQL["cdr_semantic_by_tower"] = with_ctes("""
SELECT cell_tower_id, count(record_id) AS total_calls,
       round(avg(CASE WHEN disposition = 'DROPPED' THEN 1.0 ELSE 0.0 END), 6) AS drop_rate,
       round(sum(data_usage_mb), 4) AS total_data_usage_mb
FROM cdr_landed GROUP BY cell_tower_id""", "cdr_landed")


_register_cdr()
