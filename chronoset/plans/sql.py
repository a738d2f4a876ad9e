"""Independent SQL formulations (DuckDB dialect) of the registered queries.

They are written from the semantics, not from the Spark plans: e.g. the
latest profile per day uses `row_number`, the `append_all` history uses a
correlated closed form instead of the linear window form, and the
point-in-time lookup is a plain range join.
"""

from __future__ import annotations

OPEN = "DATE '3000-12-31'"

DAILY = """daily AS (
  SELECT user_id, day, event_type, props FROM (
    SELECT user_id, CAST(ts AS DATE) AS day, event_type, props,
           row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS rn
    FROM events) t WHERE rn = 1)"""

DAILY_NULLS = """dn AS (SELECT user_id, day, nullif(event_type, 'error') AS event_type, props FROM daily)"""


def build_cte(tracked: list[str], src: str = "daily", name: str = "dim") -> str:
    lags = ", ".join(f"lag({c}) OVER w AS p_{c}" for c in tracked)
    cond = " OR ".join(f"p_{c} IS DISTINCT FROM {c}" for c in tracked)
    return f"""v_{name} AS (
  SELECT user_id, day, event_type, props FROM (
    SELECT *, row_number() OVER w AS rn, {lags} FROM {src}
    WINDOW w AS (PARTITION BY user_id ORDER BY day)) t
  WHERE rn = 1 OR {cond}),
{name} AS (
  SELECT user_id, event_type, props, day AS effective_start_date,
         coalesce(lead(day) OVER w2, {OPEN}) AS effective_end_date,
         lead(day) OVER w2 IS NULL AS is_current
  FROM v_{name} WINDOW w2 AS (PARTITION BY user_id ORDER BY day))"""


def append_all_cte(tracked: list[str], src: str = "daily", name: str = "dim") -> str:
    cond = " OR ".join(f"b.{c} <> a.{c}" for c in tracked)
    return f"""e_{name} AS (
  SELECT a.user_id, a.event_type, a.props, a.day,
         (SELECT min(b.day) FROM {src} b WHERE b.user_id = a.user_id AND b.day > a.day AND ({cond})) AS e
  FROM {src} a),
{name} AS (
  SELECT user_id, event_type, props, day AS effective_start_date,
         coalesce(e, {OPEN}) AS effective_end_date, e IS NULL AS is_current FROM e_{name})"""


DIM_COLS = "user_id, event_type, props, effective_start_date, effective_end_date, is_current"
LAST_DAY = "(SELECT max(day) FROM daily)"
PRIOR = f"prior AS (SELECT * FROM daily WHERE day < {LAST_DAY})"
STAGE = f"stg AS (SELECT * FROM daily WHERE day = {LAST_DAY})"

EXPIRE = f"""WITH {DAILY}, {PRIOR}, {STAGE}, {build_cte(['event_type'], 'prior')}
SELECT d.user_id, d.event_type, d.props, d.effective_start_date,
  CASE WHEN d.is_current AND s.user_id IS NOT NULL AND s.event_type IS DISTINCT FROM d.event_type
       THEN s.day ELSE d.effective_end_date END AS effective_end_date,
  CASE WHEN d.is_current AND s.user_id IS NOT NULL AND s.event_type IS DISTINCT FROM d.event_type
       THEN false ELSE d.is_current END AS is_current
FROM dim d LEFT JOIN stg s ON d.user_id = s.user_id AND d.is_current"""

INSERT_ALL = EXPIRE + f"""
UNION ALL
SELECT user_id, event_type, props, day AS effective_start_date, {OPEN} AS effective_end_date, true AS is_current
FROM (WITH {DAILY}, {STAGE} SELECT * FROM stg) s"""

O_JOIN = "orders o JOIN customer c ON o.o_custkey = c.c_custkey"
O_FLAT_COLS = ("o.o_orderkey, o.o_orderdate, o.o_totalprice, o.o_orderstatus, o.o_orderpriority, "
               "c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment")

O_NAMES = """names AS (
  SELECT d, n FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders) t,
  LATERAL (SELECT unnest([
    'transactions_' || strftime(d, '%Y-%m-%d') || '.json',
    'sub/transactions_' || strftime(d, '%Y-%m-%d') || '.json',
    'xtransactions_' || strftime(d, '%Y-%m-%d') || '.json.bak',
    'transactions_' || strftime(d, '%Y%m%d') || '.json',
    'notes_' || strftime(d, '%Y-%m-%d') || '.txt']) AS n) u)"""

#: Events as the last deliveries say after every fifth day was corrected.
CORRECTED = """events AS (
  SELECT event_id, ts, user_id, value, props,
         CASE WHEN day(ts) % 5 = 0 AND user_id % 3 = 1 THEN event_type || '-corrected' ELSE event_type END AS event_type
  FROM main.events WHERE NOT (day(ts) % 5 = 0 AND user_id % 3 = 0))"""

FILE_RE = r"'transactions_(\d{4}-\d{2}-\d{2})\.json'"

RULES = """SELECT unnest([
  {'rule': 'non_empty', 'column': '*', 'metric': n::DOUBLE, 'status': CASE WHEN n > 0 THEN 'Success' ELSE 'Failure' END},
  {'rule': 'event_id_not_null', 'column': 'event_id', 'metric': a, 'status': CASE WHEN a >= 1 THEN 'Success' ELSE 'Failure' END},
  {'rule': 'user_id_not_null', 'column': 'user_id', 'metric': b, 'status': CASE WHEN b >= 1 THEN 'Success' ELSE 'Failure' END},
  {'rule': 'event_type_not_null', 'column': 'event_type', 'metric': c, 'status': CASE WHEN c >= 1 THEN 'Success' ELSE 'Failure' END}],
  recursive := true), days
FROM (SELECT days, count(*) AS n, count(event_id)::DOUBLE / count(*) AS a, count(user_id)::DOUBLE / count(*) AS b,
             count(nullif(event_type, 'error'))::DOUBLE / count(*) AS c
      FROM (SELECT *, 'all' AS days FROM events
            UNION ALL SELECT *, 'first ten' AS days FROM events WHERE CAST(ts AS DATE) <= (SELECT min(CAST(ts AS DATE)) + 9 FROM events))
      GROUP BY days)"""

ADDRESS = """daily2 AS (
  SELECT user_id, day, event_type AS customer_state,
         CASE WHEN user_id % 10 = 0 THEN 'x' ELSE event_type || '-' || n % 3 END AS customer_city,
         CASE WHEN user_id % 10 = 0 THEN 'x' ELSE event_type || '-' || n % 3 END || '/' || n % 7 AS customer_address,
         (n % 5)::VARCHAR AS customer_zip, CASE WHEN n % 11 > 5 THEN 'Gold' ELSE 'Silver' END AS customer_tier
  FROM (SELECT *, regexp_extract(props, '(\\d+)', 1)::BIGINT AS n FROM daily))"""

ORACLE: dict[str, str] = {
    "dq_incremental": RULES,
    "dq_gate_failing": """SELECT * FROM (VALUES ('plain', true, 'non_empty', 'Success'), ('plain', true, 'event_id_not_null', 'Success'),
  ('plain', true, 'user_id_not_null', 'Success')) t(suite, passed, rule, status) WHERE (SELECT count(*) = count(event_id) AND count(*) = count(user_id) FROM events)
UNION ALL SELECT 'planted', bad = 0, rule, CASE WHEN rule <> 'event_type_not_null' OR bad = 0 THEN 'Success' ELSE 'Failure' END
FROM (SELECT count(*) FILTER (event_type = 'error') AS bad FROM events),
     (VALUES ('non_empty'), ('event_id_not_null'), ('user_id_not_null'), ('event_type_not_null')) r(rule)""",
    "file_listing": """SELECT n AS file_name, n AS path, length::BIGINT AS length FROM (
  SELECT 'transactions_' || strftime(ts, '%Y-%m-%d') || '.json' AS n, sum(length(event_id || ',' || event_type) + 1) AS length FROM events GROUP BY 1)
WHERE starts_with(n, 'transactions_' || (SELECT strftime(min(ts), '%Y-%m') FROM events) || '-1')""",
    "stream_scd2_state": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "stream_ingest_dedup": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "schema_drift": """WITH e AS (SELECT *, CAST(ts AS DATE) AS file_date, day(ts) % 7 AS d, day(ts) % 7 = 4 AND event_type = 'error' AS cut FROM events)
SELECT file_date, 'channel' AS field, 'unknown' AS drift, 'STRING' AS kinds, count(*) AS n_lines FROM e WHERE d = 0 GROUP BY 1
UNION ALL SELECT file_date, 'value', 'retyped', 'STRING', count(*) FROM e WHERE d = 1 GROUP BY 1
UNION ALL SELECT DISTINCT file_date, 'profile.props', 'absent', '', 0 FROM e WHERE d = 2
UNION ALL SELECT file_date, 'profile.user_id', 'retyped', 'STRING', count(*) FROM e WHERE d = 3 AND event_type = 'click' GROUP BY 1
UNION ALL SELECT file_date, '', 'broken', 'BROKEN', count(*) FROM e WHERE cut GROUP BY 1""",
    "change_levels": f"""WITH {DAILY}, {ADDRESS},
p AS (SELECT s.user_id, s.day AS effective_start_date, s.customer_state <> t.customer_state AS s, s.customer_city <> t.customer_city AS c,
             s.customer_address <> t.customer_address AS a, s.customer_zip <> t.customer_zip AS z, s.customer_tier <> t.customer_tier AS o
      FROM daily2 s JOIN daily2 t ON t.user_id = s.user_id AND t.day = (SELECT max(u.day) FROM daily u WHERE u.user_id = s.user_id AND u.day < s.day))
SELECT user_id, effective_start_date,
  CASE WHEN s THEN 'customer_state' WHEN c THEN 'customer_city' WHEN a THEN 'customer_address' WHEN z THEN 'customer_zip' END AS level,
  concat_ws(',', CASE WHEN s AND NOT c THEN 'customer_city' END, CASE WHEN (s OR c) AND NOT a THEN 'customer_address' END,
                 CASE WHEN (s OR c OR a) AND NOT z THEN 'customer_zip' END) AS violations,
  CASE WHEN o THEN 'customer_tier' ELSE '' END AS others
FROM p WHERE s OR c OR a OR z OR o""",
    "stream_redelivery": f"WITH {CORRECTED}, {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "batch_redelivery": f"WITH {CORRECTED} SELECT event_id, ts, value, user_id, CAST(ts AS DATE) AS fact_date FROM events",
    "ledger_changed": """SELECT DISTINCT CAST(ts AS DATE) AS file_date,
  CASE WHEN day(ts) = 3 THEN 'vanished' WHEN day(ts) > 20 THEN 'new' WHEN day(ts) % 5 = 0 THEN 'changed' ELSE 'done' END AS state
FROM events""",
    "latest_profile_per_day": f"WITH {DAILY} SELECT * FROM daily",
    "scd2_build": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "scd2_build_multi": f"WITH {DAILY}, {build_cte(['event_type', 'props'])} SELECT * FROM dim",
    "scd2_append_all": f"WITH {DAILY}, {append_all_cte(['event_type'])} SELECT * FROM dim",
    "scd2_append_all_nulls": f"WITH {DAILY}, {DAILY_NULLS}, {append_all_cte(['event_type', 'props'], 'dn')} "
                             "SELECT * FROM dim",
    "scd2_current": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim WHERE is_current",
    "scd2_changed_columns": f"""WITH {DAILY}, {build_cte(['event_type', 'props'])}
SELECT user_id, effective_start_date,
  concat_ws(',', CASE WHEN lag(event_type) OVER w IS DISTINCT FROM event_type THEN 'event_type' END,
                 CASE WHEN lag(props) OVER w IS DISTINCT FROM props THEN 'props' END) AS changed_columns
FROM dim WINDOW w AS (PARTITION BY user_id ORDER BY effective_start_date)""",
    "scd2_changed_rows": f"""WITH {DAILY}, {DAILY_NULLS},
p AS (SELECT s.*, t.event_type AS pe, t.props AS pp FROM dn s JOIN dn t ON t.user_id = s.user_id
      AND t.day = (SELECT max(u.day) FROM dn u WHERE u.user_id = s.user_id AND u.day < s.day))
SELECT user_id, day, event_type, props,
  (pe IS DISTINCT FROM event_type OR pp IS DISTINCT FROM props) AS changed_null_safe,
  coalesce(pe <> event_type OR pp <> props, false) AS changed_three_valued FROM p""",
    "scd2_expire": EXPIRE,
    "scd2_insert_all": INSERT_ALL,
    "scd2_merge_day": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "scd2_merge_day_append_all": f"WITH {DAILY}, {append_all_cte(['event_type'])} SELECT * FROM dim",
    "scd2_fold_days": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "scd2_apply_days": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "union_changed_new": f"""WITH {DAILY},
p AS (SELECT s.*, (SELECT max(u.day) FROM daily u WHERE u.user_id = s.user_id AND u.day < s.day) AS before FROM daily s)
SELECT p.user_id, p.day, p.event_type, p.props, 'changed' AS kind
FROM p JOIN daily t ON t.user_id = p.user_id AND t.day = p.before
WHERE t.event_type IS DISTINCT FROM p.event_type
UNION ALL
SELECT user_id, day, event_type, props, 'new' AS kind FROM p WHERE before IS NULL""",
    "sample_current": f"""WITH {DAILY}, {build_cte(['event_type'])}
SELECT {DIM_COLS} FROM (
  SELECT *, row_number() OVER (ORDER BY md5('s42' || CAST(user_id AS VARCHAR)), user_id) AS rn,
         count(*) OVER () AS cnt
  FROM dim WHERE is_current) t
WHERE rn <= round_even(0.25 * cnt, 0)""",
    "sample_profiles": f"""WITH {DAILY},
one AS (SELECT user_id, day, event_type, props FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY
     md5('s42' || CAST(user_id AS VARCHAR) || CAST(day AS VARCHAR) || event_type || props)) AS rn FROM daily) t
  WHERE rn = 1)
SELECT user_id, day, event_type, props FROM (
  SELECT *, row_number() OVER (ORDER BY md5('s42' || CAST(user_id AS VARCHAR)), user_id) AS rn,
         count(*) OVER () AS cnt FROM one) t
WHERE rn <= round_even(0.15 * cnt, 0)""",
    "sample_files": f"""WITH {O_NAMES}
SELECT n AS file_name, CAST(regexp_extract(n, {FILE_RE}, 1) AS DATE) AS file_date
FROM names WHERE regexp_extract(n, {FILE_RE}, 1) <> ''
ORDER BY md5('s42' || n), n LIMIT 4""",
    "asof_lookup": f"""WITH {DAILY}, {build_cte(['event_type'])}
SELECT e.event_id, e.ts, e.user_id, e.value, d.event_type, d.effective_start_date
FROM events e LEFT JOIN dim d ON e.user_id = d.user_id
 AND d.effective_start_date <= CAST(e.ts AS DATE) AND CAST(e.ts AS DATE) < d.effective_end_date""",
    "dim_integrity": f"""WITH {DAILY}, {append_all_cte(['event_type'])},
r AS (SELECT user_id, is_current, effective_start_date AS s, effective_end_date AS e,
        lead(effective_start_date) OVER (PARTITION BY user_id ORDER BY effective_start_date, effective_end_date) AS nx
      FROM dim),
k AS (SELECT user_id, count(*) AS n, count(*) FILTER (WHERE is_current) AS n_open,
        count(*) FILTER (WHERE nx < e) AS ov, count(*) FILTER (WHERE nx > e) AS gap,
        count(*) FILTER (WHERE e < s) AS inv FROM r GROUP BY user_id)
SELECT count(*) AS n_keys, CAST(sum(n) AS BIGINT) AS n_rows,
  count(*) FILTER (WHERE n_open > 1) AS keys_multi_current,
  CAST(sum(ov) AS BIGINT) AS n_overlaps, CAST(sum(gap) AS BIGINT) AS n_gaps, CAST(sum(inv) AS BIGINT) AS n_inverted
FROM k""",
    # --- shape -------------------------------------------------------------
    "txn_nest": f"SELECT {O_FLAT_COLS} FROM {O_JOIN}",
    "txn_flatten": f"""SELECT o.o_orderkey, o.o_orderdate, CAST(o.o_orderdate AS DATE) AS transaction_date,
  o.o_totalprice, o.o_orderstatus, o.o_orderpriority, c.c_custkey AS customer_id FROM {O_JOIN}""",
    "customer_snapshot": f"""SELECT DISTINCT c.c_custkey, c.c_name, c.c_nationkey, c.c_acctbal, c.c_mktsegment,
  CAST(o.o_orderdate AS DATE) AS effective_start_date, {OPEN} AS effective_end_date, true AS is_current
FROM {O_JOIN}""",
    "json_roundtrip": f"SELECT {O_FLAT_COLS} FROM {O_JOIN}",
    "json_text_roundtrip": f"SELECT {O_FLAT_COLS} FROM {O_JOIN}",
    "profiles_from_files": "SELECT user_id, event_type, props FROM events",
    # --- discovery -----------------------------------------------------------
    "file_dates": f"""WITH {O_NAMES}
SELECT n AS file_name, CAST(regexp_extract(n, {FILE_RE}, 1) AS DATE) AS file_date
FROM names WHERE regexp_extract(n, {FILE_RE}, 1) <> ''""",
    "file_manifest": "SELECT DISTINCT CAST(o_orderdate AS DATE) AS file_date, true AS non_empty FROM orders",
    "ledger_pending": """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS file_date FROM orders),
done AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS file_date FROM orders WHERE o_orderstatus = 'F')
SELECT 'transactions_' || strftime(file_date, '%Y-%m-%d') || '.json' AS file_name, file_date
FROM d ANTI JOIN done USING (file_date)""",
    "latest_processed_date": "SELECT max(CAST(o_orderdate AS DATE)) AS latest_date FROM orders",
    "date_spine": """SELECT CAST(range AS DATE) AS file_date FROM range(
  (SELECT min(CAST(o_orderdate AS DATE)) FROM orders)::TIMESTAMP,
  (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)""",
    "missing_dates": """WITH b AS (
  SELECT min(CAST(o_orderdate AS DATE)) AS lo, max(CAST(o_orderdate AS DATE)) AS hi FROM orders),
d AS (SELECT CAST(range AS DATE) AS file_date FROM range(
  (SELECT lo FROM b)::TIMESTAMP, (SELECT hi FROM b)::TIMESTAMP + INTERVAL 1 DAY, INTERVAL 1 DAY)),
m AS (SELECT file_date FROM d WHERE file_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)),
l AS (SELECT max(CAST(o_orderdate AS DATE)) AS latest FROM orders, b
      WHERE CAST(o_orderdate AS DATE) <= lo + CAST((hi - lo) // 2 AS INTEGER))
SELECT file_date, 'empty' AS ledger FROM m
UNION ALL SELECT file_date, 'half' FROM m, l WHERE file_date > latest""",
    # --- loads ---------------------------------------------------------------
    "load_append": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "load_overwrite": "SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE day(ts) > 15",
    "replace_by_date": """SELECT event_id, ts, user_id, event_type,
  CASE WHEN day(ts) > 15 THEN value * 2 ELSE value END AS value, props FROM events""",
    # --- parsing -------------------------------------------------------------
    "parse_timestamps": """WITH t AS (SELECT event_id,
  CASE WHEN event_type = 'error' THEN 'bad-' || CAST(event_id AS VARCHAR)
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS ts_text FROM events)
SELECT event_id, ts_text, try_strptime(ts_text, '%Y-%m-%dT%H:%M:%SZ') AS ts_parsed,
  strftime(try_strptime(ts_text, '%Y-%m-%dT%H:%M:%SZ'), '%Y-%m-%d %H:%M:%S') AS ts_formatted,
  CAST(try_strptime(ts_text, '%Y-%m-%dT%H:%M:%SZ') AS DATE) AS ts_date FROM t""",
    "parse_dates": """WITH t AS (SELECT o_orderkey,
  CASE WHEN o_orderstatus = 'P' THEN strftime(o_orderdate, '%Y') || '-13-' || strftime(o_orderdate, '%d')
       ELSE strftime(o_orderdate, '%Y-%m-%d') END AS date_text FROM orders)
SELECT o_orderkey, date_text, TRY_CAST(date_text AS DATE) AS parsed_date FROM t""",
    # --- quality -------------------------------------------------------------
    "dq_checks": """SELECT 'non_empty' AS rule, '*' AS "column", CAST(count(*) AS DOUBLE) AS metric,
  CASE WHEN count(*) > 0 THEN 'Success' ELSE 'Failure' END AS status FROM events
UNION ALL
SELECT 'event_id_not_null', 'event_id', CAST(count(event_id) AS DOUBLE) / count(*),
  CASE WHEN count(event_id) = count(*) THEN 'Success' ELSE 'Failure' END FROM events
UNION ALL
SELECT 'user_id_not_null', 'user_id', CAST(count(user_id) AS DOUBLE) / count(*),
  CASE WHEN count(user_id) = count(*) THEN 'Success' ELSE 'Failure' END FROM events
UNION ALL
SELECT 'event_type_not_null', 'event_type', CAST(count(nullif(event_type, 'error')) AS DOUBLE) / count(*),
  CASE WHEN count(nullif(event_type, 'error')) = count(*) THEN 'Success' ELSE 'Failure' END FROM events""",
    "dq_gate": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "null_counts": """WITH e AS (SELECT event_id, ts, user_id, nullif(event_type, 'error') AS event_type, value, props
  FROM events)
SELECT 'event_id' AS column_name, count(*) - count(event_id) AS null_count, count(*) = count(event_id) AS no_nulls FROM e
UNION ALL SELECT 'ts', count(*) - count(ts), count(*) = count(ts) FROM e
UNION ALL SELECT 'user_id', count(*) - count(user_id), count(*) = count(user_id) FROM e
UNION ALL SELECT 'event_type', count(*) - count(event_type), count(*) = count(event_type) FROM e
UNION ALL SELECT 'value', count(*) - count(value), count(*) = count(value) FROM e
UNION ALL SELECT 'props', count(*) - count(props), count(*) = count(props) FROM e""",
    "column_conformance": """SELECT 'event_id' AS column_name, 'bigint' AS target_type, count(event_id) AS n_non_null,
  count(*) FILTER (WHERE event_id IS NOT NULL AND TRY_CAST(CAST(event_id AS VARCHAR) AS BIGINT) IS NULL)
    AS n_nonconforming FROM events
UNION ALL SELECT 'value', 'double', count(value),
  count(*) FILTER (WHERE value IS NOT NULL AND TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'event_type', 'bigint', count(event_type),
  count(*) FILTER (WHERE event_type IS NOT NULL AND TRY_CAST(event_type AS BIGINT) IS NULL) FROM events
UNION ALL SELECT 'props', 'double', count(props),
  count(*) FILTER (WHERE props IS NOT NULL AND TRY_CAST(props AS DOUBLE) IS NULL) FROM events
UNION ALL SELECT 'user_id', 'int', count(user_id),
  count(*) FILTER (WHERE user_id IS NOT NULL AND TRY_CAST(CAST(user_id AS VARCHAR) AS INTEGER) IS NULL) FROM events""",
    "amount_classes": """WITH a AS (SELECT
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
       WHEN c_mktsegment = 'MACHINERY' THEN 'nan'
       ELSE printf('%.2f', c_acctbal) END AS amount FROM customer),
b AS (SELECT amount, TRY_CAST(amount AS DECIMAL(18,2)) AS num FROM a)
SELECT CASE WHEN amount IS NULL THEN 'null' WHEN num IS NULL THEN 'not_numeric' WHEN num = 0 THEN 'zero'
            WHEN num < 0 THEN 'negative' ELSE 'positive' END AS amount_class,
  count(*) AS n_rows, CAST(CAST(sum(num) AS DECIMAL(38,2)) AS DOUBLE) AS total
FROM b GROUP BY 1""",
    "quarantine_split": """WITH a AS (SELECT c_custkey,
  CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN NULL
       WHEN c_mktsegment = 'MACHINERY' THEN 'nan'
       ELSE printf('%.2f', c_acctbal) END AS amount FROM customer),
b AS (SELECT c_custkey, amount, TRY_CAST(amount AS DECIMAL(18,2)) AS num FROM a),
c AS (SELECT c_custkey, amount,
  CASE WHEN amount IS NULL THEN 'null' WHEN num IS NULL THEN 'not_numeric' WHEN num = 0 THEN 'zero'
       WHEN num < 0 THEN 'negative' ELSE 'positive' END AS cls FROM b)
SELECT c_custkey, amount, CASE WHEN cls = 'positive' THEN 'good' ELSE 'quarantine' END AS side,
  CASE WHEN cls = 'positive' THEN NULL ELSE cls END AS reason FROM c""",
    # --- streaming -----------------------------------------------------------
    "stream_ingest": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_scd2": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "batch_load_history": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "stream_archive": """SELECT event_id, ts, user_id, event_type, value, props, 'sink' AS place FROM events
UNION ALL SELECT event_id, ts, user_id, event_type, value, props, 'archive' FROM events WHERE day(ts) <= 15""",
    "batch_load_facts": "SELECT event_id, ts, value, user_id, CAST(ts AS DATE) AS fact_date FROM events",
    "run_stream_history": f"WITH {DAILY}, {build_cte(['event_type'])} SELECT * FROM dim",
    "stream_quarantine": """SELECT 'fact' AS place, count(*) AS n FROM events WHERE event_type NOT IN ('error', 'click')
UNION ALL SELECT 'broken line', count(*) FROM events WHERE event_type = 'error'
UNION ALL SELECT 'missing key', count(*) FROM events WHERE event_type = 'click'
UNION ALL SELECT 'version without key or start', 0""",
    "batch_load_transactions": f"""SELECT CAST(o.o_orderkey AS VARCHAR) AS transaction_id, o.o_orderdate AS transaction_timestamp,
  CAST(o.o_orderdate AS DATE) AS transaction_date, printf('%.2f', o.o_totalprice) AS amount,
  CAST(TRY_CAST(printf('%.2f', o.o_totalprice) AS DECIMAL(18,2)) AS DOUBLE) AS amount_num,
  o.o_orderstatus AS transaction_status, CAST(c.c_custkey AS VARCHAR) AS customer_id
FROM {O_JOIN} WHERE o.o_orderpriority <> '1-URGENT'""",
}
