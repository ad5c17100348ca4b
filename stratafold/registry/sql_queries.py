"""What each registered query must give, as SQL over the given tables."""

from __future__ import annotations


# --- daily metrics ------------------------------------------------------------
EVENTS = """
ev AS (
  SELECT CAST(user_id // 10 AS VARCHAR) AS account_id, CAST(user_id AS VARCHAR) AS campaign_id, ts,
         CAST(ts AS DATE) AS day, event_type, CAST(round(value * 100) AS BIGINT) AS cents
  FROM events)"""

SEEN_EARLY = (
    "ts < TIMESTAMP '2024-01-20' AND NOT (event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-13')"
)


def daily(name: str, condition: str = "TRUE") -> str:
    return f"""
{name}_plain AS (
  SELECT account_id, campaign_id, day AS date_information, count(*) AS impressions,
         count(*) FILTER (WHERE event_type = 'click') AS clicks,
         CAST(sum(cents) AS DOUBLE) / 100 AS spend,
         count(*) FILTER (WHERE event_type = 'purchase') AS purchases,
         coalesce(CAST(sum(cents) FILTER (WHERE event_type = 'purchase') AS DOUBLE), 0) / 100 AS value_purchases,
         'Meta' AS platform
  FROM ev WHERE {condition} GROUP BY account_id, campaign_id, day),
{name} AS (
  SELECT *, md5(concat_ws('|', account_id, campaign_id, CAST(clicks AS VARCHAR), CAST(date_information AS VARCHAR),
                CAST(impressions AS VARCHAR), platform, CAST(purchases AS VARCHAR), CAST(spend AS VARCHAR),
                CAST(value_purchases AS VARCHAR))) AS row_hash
  FROM {name}_plain)"""


PULLS = f"WITH {EVENTS}, {daily('early', SEEN_EARLY)}, {daily('late')}"
DAILY = f"WITH {EVENTS}, {daily('late')}"


def hash_merge(old_hash: str, stamp: str, count_type: str) -> str:
    """Full outer join of the two pulls with the hash rule."""
    def changed(column: str) -> str:
        return f"CASE WHEN action IN ('insert', 'update') THEN s_{column} ELSE t_{column} END AS {column}"

    def kept(column: str) -> str:
        return f"CASE WHEN action = 'insert' THEN s_{column} ELSE t_{column} END AS {column}"

    names = ["account_id", "campaign_id", "date_information", "impressions", "clicks", "spend", "purchases",
             "value_purchases", "platform"]
    pairs = ", ".join(f"t.{n} AS t_{n}, s.{n} AS s_{n}" for n in names)
    return f"""
old AS (SELECT * REPLACE ({old_hash} AS row_hash) FROM early),
joined AS (
  SELECT {pairs}, t.row_hash AS t_row_hash, s.row_hash AS s_row_hash,
         CASE WHEN s.campaign_id IS NULL THEN 'keep' WHEN t.campaign_id IS NULL THEN 'insert'
              WHEN t.row_hash <> s.row_hash THEN 'update' ELSE 'noop' END AS action
  FROM old t FULL OUTER JOIN late s
    ON t.campaign_id = s.campaign_id AND t.date_information = s.date_information),
merged AS (
  SELECT {", ".join(kept(n) for n in ("account_id", "campaign_id", "date_information", "platform"))},
         {", ".join(changed(n) for n in ("impressions", "clicks", "spend", "value_purchases", "row_hash"))},
         CAST(CASE WHEN action IN ('insert', 'update') THEN s_purchases ELSE t_purchases END AS {count_type}) AS purchases,
         CASE WHEN action IN ('insert', 'update') THEN '2024-01-31 06:00:00' ELSE '2024-01-20 06:00:00' END AS {stamp},
         action
  FROM joined)"""


SILVER_MERGE = f"{PULLS}, {hash_merge('row_hash', 'updated_at', 'BIGINT')}"
GOLD_MERGE = (
    f"{PULLS}, {hash_merge('CASE WHEN impressions > 1 THEN row_hash END', 'inserted_at', 'DOUBLE')}"
)

# --- raw insight text ------------------------------------------------------------
RAW_INSIGHTS = """
raw AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS account_id, CAST(event_id AS VARCHAR) AS campaign_id, event_type,
         CAST(ts AS DATE) AS date_information, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
  FROM events),
judged AS (
  SELECT *,
    CASE WHEN k BETWEEN 50 AND 59 THEN 'impressions: not a whole number'
         WHEN k >= 95 THEN 'spend: not a number'
         WHEN event_type = 'error' THEN 'actions: unreadable action list' END AS row_error,
    CASE WHEN k < 40 THEN k WHEN k < 50 THEN 0 WHEN k BETWEEN 60 AND 64 THEN 1000 ELSE k END AS impressions,
    CAST(1 AS BIGINT) AS clicks,
    CASE WHEN k < 90 THEN value ELSE CAST(0 AS DOUBLE) END AS spend,
    CASE WHEN event_type = 'purchase' THEN k ELSE 0 END AS purchases,
    CASE WHEN event_type = 'purchase' THEN CAST(k AS DOUBLE) + CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
      AS value_purchases,
    'Meta' AS platform
  FROM raw)"""
METRICS = """campaign_id, date_information, CAST(impressions AS BIGINT) AS impressions, clicks, spend,
  CAST(purchases AS BIGINT) AS purchases, value_purchases, platform"""

# --- raw campaign text -------------------------------------------------------------
RAW_CAMPAIGNS = """
judged AS (
  SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS campaign_id, o_orderpriority,
    'Ö ' || o_orderpriority AS campaign_name, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS objective,
    CASE o_orderstatus WHEN 'F' THEN TRUE WHEN 'P' THEN FALSE END AS budget_rebalance_flag,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100
         WHEN o_orderpriority = '5-LOW' THEN CAST(0 AS DOUBLE) END AS daily_budget,
    CAST(NULL AS DOUBLE) AS lifetime_budget,
    strftime(CASE o_orderpriority
      WHEN '1-URGENT' THEN o_orderdate + INTERVAL '26 hours 30 minutes'
      WHEN '2-HIGH' THEN o_orderdate - INTERVAL '4 hours 30 minutes'
      WHEN '3-MEDIUM' THEN o_orderdate + INTERVAL '12 hours' END, '%Y-%m-%d %H:%M:%S') AS start_time,
    CAST(NULL AS VARCHAR) AS stop_time,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS updated_time, 'Meta' AS platform,
    CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'daily_budget: not a number'
         WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'O' THEN 'start_time: not a timestamp' END AS row_error
  FROM orders)"""
CAMPAIGN_COLUMNS = """campaign_id, campaign_name, status, objective, budget_rebalance_flag, daily_budget,
  lifetime_budget, start_time, stop_time, updated_time, platform"""

# --- campaigns as a table ------------------------------------------------------------
CAMPAIGNS = """
campaigns AS (
  SELECT CAST(o_custkey AS VARCHAR) AS account_id, CAST(o_orderkey AS VARCHAR) AS campaign_id,
    'Order ' || o_orderkey AS campaign_name, o_orderstatus AS status, o_orderpriority AS objective,
    o_totalprice > 200000 AS budget_rebalance_flag, o_totalprice AS daily_budget,
    CASE WHEN o_orderpriority <> '1-URGENT' THEN o_totalprice END AS lifetime_budget,
    o_orderdate AS start_time, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS stop_time,
    o_orderdate AS created_time, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS updated_time,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'TikTok' ELSE 'Meta' END AS platform
  FROM orders)"""

CONTROL = """
control AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS campaign_id, CAST(o_custkey AS VARCHAR) AS account_id, 'Meta' AS platform,
    CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderdate AS DATE) END AS last_insight_date,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'completo' WHEN '2-HIGH' THEN 'fallido'
      WHEN '3-MEDIUM' THEN 'extraccion_hecha' WHEN '5-LOW' THEN 'pendiente' END AS extraction_status,
    strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ultima_extraccion
  FROM orders WHERE o_orderstatus <> 'O')"""


def work(name: str, campaigns: str, condition: str = "TRUE") -> str:
    return f"""
{name} AS (
  SELECT DISTINCT c.campaign_id, c.account_id, ec.last_insight_date,
    coalesce(ec.extraction_status, 'pendiente') AS extraction_status,
    CASE WHEN ec.last_insight_date IS NULL THEN 'maximum' ELSE 'last_14d' END AS mode
  FROM lineitem l JOIN {campaigns} c ON CAST(l.l_orderkey AS VARCHAR) = c.campaign_id
    LEFT JOIN control ec ON c.campaign_id = ec.campaign_id
  WHERE CAST(c.start_time AS DATE) <= DATE '2001-01-01' AND {condition}
    AND coalesce(ec.extraction_status, 'pendiente') IN ('pendiente', 'extraccion_hecha', 'fallido'))"""


NATION_CAMPAIGNS = """
nation_campaigns AS (
  SELECT c.campaign_id, CAST(k.c_nationkey AS VARCHAR) AS account_id, c.start_time, c.platform
  FROM campaigns c JOIN customer k ON c.account_id = CAST(k.c_custkey AS VARCHAR))"""


def lots(work_name: str) -> str:
    return f"""
lots AS (
  SELECT account_id, mode, campaign_id, CAST(floor((row_number() OVER (
      PARTITION BY account_id, mode ORDER BY substr(md5(campaign_id), 1, 3), campaign_id) - 1) / 10) AS BIGINT) AS lot
  FROM {work_name})"""


NATION_WORK = f"WITH {CAMPAIGNS}, {CONTROL}, {NATION_CAMPAIGNS}, {work('work', 'nation_campaigns')}"

# --- pages ----------------------------------------------------------------------------
PAGES = """
pages AS (
  SELECT CAST(user_id AS VARCHAR) AS lot, event_id AS page, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
    CASE WHEN event_type = 'error' AND value > 150 THEN 'code ' || event_id END AS fault,
    CASE WHEN event_type = 'view' OR (event_type = 'error' AND value > 150) THEN 0 ELSE 2 END AS n
  FROM events),
lots AS (
  SELECT lot, count(*) AS n_pages, sum(n) AS n_items,
    coalesce(arg_min(fault, page) FILTER (WHERE fault IS NOT NULL),
             CASE WHEN arg_max(event_type, page) = 'click' THEN 'last page is missing' END) AS error
  FROM pages GROUP BY lot)"""

# --- files, ledger, accounts -------------------------------------------------------------
FILES = """
files AS (
  SELECT 'raw/' || lower(source) || '/' || lang || '/' || doc_id || '/' ||
      strftime(DATE '2024-01-01' + CAST(n_chars % 31 AS INTEGER), '%Y-%m-%d') || '/data.json' AS gcs_path,
    lang AS business_line, CAST(doc_id AS VARCHAR) AS entity_id,
    CAST(DATE '2024-01-01' + CAST(n_chars % 31 AS INTEGER) AS DATE) AS fecha_archivo, lower(source) AS source
  FROM documents),
ledger AS (
  SELECT f.*, CASE WHEN toxic = 1 THEN 'fallido' WHEN quality = 1 THEN 'completado' ELSE 'en_proceso' END AS status,
    CASE WHEN toxic = 1 THEN 'old error' END AS error_mensaje
  FROM files f JOIN labels l ON f.entity_id = CAST(l.doc_id AS VARCHAR))"""

ACCOUNTS = """
last_orders AS (
  SELECT * FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC, o_orderstatus DESC) = 1),
accounts AS (
  SELECT CAST(c_custkey AS VARCHAR) AS account_id, c_name AS account_name,
    CASE c_mktsegment WHEN 'BUILDING' THEN 'meta' WHEN 'MACHINERY' THEN 'Meta' ELSE c_mktsegment END AS platform,
    c_acctbal > 0 AS activo,
    CASE o_orderstatus WHEN 'F' THEN 'exitoso' WHEN 'O' THEN 'en_proceso' WHEN 'P' THEN 'fallido' END AS extraction_status,
    o_orderdate AS ultima_extraccion
  FROM customer LEFT JOIN last_orders ON c_custkey = o_custkey),
due AS (
  SELECT *, CASE
      WHEN ultima_extraccion IS NULL THEN 'primera_extraccion'
      WHEN CAST(ultima_extraccion AS DATE) = DATE '2001-06-01' AND extraction_status = 'exitoso' THEN 'ya_completo_hoy'
      WHEN CAST(ultima_extraccion AS DATE) = DATE '2001-06-01' AND extraction_status IN ('en_proceso', 'fallido') THEN 'reintento'
      WHEN CAST(ultima_extraccion AS DATE) < DATE '2001-06-01' THEN 'extraccion_nueva'
      ELSE 'sin_cambios' END AS motivo
  FROM accounts WHERE activo AND lower(platform) = 'meta')"""

LOADED_INSIGHTS = f"""{SILVER_MERGE}
SELECT account_id, campaign_id, date_information, impressions, clicks, spend, purchases, value_purchases,
  platform, updated_at FROM merged"""

# accounts by the last digit in base five: 1 holds no objects, 2 a spend that is no number, 3 also another platform
FAULTY = f"""{DAILY}, accounts AS (SELECT account_id, CAST(account_id AS INTEGER) % 5 AS kind FROM late GROUP BY account_id),
files AS (
  SELECT 'meta' AS source, 'Meta' AS platform, account_id, kind FROM accounts
  UNION ALL SELECT 'tiktok', 'Tiktok', account_id, kind FROM accounts WHERE kind = 3)"""


def faulty_ledger(retried: bool) -> str:
    broken = "FALSE" if retried else "kind = 1"
    return f"""{FAULTY}
SELECT 'raw/' || source || '/insights/' || account_id || '/2024-01-31/data.json' AS gcs_path, platform AS business_line,
  account_id AS entity_id, DATE '2024-01-31' AS fecha_archivo,
  CASE WHEN source = 'tiktok' OR {broken} THEN 'fallido' ELSE 'completado' END AS status,
  CASE WHEN source = 'tiktok' THEN 'no normaliser for platform Tiktok'
       WHEN {broken} THEN 'malformed JSON or an element that is not an object' END AS error_mensaje
FROM files"""


QUERIES = {
    "insights_upsert": f"{SILVER_MERGE} SELECT * FROM merged",
    "daily_rollup": f"{DAILY} SELECT * EXCLUDE (row_hash) FROM late",
    "row_hash": f"{DAILY} SELECT campaign_id, date_information, row_hash FROM late",
    "gold_upsert": f"{GOLD_MERGE} SELECT * FROM merged",
    "gold_refresh": f"{GOLD_MERGE} SELECT * EXCLUDE (action) FROM merged",
    "range_requests": f"""{PULLS},
seen AS (SELECT campaign_id, max(date_information) AS last_day FROM early GROUP BY campaign_id)
SELECT m.campaign_id, m.date_information,
  CASE WHEN last_day >= DATE '2024-01-19' THEN 'last_14d' ELSE 'maximum' END AS mode, m.impressions
FROM late m LEFT JOIN seen ON m.campaign_id = seen.campaign_id
WHERE m.date_information < DATE '2024-01-30'
  AND (last_day IS NULL OR last_day < DATE '2024-01-19' OR m.date_information >= DATE '2024-01-16')""",
    "campaigns_upsert": f"""WITH {CAMPAIGNS},
t AS (SELECT * FROM campaigns WHERE start_time < TIMESTAMP '2000-01-01'),
s AS (
  SELECT * REPLACE (
    CASE status WHEN 'F' THEN created_time + INTERVAL 1 DAY WHEN 'O' THEN created_time END AS updated_time,
    campaign_name || ' (new)' AS campaign_name, daily_budget * 2 AS daily_budget, 'CHANGED' AS objective)
  FROM campaigns WHERE start_time >= TIMESTAMP '1997-01-01'),
j AS (
  SELECT t, s, CASE
      WHEN s.campaign_id IS NULL THEN 'keep' WHEN t.campaign_id IS NULL THEN 'insert'
      WHEN coalesce(s.updated_time, TIMESTAMP '1970-01-01') > coalesce(t.updated_time, TIMESTAMP '1970-01-01') THEN 'update'
      ELSE 'noop' END AS action
  FROM t FULL OUTER JOIN s ON t.campaign_id = s.campaign_id)
SELECT
  CASE WHEN action = 'insert' THEN s.account_id ELSE t.account_id END AS account_id,
  CASE WHEN action = 'insert' THEN s.campaign_id ELSE t.campaign_id END AS campaign_id,
  CASE WHEN action IN ('insert', 'update') THEN s.campaign_name ELSE t.campaign_name END AS campaign_name,
  CASE WHEN action IN ('insert', 'update') THEN s.status ELSE t.status END AS status,
  CASE WHEN action = 'insert' THEN s.objective ELSE t.objective END AS objective,
  CASE WHEN action IN ('insert', 'update') THEN s.budget_rebalance_flag ELSE t.budget_rebalance_flag END AS budget_rebalance_flag,
  CASE WHEN action IN ('insert', 'update') THEN s.daily_budget ELSE t.daily_budget END AS daily_budget,
  CASE WHEN action IN ('insert', 'update') THEN s.lifetime_budget ELSE t.lifetime_budget END AS lifetime_budget,
  strftime(CASE WHEN action = 'insert' THEN s.start_time ELSE t.start_time END, '%Y-%m-%d %H:%M:%S') AS start_time,
  strftime(CASE WHEN action IN ('insert', 'update') THEN s.stop_time ELSE t.stop_time END, '%Y-%m-%d %H:%M:%S') AS stop_time,
  strftime(CASE WHEN action = 'insert' THEN s.created_time ELSE t.created_time END, '%Y-%m-%d %H:%M:%S') AS created_time,
  strftime(CASE WHEN action = 'insert' THEN s.updated_time ELSE t.updated_time END, '%Y-%m-%d %H:%M:%S') AS updated_time,
  CASE WHEN action IN ('insert', 'update') THEN '2001-01-01 06:00:00' ELSE '2000-01-01 00:00:00' END AS loaded_at,
  CASE WHEN action = 'insert' THEN s.platform ELSE t.platform END AS platform,
  action
FROM j""",
    "star_join": f"""{DAILY}
SELECT campaign_id, date_information, spend, c_name AS campaign_name, c_mktsegment AS objective
FROM late LEFT JOIN customer ON campaign_id = CAST(c_custkey AS VARCHAR)""",
    "dim_campaigns": f"""WITH {CAMPAIGNS}
SELECT campaign_id, campaign_name, status, objective, strftime(start_time, '%Y-%m-%d %H:%M:%S') AS start_time,
  strftime(stop_time, '%Y-%m-%d %H:%M:%S') AS stop_time, platform FROM campaigns""",
    "normalize_campaigns": f"WITH {RAW_CAMPAIGNS} SELECT account_id, {CAMPAIGN_COLUMNS} FROM judged WHERE row_error IS NULL",
    "normalize_insights": f"WITH {RAW_INSIGHTS} SELECT account_id, {METRICS} FROM judged WHERE row_error IS NULL",
    "row_errors": f"""SELECT * FROM (
WITH {RAW_CAMPAIGNS} SELECT 'campaigns' AS kind, campaign_id AS item_id, row_error FROM judged WHERE row_error IS NOT NULL)
UNION ALL SELECT * FROM (
WITH {RAW_INSIGHTS} SELECT 'insights' AS kind, campaign_id AS item_id, row_error FROM judged WHERE row_error IS NOT NULL)""",
    "error_log": f"""WITH {RAW_INSIGHTS}
SELECT 'upload_insights_meta' AS proceso, 'meta' AS platform, account_id AS parent_id, 'ad_account' AS parent_tipo,
  campaign_id AS child_id, 'item' AS child_tipo, account_id AS entidad_id, 'ad_account' AS entidad_tipo,
  'RowError' AS tipo_error, row_error AS mensaje_error, CAST(1 AS BIGINT) AS intentos
FROM judged WHERE row_error IS NOT NULL""",
    "not_null_guard": f"""{DAILY}
SELECT campaign_id, date_information,
  CASE WHEN c_mktsegment IS NULL THEN 'platform' WHEN impressions <= 1 THEN 'row_hash' END AS missing_column
FROM late LEFT JOIN customer ON campaign_id = CAST(c_custkey AS VARCHAR) AND c_acctbal >= 0""",
    "first_action": """
SELECT doc_id, CAST(coalesce(length(
  list_filter(string_split(text, ' '), lambda w: lower(substr(w, 1, 1)) = 'p')[1]), 0) AS BIGINT) AS first_value
FROM documents""",
    "due_rule": f"""WITH {ACCOUNTS}
SELECT account_id, extraction_status, strftime(ultima_extraccion, '%Y-%m-%d %H:%M:%S') AS ultima_extraccion,
  motivo IN ('primera_extraccion', 'reintento', 'extraccion_nueva') AS extraer, motivo FROM due""",
    "extraction_worklist": f"""WITH {CAMPAIGNS}, {CONTROL}, {work('work', 'campaigns', "c.platform = 'Meta'")}
SELECT * FROM work""",
    "extraction_lots": f"""{NATION_WORK}, {lots('work')}
SELECT account_id, mode, lot, string_agg(campaign_id, ',' ORDER BY campaign_id) AS campaign_ids
FROM lots GROUP BY account_id, mode, lot""",
    "work_groups": f"""{NATION_WORK}
SELECT account_id, mode, count(*) AS n_campaigns, CAST(ceil(count(*) / 10.0) AS BIGINT) AS n_lots
FROM work GROUP BY account_id, mode""",
    "page_flatten": f"""WITH {PAGES}, item AS (SELECT CAST(unnest([0, 1]) AS BIGINT) AS position)
SELECT p.lot, p.page, item.position, p.page AS id,
  CASE WHEN item.position = 0 THEN p.event_type END AS type, CASE WHEN item.position = 1 THEN p.k END AS k
FROM pages p JOIN lots l ON p.lot = l.lot AND l.error IS NULL CROSS JOIN item WHERE p.n = 2""",
    "run_counters": f"""WITH {PAGES}
SELECT lot, n_pages, CAST(CASE WHEN error IS NULL THEN n_items ELSE 0 END AS BIGINT) AS n_rows, error FROM lots""",
    "control_upsert": f"""WITH {CONTROL},
s AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS campaign_id, CAST(o_custkey AS VARCHAR) AS account_id,
    CASE WHEN o_orderstatus = 'P' THEN 'fallido'
         WHEN o_orderpriority <> '5-LOW' AND o_orderdate < TIMESTAMP '2000-01-01'
           AND DATE '1999-01-01' >= CAST(o_orderdate AS DATE) + 7 THEN 'completo'
         ELSE 'extraccion_hecha' END AS status
  FROM orders)
SELECT s.campaign_id, coalesce(t.account_id, s.account_id) AS account_id, coalesce(t.platform, 'Meta') AS platform,
  DATE '1999-01-01' AS last_insight_date, s.status AS extraction_status, '1999-01-01 06:00:00' AS ultima_extraccion,
  CASE WHEN t.campaign_id IS NULL THEN 'insert' ELSE 'update' END AS action
FROM s LEFT JOIN control t ON s.campaign_id = t.campaign_id""",
    "ledger_register": f"""WITH {FILES}
SELECT f.gcs_path, f.business_line, f.entity_id, f.fecha_archivo, 'en_proceso' AS status,
  CAST(NULL AS VARCHAR) AS error_mensaje, '2024-01-31 06:00:00' AS fecha_carga,
  CASE WHEN l.gcs_path IS NULL THEN 'insert' ELSE 'update' END AS action
FROM files f LEFT JOIN ledger l ON f.gcs_path = l.gcs_path""",
    "ledger_finish": f"""WITH {FILES}
SELECT gcs_path, business_line, entity_id, fecha_archivo,
  CASE WHEN status <> 'en_proceso' THEN status WHEN business_line = 'fr' THEN 'fallido' ELSE 'completado' END AS status,
  CASE WHEN status = 'en_proceso' AND business_line = 'fr' THEN 'bad file ' || entity_id ELSE error_mensaje END AS error_mensaje,
  '2024-01-20 06:00:00' AS fecha_carga, CASE WHEN status = 'en_proceso' THEN 'update' ELSE 'noop' END AS action
FROM ledger""",
    "load_gate": f"""WITH {FILES}
SELECT gcs_path, business_line, entity_id, fecha_archivo FROM files f
WHERE NOT EXISTS (SELECT 1 FROM ledger l WHERE l.gcs_path = f.gcs_path AND l.status = 'completado'
  AND l.fecha_archivo = f.fecha_archivo)""",
    "account_status": f"""WITH {ACCOUNTS}
SELECT account_id, activo,
  CASE WHEN s_suppkey IS NULL THEN extraction_status WHEN s_acctbal < 0 THEN 'fallido' ELSE 'exitoso' END AS extraction_status,
  CASE WHEN s_suppkey IS NULL THEN strftime(ultima_extraccion, '%Y-%m-%d %H:%M:%S') ELSE '2001-01-01 06:00:00' END AS ultima_extraccion,
  CASE WHEN s_suppkey IS NULL THEN 'keep' ELSE 'update' END AS action
FROM accounts LEFT JOIN supplier ON account_id = CAST(s_suppkey AS VARCHAR)""",
    "files_of_day": f"""WITH {FILES}
SELECT gcs_path, entity_id AS account_id, business_line AS kind, source, fecha_archivo FROM files
WHERE contains(gcs_path, '2024-01-09')""",
    "active_platforms": f"WITH {ACCOUNTS} SELECT DISTINCT platform FROM accounts WHERE activo",
    "catalogue_scan": f"""WITH {ACCOUNTS} SELECT account_id, account_name, platform FROM accounts
WHERE activo AND lower(platform) = 'meta'""",
    "platform_dispatch": """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, upper(lang) AS platform,
  CASE lang WHEN 'en' THEN CAST(length(text) AS BIGINT) WHEN 'fr' THEN CAST(len(string_split(text, ' ')) AS BIGINT) END AS size,
  CASE WHEN lang NOT IN ('en', 'fr') THEN 'no rule' END AS file_error
FROM documents""",
    "raw_roundtrip": f"""WITH {RAW_INSIGHTS}
SELECT event_type AS account_id, date_information AS fecha_archivo, {METRICS} FROM judged WHERE row_error IS NULL""",
    "insight_load": LOADED_INSIGHTS,
    "stream_upsert": LOADED_INSIGHTS,
    "campaign_load": f"""WITH {RAW_CAMPAIGNS}
SELECT o_orderpriority AS account_id, {CAMPAIGN_COLUMNS}, CAST(NULL AS VARCHAR) AS created_time,
  '2001-01-01 06:00:00' AS loaded_at FROM judged WHERE row_error IS NULL""",
    "load_ledger": f"""{DAILY}
SELECT DISTINCT 'raw/meta/insights/' || account_id || '/2024-01-31/data.json' AS gcs_path, 'Meta' AS business_line,
  account_id AS entity_id, DATE '2024-01-31' AS fecha_archivo, 'completado' AS status,
  CAST(NULL AS VARCHAR) AS error_mensaje, '2024-01-31 06:00:00' AS fecha_carga FROM late""",
    "array_load": LOADED_INSIGHTS,
    "split_array_read": f"""{DAILY}
SELECT * EXCLUDE (row_hash) REPLACE ('all' AS account_id), DATE '2024-01-31' AS fecha_archivo FROM late""",
    "guarded_publish": f"""{PULLS}
SELECT * EXCLUDE (row_hash), '2024-01-20 06:00:00' AS updated_at,
  'account_id,campaign_id,date_information,platform,row_hash' AS refused FROM early""",
    "table_defaults": """
SELECT 'account' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS platform, TRUE AS activo,
  '2024-01-20 06:00:00' AS created_at, CAST(NULL AS VARCHAR) AS extraction_status, CAST(NULL AS BIGINT) AS intentos,
  CAST(NULL AS BOOLEAN) AS resuelto, CAST(NULL AS BOOLEAN) AS own_id FROM customer
UNION ALL
SELECT 'error', CAST(c_custkey AS VARCHAR), c_mktsegment, NULL, '2024-01-31 06:00:00', NULL, 1, FALSE, TRUE
FROM customer WHERE c_acctbal < 0""",
    "interrupted_publish": f"""{PULLS}
SELECT * EXCLUDE (row_hash), '2024-01-20 06:00:00' AS updated_at FROM early WHERE date_information < DATE '2024-01-20'
UNION ALL
SELECT * EXCLUDE (row_hash), '2024-01-31 06:00:00' FROM late WHERE date_information >= DATE '2024-01-20'""",
    "gold_increments": f"""{PULLS}, {hash_merge('row_hash', 'inserted_at', 'DOUBLE')}
SELECT * EXCLUDE (action) FROM merged""",
    "failed_load": faulty_ledger(False),
    "retried_load": faulty_ledger(True),
    "error_table": f"""{FAULTY}
SELECT 'upload_insights_meta' AS proceso, source AS platform, account_id AS parent_id, CAST(NULL AS VARCHAR) AS child_id,
  account_id AS entidad_id, 'FileError' AS tipo_error,
  CASE WHEN source = 'tiktok' THEN 'no normaliser for platform Tiktok'
       ELSE 'malformed JSON or an element that is not an object' END AS mensaje_error, CAST(1 AS BIGINT) AS intentos, FALSE AS resuelto
FROM files WHERE kind = 1 OR source = 'tiktok'
UNION ALL
SELECT 'upload_insights_meta', 'meta', l.account_id, l.campaign_id, l.account_id, 'RowError', 'spend: not a number', 1, FALSE
FROM late l JOIN accounts a ON l.account_id = a.account_id WHERE kind = 2""",
    "extraction_cycle": f"""WITH {CAMPAIGNS}, {CONTROL}, {NATION_CAMPAIGNS}, {work('work', 'nation_campaigns', "c.platform = 'Meta'")}, {lots('work')},
lot_ends AS (
  SELECT l.account_id, l.mode, l.lot, max(o_totalprice) > 450000 AS failed
  FROM lots l JOIN orders ON l.campaign_id = CAST(o_orderkey AS VARCHAR) GROUP BY l.account_id, l.mode, l.lot),
s AS (
  SELECT l.campaign_id, l.account_id,
    CASE WHEN e.failed THEN 'fallido'
         WHEN DATE '2001-01-01' >= CAST(c.stop_time AS DATE) + 7 THEN 'completo' ELSE 'extraccion_hecha' END AS status
  FROM lots l JOIN lot_ends e ON l.account_id = e.account_id AND l.mode = e.mode AND l.lot = e.lot
    JOIN campaigns c ON l.campaign_id = c.campaign_id)
SELECT coalesce(t.campaign_id, s.campaign_id) AS campaign_id, coalesce(t.account_id, s.account_id) AS account_id,
  coalesce(t.platform, 'Meta') AS platform,
  CASE WHEN s.campaign_id IS NULL THEN t.last_insight_date ELSE DATE '2001-01-01' END AS last_insight_date,
  CASE WHEN s.campaign_id IS NULL THEN t.extraction_status ELSE s.status END AS extraction_status,
  CASE WHEN s.campaign_id IS NULL THEN t.ultima_extraccion ELSE '2001-01-01 06:00:00' END AS ultima_extraccion
FROM control t FULL OUTER JOIN s ON t.campaign_id = s.campaign_id""",
    "account_run": f"""WITH fetched AS (
  SELECT c_nationkey, bool_or(n_regionkey < 2 AND o_orderpriority = '1-URGENT') AS failed
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY c_nationkey)
SELECT CAST(n_nationkey AS VARCHAR) AS account_id, 'Meta' AS platform, TRUE AS activo,
  CASE WHEN n_regionkey = 4 THEN 'exitoso' WHEN coalesce(failed, TRUE) THEN 'fallido' ELSE 'exitoso' END AS extraction_status,
  CASE WHEN n_regionkey = 4 THEN '2001-06-01 03:00:00' ELSE '2001-06-01 06:00:00' END AS ultima_extraccion
FROM nation LEFT JOIN fetched ON n_nationkey = c_nationkey""",
}
