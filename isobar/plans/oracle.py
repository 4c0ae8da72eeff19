"""DuckDB SQL for each driver query (same column names and types)."""

from __future__ import annotations

# Shared CTE: events as station readings (see queries._event_measures).
_EVENT_READINGS = """
e AS (
  SELECT user_id,
         CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS h,
         value AS a_temp,
         CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER) AS a_humidity,
         value / 10 AS a_wind_mph,
         CAST(trunc(value) AS INTEGER) AS a_feelslike,
         CAST(trunc(value) AS INTEGER) AS p_temp,
         CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER) AS p_humidity,
         CAST(trunc(value / 10) AS INTEGER) AS p_wind_mph,
         CAST(trunc(value) AS INTEGER) AS p_feelslike
  FROM events
),
f AS (
  SELECT user_id, CAST(l AS INTEGER) AS fhours, h + l * 3600 AS fts,
         p_temp, p_humidity, p_wind_mph, p_feelslike
  FROM (SELECT *, unnest(generate_series(1, 24)) AS l FROM e)
),
d AS (
  SELECT f.fhours,
         a.a_temp - f.p_temp AS tempD,
         a.a_humidity - f.p_humidity AS humidityD,
         a.a_wind_mph - f.p_wind_mph AS wind_mphD,
         a.a_feelslike - f.p_feelslike AS feelslikeD
  FROM f JOIN e a ON f.user_id = a.user_id AND f.fts = a.h
),
stats AS (
  SELECT fhours, count(*) AS count,
         avg(tempD) AS tempM, stddev_samp(tempD) AS tempSD,
         avg(humidityD) AS humidityM, stddev_samp(humidityD) AS humiditySD,
         avg(wind_mphD) AS wind_mphM, stddev_samp(wind_mphD) AS wind_mphSD,
         avg(feelslikeD) AS feelslikeM, stddev_samp(feelslikeD) AS feelslikeSD
  FROM d GROUP BY fhours
)"""

_EV = "event_id, ts, user_id, event_type, value, props"


def _enforce_sql(keys: str, extra: str = "") -> str:
    return f"""
SELECT {_EV}{extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys}
                               ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rk
  FROM (SELECT *{extra} FROM events)
) WHERE rk = 1"""


# Events as landed feed records, normalised and key-enforced, scored.
_LANDED = """
ev AS (
  SELECT user_id, value, props::JSON->>'$.k' AS ktxt,
         CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS source,
         (epoch_ms(ts) // 1000 + CASE user_id % 4 WHEN 0 THEN -21600 WHEN 1 THEN 19800
                                 WHEN 2 THEN -12600 ELSE 0 END) // 60 AS lmin
  FROM events
),
w AS (
  SELECT user_id, lmin, value AS a_temp,
         CAST(trunc(CAST(ktxt AS DOUBLE)) AS INTEGER) AS a_humidity,
         value / 10 AS a_wind_mph, CAST(trunc(value) AS INTEGER) AS a_feelslike
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, lmin
                                     ORDER BY source DESC, value DESC, ktxt || '%' DESC) AS rk
        FROM ev) WHERE rk = 1
),
f AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (
             PARTITION BY user_id, lmin, l
             ORDER BY source DESC, CAST(CAST(trunc(value) AS INTEGER) AS VARCHAR) DESC,
                      ktxt DESC, CAST(CAST(trunc(value / 10) AS INTEGER) AS VARCHAR) DESC) AS rk
    FROM (SELECT *, unnest(generate_series(1, 24)) AS l FROM ev)
  ) WHERE rk = 1
),
d AS (
  SELECT CAST(f.l AS INTEGER) AS fhours,
         w.a_temp - CAST(trunc(f.value) AS INTEGER) AS tempD,
         w.a_humidity - CAST(trunc(CAST(f.ktxt AS DOUBLE)) AS INTEGER) AS humidityD,
         w.a_wind_mph - CAST(trunc(f.value / 10) AS INTEGER) AS wind_mphD,
         w.a_feelslike - CAST(trunc(f.value) AS INTEGER) AS feelslikeD
  FROM f JOIN w ON f.user_id = w.user_id
               AND (f.lmin // 60) * 60 + f.l * 60 = (w.lmin // 60) * 60
),
stats AS (
  SELECT fhours, count(*) AS count,
         avg(tempD) AS tempM, stddev_samp(tempD) AS tempSD,
         avg(humidityD) AS humidityM, stddev_samp(humidityD) AS humiditySD,
         avg(wind_mphD) AS wind_mphM, stddev_samp(wind_mphD) AS wind_mphSD,
         avg(feelslikeD) AS feelslikeM, stddev_samp(feelslikeD) AS feelslikeSD
  FROM d GROUP BY fhours
)"""


def _hm(ts: str) -> str:
    return (f"CAST(hour({ts}) AS VARCHAR) || ':' || "
            f"lpad(CAST(minute({ts}) AS VARCHAR), 2, '0')")


_DATE = ", strftime(ts, '%Y-%m-%d') AS date"

ORACLE = {
    "forecast_skill": "WITH" + _EVENT_READINGS + """
SELECT fhours, count,
       round(tempM, 6) AS tempM, round(tempSD, 6) AS tempSD,
       round(humidityM, 6) AS humidityM, round(humiditySD, 6) AS humiditySD,
       round(wind_mphM, 6) AS wind_mphM, round(wind_mphSD, 6) AS wind_mphSD,
       round(feelslikeM, 6) AS feelslikeM, round(feelslikeSD, 6) AS feelslikeSD
FROM stats""",
    "forecast_bands": "WITH" + _EVENT_READINGS + """,
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
    FROM events) WHERE rk = 1
),
fc AS (
  SELECT user_id, CAST(l AS INTEGER) AS fhours,
         epoch_ms(ts) // 1000 + l * 3600 AS fts,
         CAST(trunc(value) AS INTEGER) AS temp,
         CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER) AS humidity,
         CAST(trunc(value / 10) AS INTEGER) AS wind_mph,
         CAST(trunc(value) AS INTEGER) AS feelslike
  FROM (SELECT *, unnest(generate_series(1, 24)) AS l FROM newest)
)
SELECT fc.user_id, fc.fhours, fc.fts,
       strftime(epoch_ms(fc.fts * 1000), '%m/%d %H:00') AS label,
       temp, humidity, wind_mph, feelslike,
       round(tempSD, 6) AS tempSD,
       round(temp - 1.96 * tempSD, 6) AS temp_lower,
       round(temp + 1.96 * tempSD, 6) AS temp_upper,
       round(humiditySD, 6) AS humiditySD,
       round(greatest(0.0, humidity - 1.96 * humiditySD), 6) AS humidity_lower,
       round(least(100.0, humidity + 1.96 * humiditySD), 6) AS humidity_upper,
       round(wind_mphSD, 6) AS wind_mphSD,
       round(greatest(0.0, wind_mph - 1.96 * wind_mphSD), 6) AS wind_mph_lower,
       round(wind_mph + 1.96 * wind_mphSD, 6) AS wind_mph_upper,
       round(feelslikeSD, 6) AS feelslikeSD,
       round(feelslike - 1.96 * feelslikeSD, 6) AS feelslike_lower,
       round(feelslike + 1.96 * feelslikeSD, 6) AS feelslike_upper
FROM fc JOIN stats s ON fc.fhours = s.fhours""",
    "latest_per_key": _enforce_sql("user_id"),
    "top_n_per_key": f"""
SELECT {_EV}, CAST(rk AS INTEGER) AS rk FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
  FROM events
) WHERE rk <= 20""",
    "enforce_keys_1": _enforce_sql("user_id"),
    "enforce_keys_2": _enforce_sql("user_id, event_type"),
    "enforce_keys_3": _enforce_sql("user_id, event_type, date", _DATE),
    "zip_explode": """
SELECT doc_id, lang, CAST(i AS INTEGER) AS pos, w[i] AS word, w[i + 1] AS next_word
FROM (SELECT doc_id, lang, w, unnest(generate_series(1, len(w) - 1)) AS i
      FROM (SELECT doc_id, lang, string_split(text, ' ') AS w FROM documents))""",
    "nearby_union": """
SELECT DISTINCT p_brand, nearby FROM (
  SELECT p_brand, unnest(string_split(p_name, ' ')) AS nearby FROM part
  UNION ALL
  SELECT p_brand, unnest(string_split(p_type, ' ')) AS nearby FROM part
) WHERE nearby <> ''""",
    "nested_project": """
SELECT event_id, user_id, event_type, props::JSON->>'$.k' AS k FROM events""",
    "nonblank_filter": """
SELECT doc_id, source, n_chars, lang FROM (
  SELECT doc_id, source, n_chars,
         CASE WHEN lang = 'de' THEN '' WHEN lang = 'es' THEN NULL ELSE lang END AS lang
  FROM documents
) WHERE lang <> ''""",
    "distinct_rows": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
    "anti_new": """
SELECT doc_id, lang, source, (row_number() OVER (ORDER BY doc_id) - 1) // 100 + 1 AS batch
FROM documents d
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)""",
    "union_all": """
SELECT * FROM orders WHERE o_orderstatus = 'F'
UNION ALL
SELECT * FROM orders WHERE o_orderstatus <> 'F' OR o_orderstatus IS NULL""",
    "local_clock": """
SELECT event_id, "offset",
       strftime(epoch_ms((es + secs) * 1000), '%Y-%m-%d') AS date,
       strftime(epoch_ms((es + secs) * 1000), '%H:%M') AS time
FROM (
  SELECT event_id, epoch_ms(ts) // 1000 AS es,
         CASE user_id % 4 WHEN 0 THEN '-0600' WHEN 1 THEN '+0530'
                          WHEN 2 THEN '-0330' ELSE '+0000' END AS "offset",
         CASE user_id % 4 WHEN 0 THEN -21600 WHEN 1 THEN 19800
                          WHEN 2 THEN -12600 ELSE 0 END AS secs
  FROM events)""",
    "hour_lead": """
WITH f AS (SELECT user_id, min(ts) AS t0 FROM events GROUP BY user_id)
SELECT e.event_id,
       CAST(epoch(date_trunc('minute', e.ts)) AS BIGINT) AS "epoch",
       CAST(epoch(date_trunc('hour', e.ts)) AS BIGINT) AS epoch_hour,
       CAST((epoch(date_trunc('hour', e.ts)) - epoch(date_trunc('hour', f.t0))) / 3600
            AS INTEGER) AS "lead"
FROM events e JOIN f ON e.user_id = f.user_id""",
    "hour_label": "SELECT event_id, strftime(ts, '%m/%d %H:00') AS label FROM events",
    "pct_clean": """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(round(l_discount * 100) AS INTEGER) AS VARCHAR) || '%' AS pct_text,
       CAST(round(l_discount * 100) AS INTEGER) AS pct
FROM lineitem""",
    "trunc_cast": "SELECT c_custkey, CAST(trunc(c_acctbal) AS INTEGER) AS acct FROM customer",
    "card_unpivot": """
SELECT c_custkey, 'C Name' AS label, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'C Nationkey', CAST(c_nationkey AS VARCHAR) FROM customer
UNION ALL SELECT c_custkey, 'C Mktsegment', c_mktsegment FROM customer""",
    "hist_stack": """
WITH a AS (
  SELECT p_brand, min(p_size) AS nl, min(p_retailprice) AS rl, min(p_partkey) AS rly,
         max(p_size) AS nh, max(p_retailprice) AS rh, max(p_partkey) AS rhy
  FROM part GROUP BY p_brand)
SELECT p_brand, 'Low' AS label, nl AS normal, rl AS record, rly AS record_year FROM a
UNION ALL
SELECT p_brand, 'High', nh, rh, rhy FROM a""",
    "hhmm_label": f"""
SELECT event_id, 'Sun' AS label, {_hm("ts")} AS "Rise",
       {_hm("ts + INTERVAL 12 HOUR")} AS "Set" FROM events
UNION ALL
SELECT event_id, 'Moon', {_hm("ts + INTERVAL 6 HOUR")},
       CASE WHEN value < 5 THEN '' ELSE {_hm("ts + INTERVAL 18 HOUR")} END FROM events""",
    "slug_index": """
SELECT n_name, lower(replace(n_name, ' ', '')) AS slug, customers,
       row_number() OVER (ORDER BY n_name) - 1 AS position
FROM nation n JOIN (SELECT c_nationkey, count(*) AS customers FROM customer GROUP BY 1) c
  ON n.n_nationkey = c.c_nationkey""",
    "source_key": """
SELECT event_id,
       strftime(ts, '%Y/%m/%d/%H') || '/feed-1-' || CAST(event_id AS VARCHAR) AS path,
       CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS source
FROM events""",
    "keyed_patch": """
WITH u AS (
  SELECT user_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
    FROM events) WHERE rk = 1)
SELECT p.page_id,
       CASE WHEN u.user_id IS NULL THEN p.html
            ELSE regexp_replace(p.html, '<title>[^<]*</title>',
                   '<title>' || CAST(CAST(round(u.value) AS INTEGER) AS VARCHAR) || '&deg;F</title>',
                   'g') END AS html
FROM pages p LEFT JOIN u ON p.page_id = u.user_id""",
    "order_limit": """
SELECT *, CAST(row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey ASC) AS INTEGER) AS position
FROM orders ORDER BY o_totalprice DESC, o_orderkey ASC LIMIT 100""",
    "parquet_roundtrip": "SELECT * FROM orders",
    "stream_latest": """
SELECT user_id, ts, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
  FROM events WHERE value IS NOT NULL AND user_id IS NOT NULL
) WHERE rk = 1""",
    "stream_ingest_once": "SELECT * FROM events",
    "landed_skill": "WITH" + _LANDED + """
SELECT fhours, count,
       round(tempM, 6) AS tempM, round(tempSD, 6) AS tempSD,
       round(humidityM, 6) AS humidityM, round(humiditySD, 6) AS humiditySD,
       round(wind_mphM, 6) AS wind_mphM, round(wind_mphSD, 6) AS wind_mphSD,
       round(feelslikeM, 6) AS feelslikeM, round(feelslikeSD, 6) AS feelslikeSD
FROM stats""",
    "sql_functions": """
SELECT event_id, "offset",
       strftime(epoch_ms((es + secs) * 1000), '%Y-%m-%d') AS date,
       strftime(epoch_ms((es + secs) * 1000), '%H:%M') AS time,
       ((es + secs) // 3600) * 3600 AS local_hour,
       CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER) AS humidity,
       lower(replace(event_type || ' ' || CAST(user_id AS VARCHAR), ' ', '')) AS slug
FROM (
  SELECT event_id, event_type, user_id, props, epoch_ms(ts) // 1000 AS es,
         CASE user_id % 4 WHEN 0 THEN '-0600' WHEN 1 THEN '+0530'
                          WHEN 2 THEN '-0330' ELSE '+0000' END AS "offset",
         CASE user_id % 4 WHEN 0 THEN -21600 WHEN 1 THEN 19800
                          WHEN 2 THEN -12600 ELSE 0 END AS secs
  FROM events)""",
    "landing_listing": """
WITH h AS (SELECT DISTINCT CAST(strftime(ts, '%Y%m%d%H') AS BIGINT) AS source FROM events)
SELECT source FROM h
WHERE source // 100 <> (SELECT min(source) // 100 FROM h)""",
    "write_metrics": """
SELECT name, value FROM (
  SELECT 'rows' AS name, count(*) AS value FROM orders
  UNION ALL SELECT 'max_key', max(o_orderkey) FROM orders
  UNION ALL SELECT 'status_F', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders
  UNION ALL SELECT 'status_O', count(*) FILTER (WHERE o_orderstatus = 'O') FROM orders
  UNION ALL SELECT 'status_P', count(*) FILTER (WHERE o_orderstatus = 'P') FROM orders)""",
}

ORACLE["stream_patch"] = ORACLE["keyed_patch"]

ORACLE["report_bands"] = "WITH" + _LANDED + """,
top AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lmin DESC, l ASC) AS top_rk
    FROM f
  ) WHERE top_rk <= 240
),
fc AS (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS city, (lmin + 60 * l) * 60 AS fts,
         CAST(l AS INTEGER) AS fhours,
         CAST(trunc(value) AS INTEGER) AS temp,
         CAST(trunc(CAST(ktxt AS DOUBLE)) AS INTEGER) AS humidity,
         CAST(trunc(value / 10) AS INTEGER) AS wind_mph,
         CAST(trunc(value) AS INTEGER) AS feelslike
  FROM top
)
SELECT city, fts, fc.fhours, temp, humidity, wind_mph, feelslike,
       round(tempSD, 6) AS tempSD,
       round(temp - 1.96 * tempSD, 6) AS temp_lower,
       round(temp + 1.96 * tempSD, 6) AS temp_upper,
       round(humiditySD, 6) AS humiditySD,
       round(greatest(0.0, humidity - 1.96 * humiditySD), 6) AS humidity_lower,
       round(least(100.0, humidity + 1.96 * humiditySD), 6) AS humidity_upper,
       round(wind_mphSD, 6) AS wind_mphSD,
       round(greatest(0.0, wind_mph - 1.96 * wind_mphSD), 6) AS wind_mph_lower,
       round(wind_mph + 1.96 * wind_mphSD, 6) AS wind_mph_upper,
       round(feelslikeSD, 6) AS feelslikeSD,
       round(feelslike - 1.96 * feelslikeSD, 6) AS feelslike_lower,
       round(feelslike + 1.96 * feelslikeSD, 6) AS feelslike_upper
FROM fc JOIN stats s ON fc.fhours = s.fhours"""


_STATS = """
SELECT fhours, count,
       round(tempM, 6) AS tempM, round(tempSD, 6) AS tempSD,
       round(humidityM, 6) AS humidityM, round(humiditySD, 6) AS humiditySD,
       round(wind_mphM, 6) AS wind_mphM, round(wind_mphSD, 6) AS wind_mphSD,
       round(feelslikeM, 6) AS feelslikeM, round(feelslikeSD, 6) AS feelslikeSD
FROM stats"""

# delivered in the folder of each day's first hour
_LANDED_BY_DAY = _LANDED.replace("'%Y%m%d%H'", "'%Y%m%d00'")
# the full join over all deliveries, leads up to 14 days
ORACLE["incremental_skill"] = ("WITH" + _LANDED_BY_DAY.replace("generate_series(1, 24)",
                                                               "generate_series(8, 336, 8)") + _STATS)
ORACLE["stream_normalised"] = ORACLE["landed_skill"]
ORACLE["stream_upsert_late"] = _enforce_sql("user_id, event_type, date", _DATE)
ORACLE["hourly_cycle"] = "WITH" + _LANDED_BY_DAY + """
SELECT city, date, time, temp, fhours, count, round(tempM, 6) AS tempM, round(tempSD, 6) AS tempSD
FROM (
  SELECT 'u' || CAST(user_id AS VARCHAR) AS city,
         strftime(epoch_ms(lmin * 60000), '%Y-%m-%d') AS date,
         strftime(epoch_ms(lmin * 60000), '%H:%M') AS time,
         round(a_temp, 6) AS temp,
         CAST(hour(epoch_ms(lmin * 60000)) + 1 AS INTEGER) AS fhours,
         row_number() OVER (PARTITION BY user_id ORDER BY lmin DESC) AS rk
  FROM w)
JOIN stats USING (fhours) WHERE rk = 1"""
ORACLE["report_forecast_table"] = "WITH" + _EVENT_READINGS + """,
newest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
    FROM events) WHERE rk = 1
),
fc AS (
  SELECT user_id AS city, CAST(l AS INTEGER) AS fhours, epoch_ms(ts) // 1000 + l * 3600 AS fts,
         CAST(trunc(value) AS INTEGER) AS temp,
         CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER) AS humidity,
         CAST(trunc(value / 10) AS INTEGER) AS wind_mph,
         CAST(trunc(value) AS INTEGER) AS feelslike
  FROM (SELECT *, unnest(generate_series(1, 24)) AS l FROM newest)
)
SELECT city, fts, strftime(epoch_ms(fts * 1000), '%m/%d %H:00') AS hour,
       temp, humidity, wind_mph, feelslike,
       CAST(row_number() OVER (PARTITION BY city ORDER BY fts) AS INTEGER) AS position
FROM fc WHERE fhours IN (SELECT fhours FROM stats)"""
ORACLE["card_for_key"] = """
WITH top AS (SELECT c_nationkey FROM customer GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)
SELECT c_nationkey, c_custkey, 'C Name' AS label, c_name AS value
FROM customer WHERE c_nationkey = (FROM top)
UNION ALL
SELECT c_nationkey, c_custkey, 'C Mktsegment', c_mktsegment
FROM customer WHERE c_nationkey = (FROM top)"""
ORACLE["error_rows"] = """
WITH ev AS (
  SELECT *, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS h FROM events
),
a AS (
  SELECT user_id, h, count(*) AS n_obs, avg(value) AS t, avg(value / 10) AS w,
         avg(CAST(trunc(CAST(props::JSON->>'$.k' AS DOUBLE)) AS INTEGER)) AS hu, avg(CAST(trunc(value) AS INTEGER)) AS fl
  FROM ev GROUP BY user_id, h
),
f AS (SELECT *, CAST(l AS INTEGER) AS fhours
      FROM (SELECT *, unnest(generate_series(1, 24)) AS l FROM ev))
SELECT f.event_id, f.fhours, a.n_obs,
       round(a.t - CAST(trunc(f.value) AS INTEGER), 6) AS "tempD",
       round(a.hu - CAST(trunc(CAST(f.props::JSON->>'$.k' AS DOUBLE)) AS INTEGER), 6) AS "humidityD",
       round(a.w - CAST(trunc(f.value / 10) AS INTEGER), 6) AS "wind_mphD",
       round(a.fl - CAST(trunc(f.value) AS INTEGER), 6) AS "feelslikeD"
FROM f JOIN a ON a.user_id = f.user_id AND a.h = f.h + f.l * 3600"""
ORACLE["index_patch"] = """
SELECT slug, '&nbsp;&nbsp;' || CAST(round(CAST(value AS DECIMAL(18, 2)), 1) AS VARCHAR)
       || '&deg;F&nbsp;&nbsp;<a href="' || slug || '.html">' || slug || '</a><br>' AS html
FROM (SELECT *, 'u' || CAST(user_id AS VARCHAR) AS slug,
             row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rk
      FROM events) WHERE rk = 1"""
