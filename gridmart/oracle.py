"""DuckDB SQL stating the expected result of each driver query.

Tables are the driver's pre-registered views.  Names and types follow the
Spark side: counts BIGINT, hours of day INTEGER, averages of prices as an
exact decimal sum divided in double.
"""

from __future__ import annotations

LOCAL = "timezone('Europe/Stockholm', timezone('UTC', {c}))"

BASE = """
P AS (
  SELECT event_type AS region, ts, value AS price FROM events WHERE event_id % 2 = 0
), X AS (
  SELECT event_type AS region, ts,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS temperature
  FROM events WHERE event_id % 2 = 1
), PH AS (
  SELECT region, date_trunc('hour', ts) AS hour_utc,
         CAST(SUM(CAST(price AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(price) AS DOUBLE) AS price,
         arg_min(price, ts) FILTER (WHERE price IS NOT NULL) AS first_price,
         COUNT(*) AS n_obs
  FROM P GROUP BY 1, 2
), PHA AS (
  SELECT event_type AS region, date_trunc('hour', ts) AS hour_utc,
         CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS price,
         arg_min(value, ts) FILTER (WHERE value IS NOT NULL) AS first_price,
         COUNT(*) AS n_obs
  FROM events GROUP BY 1, 2
), XHA AS (
  SELECT CASE event_type WHEN 'click' THEN 'SE1' WHEN 'error' THEN 'SE2' WHEN 'purchase' THEN 'SE3'
                         WHEN 'signup' THEN 'SE4' ELSE event_type END AS region,
         date_trunc('hour', ts) AS hour_utc,
         AVG(CAST(json_extract_string(props, '$.k') AS DOUBLE)) AS temperature
  FROM events GROUP BY 1, 2
), LOC AS (
  SELECT * FROM (VALUES ('SE1', 'Lulea', 65.5848::DOUBLE, 22.1547::DOUBLE), ('SE2', 'Umea', 63.8258, 20.2630),
                        ('SE3', 'Stockholm', 59.3293, 18.0686), ('SE4', 'Malmo', 55.6050, 13.0038))
           t(region, location, latitude, longitude)
), XH AS (
  SELECT region, date_trunc('hour', ts) AS hour_utc, AVG(temperature) AS temperature
  FROM X GROUP BY 1, 2
), G AS (
  SELECT PH.region, PH.hour_utc, price, first_price, n_obs, temperature
  FROM PH JOIN XH ON PH.region = XH.region AND PH.hour_utc = XH.hour_utc
), GW AS (
  SELECT G.*, wind FROM G JOIN
         (SELECT event_type AS region, date_trunc('hour', ts) AS hour_utc, AVG(CAST(user_id % 20 AS DOUBLE)) AS wind
          FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2) W
         ON G.region = W.region AND G.hour_utc = W.hour_utc
), K AS (
  SELECT DISTINCT event_type AS region, date_trunc('hour', ts) AS hour_utc FROM events
), GAPS AS (
  SELECT region, hour_utc, previous_hour,
         date_diff('hour', previous_hour, hour_utc) AS gap_hours
  FROM (SELECT region, hour_utc,
               lag(hour_utc) OVER (PARTITION BY region ORDER BY hour_utc) AS previous_hour
        FROM K)
  WHERE previous_hour IS NOT NULL AND date_diff('hour', previous_hour, hour_utc) <> 1
), O AS (
  SELECT o_orderkey, o_custkey, nullif(o_orderstatus, 'F') AS o_orderstatus, o_totalprice,
         o_orderdate, nullif(o_orderpriority, '1-URGENT') AS o_orderpriority
  FROM orders
), CR AS (
  SELECT c_custkey, c_name, n_name, r_name
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey
), OR_ AS (
  SELECT orders.*, CR.r_name AS region FROM orders JOIN CR ON o_custkey = c_custkey
), EH AS (
  SELECT *, date_trunc('hour', ts) AS hour_utc FROM events
), M AS (
  SELECT event_type, max(ts) AS mark FROM events
  WHERE ts < TIMESTAMP '2024-01-21 00:00:00' GROUP BY 1
)
"""


# Silver prices expected from the price half of events written as feed text
# (seconds, Stockholm offset), parsed back and localised.
SPX = f"""SPX AS (
  SELECT CAST(L AS DATE) AS price_date, T AS time_start, T + INTERVAL 15 MINUTE AS time_end,
         CAST(hour(L) AS INTEGER) AS price_hour, event_type AS region,
         value * 11 AS SEK_per_kWh, value AS EUR_per_kWh,
         CAST(10.0 AS DOUBLE) + CAST(hour(ts) AS DOUBLE) / CAST(100.0 AS DOUBLE) AS EXR,
         'events' AS source, CAST(T AS DATE) AS utc_date
  FROM (SELECT *, date_trunc('second', ts) AS T,
               {LOCAL.format(c="date_trunc('second', ts)")} AS L
        FROM events WHERE event_id % 2 = 0))"""


def _w(body: str, *extra: str) -> str:
    ctes = BASE.rstrip() + "".join(f", {e}" for e in extra)
    return "WITH " + ctes + "\n" + body


def _local(c: str) -> str:
    return LOCAL.format(c=c)


ORACLE: dict[str, str] = {
    "hourly_rollup": _w("SELECT * FROM PHA"),
    "gold_hourly_join": _w("SELECT * FROM G"),
    "overlap_range": _w(
        "SELECT PH.* FROM PH, B WHERE PH.hour_utc BETWEEN B.lo AND B.hi",
        """B AS (SELECT greatest((SELECT min(hour_utc) FROM PH), (SELECT min(hour_utc) FROM XH)) AS lo,
                   least((SELECT max(hour_utc) FROM PH), (SELECT max(hour_utc) FROM XH)) AS hi)"""),
    "anti_left_keys": _w(
        """SELECT region, hour_utc FROM PH WHERE NOT EXISTS
           (SELECT 1 FROM XH WHERE XH.region = PH.region AND XH.hour_utc = PH.hour_utc)"""),
    "anti_right_keys": _w(
        """SELECT region, hour_utc FROM XH WHERE NOT EXISTS
           (SELECT 1 FROM PH WHERE XH.region = PH.region AND XH.hour_utc = PH.hour_utc)"""),
    "existing_overlap": _w(
        """SELECT COUNT(*) AS existing_keys FROM XH WHERE EXISTS
           (SELECT 1 FROM PH WHERE XH.region = PH.region AND XH.hour_utc = PH.hour_utc)"""),
    "key_presence": _w(
        """SELECT COALESCE(PH.region, XH.region) AS region, COALESCE(PH.hour_utc, XH.hour_utc) AS hour_utc,
                  PH.region IS NOT NULL AS in_price, XH.region IS NOT NULL AS in_weather
           FROM PH FULL OUTER JOIN XH ON PH.region = XH.region AND PH.hour_utc = XH.hour_utc"""),
    "hour_gaps": _w("SELECT * FROM GAPS"),
    "hour_gaps_lag": _w("SELECT * FROM GAPS"),
    "worst_gaps_topk": _w("SELECT * FROM GAPS ORDER BY gap_hours DESC, region, hour_utc LIMIT 20"),
    "continuity_breaks": _w("SELECT region, COUNT(*) AS gaps FROM GAPS GROUP BY region"),
    "missing_hours": _w(
        """SELECT region, hour_utc FROM GRID WHERE NOT EXISTS
           (SELECT 1 FROM K WHERE K.region = GRID.region AND K.hour_utc = GRID.hour_utc)""",
        """B AS (SELECT date_trunc('day', min(ts)) AS lo,
                        date_trunc('day', max(ts)) + INTERVAL 23 HOUR AS hi FROM events)""",
        """GRID AS (SELECT region, unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS hour_utc
                    FROM (SELECT DISTINCT event_type AS region FROM events), B)"""),
    "upsert_merge": _w(
        """SELECT * FROM T WHERE event_id NOT IN (SELECT event_id FROM S)
           UNION ALL SELECT * FROM S""",
        "T AS (SELECT * FROM events WHERE event_id % 3 <> 0)",
        """S AS (SELECT event_id, ts, user_id, event_type, value * 2 AS value, props
                 FROM events WHERE event_id % 3 <> 1)"""),
    "latest_per_key": _w(
        """SELECT user_id, hour_utc, max(ts) AS ts, arg_max(event_id, ts) AS event_id,
                  arg_max(value, ts) AS value
           FROM EH GROUP BY user_id, hour_utc"""),
    "increment_filter": _w(
        """SELECT e.* FROM events e LEFT JOIN M ON e.event_type = M.event_type
           WHERE M.mark IS NULL OR e.ts > M.mark"""),
    "increment_lookback": _w(
        """SELECT e.* FROM events e LEFT JOIN M ON e.event_type = M.event_type
           WHERE M.mark IS NULL OR e.ts > M.mark - INTERVAL 2 DAY"""),
    "increment_global": _w(
        """SELECT * FROM events WHERE
           (SELECT max(mark) FROM M) IS NULL OR ts > (SELECT max(mark) FROM M)"""),
    "high_water_mark": _w("SELECT event_type, max(ts) AS mark FROM events GROUP BY 1"),
    "latest_date": _w(
        "SELECT max(CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE)) AS latest_date FROM events"),
    "date_spine": _w(
        """SELECT CAST(d AS DATE) AS day FROM
           (SELECT unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
            FROM (SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events))"""),
    "missing_dates": _w(
        """SELECT region, day FROM GRID WHERE NOT EXISTS
           (SELECT 1 FROM L WHERE L.region = GRID.region AND L.day = GRID.day)""",
        "L AS (SELECT DISTINCT region, CAST(o_orderdate AS DATE) AS day FROM OR_)",
        """GRID AS (SELECT region, CAST(d AS DATE) AS day FROM
                    (SELECT r_name AS region,
                            unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
                     FROM region, (SELECT min(CAST(o_orderdate AS DATE)) AS lo,
                                          max(CAST(o_orderdate AS DATE)) AS hi FROM orders)))"""),
    "null_profile": _w(
        """SELECT count(*) FILTER (WHERE o_orderkey IS NULL) AS o_orderkey_nulls,
                  count(*) FILTER (WHERE o_custkey IS NULL) AS o_custkey_nulls,
                  count(*) FILTER (WHERE o_orderstatus IS NULL) AS o_orderstatus_nulls,
                  count(*) FILTER (WHERE o_totalprice IS NULL) AS o_totalprice_nulls,
                  count(*) FILTER (WHERE o_orderdate IS NULL) AS o_orderdate_nulls,
                  count(*) FILTER (WHERE o_orderpriority IS NULL) AS o_orderpriority_nulls
           FROM O"""),
    "invalid_members": _w(
        "SELECT DISTINCT event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')"),
    "distinct_members": _w("SELECT DISTINCT event_type FROM events"),
    "invalid_interval": _w(
        """SELECT l_orderkey, l_linenumber, o_orderdate, l_shipdate
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate <= o_orderdate"""),
    "duplicate_keys": _w(
        """SELECT user_id, hour_utc, COUNT(*) AS "rows" FROM EH
           GROUP BY user_id, hour_utc HAVING COUNT(*) > 1"""),
    "duplicate_histogram": _w(
        """SELECT copies, COUNT(*) AS "keys" FROM
           (SELECT COUNT(*) AS copies FROM EH GROUP BY user_id, hour_utc HAVING COUNT(*) > 1)
           GROUP BY copies"""),
    "distinct_keys": _w(
        """SELECT CAST(SUM(n) AS BIGINT) AS "rows", COUNT(*) AS distinct_keys,
                  COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys
           FROM (SELECT COUNT(*) AS n FROM EH GROUP BY user_id, hour_utc)"""),
    "row_counts": _w(
        """SELECT 'raw' AS layer, COUNT(*) AS "rows" FROM events
           UNION ALL SELECT 'hourly' AS layer, COUNT(*) AS "rows" FROM K"""),
    "rows_by_region": _w('SELECT event_type, COUNT(*) AS "rows" FROM events GROUP BY 1'),
    "daily_coverage": _w(
        'SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS "rows" FROM events GROUP BY 1, 2 ORDER BY 1, 2'),
    "hour_coverage": _w(
        """SELECT CAST(ts AS DATE) AS day, event_type, COUNT(*) AS "rows",
                  CAST(min(hour(ts)) AS INTEGER) AS min_hour, CAST(max(hour(ts)) AS INTEGER) AS max_hour,
                  COUNT(DISTINCT hour(ts)) AS distinct_hours
           FROM events GROUP BY 1, 2"""),
    # "+ 0.0" only normalises the sign of zero: DuckDB's parallel min over
    # doubles can return -0.0 where the data holds 0.0 (seen at sf0.1).
    "value_profile": _w("SELECT min(value) + 0.0 AS min_value, max(value) + 0.0 AS max_value FROM events"),
    "time_range": _w("SELECT min(hour_utc) AS min_hour, max(hour_utc) AS max_hour FROM G"),
    "day_slice": _w(
        """SELECT * FROM events WHERE event_type = 'click'
           AND ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-11 00:00:00'"""),
    "required_not_null": _w(
        """SELECT * FROM O WHERE o_orderkey IS NULL OR o_custkey IS NULL OR o_orderstatus IS NULL
           OR o_totalprice IS NULL OR o_orderdate IS NULL OR o_orderpriority IS NULL"""),
    "utc_day_completeness": _w(
        """SELECT GRID.region, GRID.day, CAST(COALESCE(C.n, 0) AS BIGINT) AS "rows"
           FROM GRID LEFT JOIN C ON GRID.region = C.region AND GRID.day = C.day
           WHERE COALESCE(C.n, 0) <> 24""",
        "C AS (SELECT region, CAST(hour_utc AS DATE) AS day, COUNT(*) AS n FROM K GROUP BY 1, 2)",
        """GRID AS (SELECT region, CAST(d AS DATE) AS day FROM
                    (SELECT region,
                            unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
                     FROM (SELECT DISTINCT region FROM K),
                          (SELECT min(CAST(hour_utc AS DATE)) AS lo, max(CAST(hour_utc AS DATE)) AS hi FROM K)))"""),
    "region_completeness": _w(
        """SELECT member, 'missing' AS status FROM E WHERE member NOT IN (SELECT member FROM PM)
           UNION ALL
           SELECT member, 'unexpected' AS status FROM PM WHERE member NOT IN (SELECT member FROM E)""",
        "E AS (SELECT * FROM (VALUES ('click'), ('view'), ('purchase'), ('error'), ('refund')) t(member))",
        "PM AS (SELECT DISTINCT event_type AS member FROM events WHERE event_type IS NOT NULL)"),
    "qc_report": _w(
        """SELECT 'Gold rows = distinct keys' AS "check",
                  CASE WHEN r = dk THEN 'PASS' ELSE 'FAIL' END AS status,
                  'rows=' || r || ', distinct_keys=' || dk AS detail FROM KS
           UNION ALL
           SELECT 'Duplicate Gold keys', CASE WHEN dup = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'repeated=' || dup FROM KS
           UNION ALL
           SELECT 'Region completeness', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'missing=' || m || ' (first: ' || m1 || '), unexpected=' || u || ' (first: ' || u1 || ')' FROM MSA
           UNION ALL
           SELECT 'Hourly continuity', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'unexpected_gaps=' || n FROM NG
           UNION ALL
           SELECT 'Gold keys mapped to Electricity', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'missing_keys=' || n FROM MP
           UNION ALL
           SELECT 'Gold keys mapped to Weather', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'missing_keys=' || n FROM MW
           UNION ALL
           SELECT 'Electricity-only keys', 'INFO', 'source_only_keys=' || n FROM PO
           UNION ALL
           SELECT 'Weather-only keys', 'INFO', 'source_only_keys=' || n FROM WO
           UNION ALL
           SELECT 'Required Gold fields not null', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'rows_lacking_a_value=' || n FROM NN
           UNION ALL
           SELECT 'UTC day completeness', CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END,
                  'unexpected_day_counts=' || n FROM DC
           UNION ALL
           SELECT 'Time range', 'INFO',
                  'min=' || COALESCE(CAST(lo AS VARCHAR), '-') || ', max=' || COALESCE(CAST(hi AS VARCHAR), '-')
           FROM (SELECT min(hour_utc) AS lo, max(hour_utc) AS hi FROM G)""",
        """KS AS (SELECT COALESCE(SUM(n), 0) AS r, COUNT(*) AS dk, COUNT(*) FILTER (WHERE n > 1) AS dup
                  FROM (SELECT COUNT(*) AS n FROM G GROUP BY region, hour_utc))""",
        "PT AS (SELECT DISTINCT event_type AS member FROM events)",
        "GM AS (SELECT DISTINCT region AS member FROM G WHERE region IS NOT NULL)",
        """MS AS (SELECT member, 'missing' AS status FROM PT WHERE member NOT IN (SELECT member FROM GM)
                  UNION ALL
                  SELECT member, 'unexpected' AS status FROM GM WHERE member NOT IN (SELECT member FROM PT))""",
        """MSA AS (SELECT COUNT(*) FILTER (WHERE status = 'missing') AS m, COUNT(*) FILTER (WHERE status = 'unexpected') AS u,
                          COALESCE(min(member) FILTER (WHERE status = 'missing'), '-') AS m1,
                          COALESCE(min(member) FILTER (WHERE status = 'unexpected'), '-') AS u1,
                          COUNT(*) AS n FROM MS)""",
        """NG AS (SELECT COUNT(*) AS n FROM
                  (SELECT hour_utc, lag(hour_utc) OVER (PARTITION BY region ORDER BY hour_utc) AS prev FROM G)
                  WHERE prev IS NOT NULL AND date_diff('hour', prev, hour_utc) <> 1)""",
        """MP AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT region, hour_utc FROM G) g
                  WHERE NOT EXISTS (SELECT 1 FROM PH WHERE PH.region = g.region AND PH.hour_utc = g.hour_utc))""",
        """MW AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT region, hour_utc FROM G) g
                  WHERE NOT EXISTS (SELECT 1 FROM XH WHERE XH.region = g.region AND XH.hour_utc = g.hour_utc))""",
        """PO AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT region, hour_utc FROM PH) p
                  WHERE NOT EXISTS (SELECT 1 FROM G WHERE G.region = p.region AND G.hour_utc = p.hour_utc))""",
        """WO AS (SELECT COUNT(*) AS n FROM (SELECT DISTINCT region, hour_utc FROM XH) x
                  WHERE NOT EXISTS (SELECT 1 FROM G WHERE G.region = x.region AND G.hour_utc = x.hour_utc))""",
        """NN AS (SELECT COUNT(*) FILTER (WHERE region IS NULL OR hour_utc IS NULL OR price IS NULL
                                          OR first_price IS NULL OR temperature IS NULL) AS n FROM G)""",
        """DC AS (SELECT COUNT(*) AS n FROM
                  (SELECT member AS region, CAST(d AS DATE) AS day FROM
                     (SELECT member, unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS d
                      FROM PT, (SELECT min(CAST(hour_utc AS DATE)) AS lo, max(CAST(hour_utc AS DATE)) AS hi FROM G))) grid
                  LEFT JOIN (SELECT region, CAST(hour_utc AS DATE) AS day, COUNT(*) AS c FROM G GROUP BY 1, 2) cnt
                  ON grid.region = cnt.region AND grid.day = cnt.day
                  WHERE COALESCE(cnt.c, 0) <> 24)"""),
    "local_time_parts": _w(
        f"""SELECT event_id, ts, {_local('ts')} AS local_time,
                   CAST({_local('ts')} AS DATE) AS local_date,
                   CAST(hour({_local('ts')}) AS INTEGER) AS local_hour
            FROM events"""),
    "dst_local_day_counts": _w(
        f"""SELECT CAST({_local('h')} AS DATE) AS local_date, COUNT(*) AS hours
            FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS h
                  FROM (SELECT min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL 23 HOUR AS hi FROM orders))
            GROUP BY 1"""),
    "parse_offset_timestamp": _w("SELECT event_id, date_trunc('second', ts) AS parsed FROM events"),
    "array_zip_rows": _w(
        """SELECT vec_id, CAST(idx AS BIGINT) AS idx, CAST(c AS DOUBLE) AS component FROM
           (SELECT vec_id, unnest(generate_series(1, len(embedding))) AS idx, unnest(embedding) AS c
            FROM embeddings)"""),
    "location_enrich": _w(
        """SELECT XHA.region, strftime(hour_utc, '%Y-%m-%dT%H:%M') AS weather_time_utc, location, latitude, longitude
           FROM XHA LEFT JOIN LOC ON XHA.region = LOC.region"""),
    "dimension_join": _w("SELECT * FROM CR"),
    "upsert_null_days": _w(
        """SELECT * FROM T WHERE event_id IS NOT NULL AND event_id NOT IN (SELECT event_id FROM S WHERE event_id IS NOT NULL)
           UNION ALL
           SELECT * FROM T WHERE event_id IS NULL AND NOT EXISTS
             (SELECT 1 FROM S WHERE S.event_id IS NULL AND S.ts = T.ts AND S.user_id = T.user_id
                AND S.event_type = T.event_type AND S.value = T.value AND S.day IS NOT DISTINCT FROM T.day)
           UNION ALL SELECT * FROM S""",
        """E AS (SELECT CASE WHEN event_id % 11 <> 0 THEN event_id END AS event_id, event_id AS id, ts, user_id,
                        event_type, value, CASE WHEN event_id % 7 <> 0 THEN CAST(ts AS DATE) END AS day FROM events)""",
        "T AS (SELECT * EXCLUDE (id) FROM E WHERE id % 3 <> 0)",
        "S AS (SELECT * EXCLUDE (id) REPLACE (value * 2 AS value) FROM E WHERE id % 3 <> 1)"),
    "silver_projection": _w(
        f"""SELECT event_id, event_type AS region, ts, value,
                   CAST(ts AS DATE) AS utc_date, CAST(hour(ts) AS INTEGER) AS utc_hour,
                   CAST({_local('ts')} AS DATE) AS local_date,
                   CAST(hour({_local('ts')}) AS INTEGER) AS local_hour
            FROM events"""),
    "silver_prices": _w("SELECT * FROM SPX", SPX.replace("WHERE event_id % 2 = 0", "")),
    "silver_weather": _w(
        f"""SELECT CAST({LOCAL.format(c="hour_utc")} AS DATE) AS weather_date, hour_utc AS weather_time_utc,
                   {LOCAL.format(c="hour_utc")} AS weather_time_local,
                   CAST(hour({LOCAL.format(c="hour_utc")}) AS INTEGER) AS weather_hour,
                   XHA.region, location, latitude, longitude,
                   temperature AS temperature_2m, CAST(50.0 AS DOUBLE) AS relative_humidity_2m,
                   CAST(0.0 AS DOUBLE) AS precipitation, temperature / CAST(10.0 AS DOUBLE) AS wind_speed_10m,
                   1 AS weather_code, 'events' AS source, CAST(hour_utc AS DATE) AS utc_date
            FROM XHA LEFT JOIN LOC ON XHA.region = LOC.region"""),
    "gold_build": _w(
        """SELECT PB.region, PB.hour_utc, NULL::VARCHAR AS location, NULL::DOUBLE AS latitude,
                  NULL::DOUBLE AS longitude, SEK_per_kWh, EUR_per_kWh, EXR,
                  temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, weather_code,
                  CAST(PB.hour_utc AS DATE) AS hour_date
           FROM PB JOIN WB ON PB.region = WB.region AND PB.hour_utc = WB.hour_utc, BND
           WHERE PB.hour_utc BETWEEN BND.lo AND BND.hi""",
        SPX,
        """PB AS (SELECT region, date_trunc('hour', time_start) AS hour_utc,
                  CAST(SUM(CAST(SEK_per_kWh AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(SEK_per_kWh) AS DOUBLE) AS SEK_per_kWh,
                  CAST(SUM(CAST(EUR_per_kWh AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(EUR_per_kWh) AS DOUBLE) AS EUR_per_kWh,
                  min(EXR) AS EXR
           FROM SPX GROUP BY 1, 2)""",
        """WB AS (SELECT region, hour_utc, temperature AS temperature_2m,
                  CAST(50.0 AS DOUBLE) AS relative_humidity_2m, CAST(0.0 AS DOUBLE) AS precipitation,
                  temperature / CAST(10.0 AS DOUBLE) AS wind_speed_10m, 1 AS weather_code FROM XH)""",
        """BND AS (SELECT greatest((SELECT min(hour_utc) FROM PB), (SELECT min(hour_utc) FROM WB)) AS lo,
                          least((SELECT max(hour_utc) FROM PB), (SELECT max(hour_utc) FROM WB)) AS hi)"""),
    "gold_increment": _w(
        """SELECT PB.region, PB.hour_utc, NULL::VARCHAR AS location, NULL::DOUBLE AS latitude,
                  NULL::DOUBLE AS longitude, SEK_per_kWh, EUR_per_kWh, EXR,
                  temperature_2m, relative_humidity_2m, precipitation, wind_speed_10m, weather_code,
                  CAST(PB.hour_utc AS DATE) AS hour_date
           FROM PB JOIN WB ON PB.region = WB.region AND PB.hour_utc = WB.hour_utc
           LEFT JOIN MK ON MK.region = PB.region
           WHERE MK.mark IS NULL OR PB.hour_utc > MK.mark""",
        SPX,
        """PB AS (SELECT region, date_trunc('hour', time_start) AS hour_utc,
                  CAST(SUM(CAST(SEK_per_kWh AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(SEK_per_kWh) AS DOUBLE) AS SEK_per_kWh,
                  CAST(SUM(CAST(EUR_per_kWh AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(EUR_per_kWh) AS DOUBLE) AS EUR_per_kWh,
                  min(EXR) AS EXR
           FROM SPX GROUP BY 1, 2)""",
        """WB AS (SELECT region, hour_utc, temperature AS temperature_2m,
                  CAST(50.0 AS DOUBLE) AS relative_humidity_2m, CAST(0.0 AS DOUBLE) AS precipitation,
                  temperature / CAST(10.0 AS DOUBLE) AS wind_speed_10m, 1 AS weather_code FROM XH)""",
        # the target gold: both feeds cut at the load date, common range, joined
        """PL AS (SELECT region, date_trunc('hour', time_start) AS hour_utc FROM SPX
                  WHERE time_start < TIMESTAMP '2024-01-21 00:00:00' GROUP BY 1, 2)""",
        """WL AS (SELECT region, hour_utc FROM WB WHERE hour_utc < TIMESTAMP '2024-01-21 00:00:00')""",
        """BL AS (SELECT greatest((SELECT min(hour_utc) FROM PL), (SELECT min(hour_utc) FROM WL)) AS lo,
                         least((SELECT max(hour_utc) FROM PL), (SELECT max(hour_utc) FROM WL)) AS hi)""",
        """MK AS (SELECT PL.region, max(PL.hour_utc) AS mark
                  FROM PL JOIN WL ON PL.region = WL.region AND PL.hour_utc = WL.hour_utc, BL
                  WHERE PL.hour_utc BETWEEN BL.lo AND BL.hi AND PL.region <> 'signup' GROUP BY 1)"""),
    "monthly_trend": _w(
        """SELECT region, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  CAST(SUM(CAST(o_totalprice AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(o_totalprice) AS DOUBLE) AS avg_price,
                  min(o_totalprice) AS min_price, max(o_totalprice) AS max_price
           FROM OR_ GROUP BY 1, 2"""),
    "daily_observations": _w(
        """SELECT region, CAST(hour_utc AS DATE) AS day, COUNT(*) AS hours,
                  round(avg(price), 6) AS avg_price, round(avg(temperature), 6) AS avg_temperature,
                  round(avg(wind), 6) AS avg_wind
           FROM GW GROUP BY 1, 2"""),
    "region_correlation": _w(
        """SELECT region, COUNT(*) AS pairs, round(corr(price, temperature), 6) AS corr_price_temperature,
                  round(corr(price, wind), 6) AS corr_price_wind
           FROM GW GROUP BY 1"""),
    "region_spread": _w(
        """SELECT day, avg_click, avg_view, round(avg_click - avg_view, 6) AS spread FROM
           (SELECT CAST(hour_utc AS DATE) AS day,
                   round(avg(price) FILTER (WHERE region = 'click'), 6) AS avg_click,
                   round(avg(price) FILTER (WHERE region = 'view'), 6) AS avg_view
            FROM G WHERE region IN ('click', 'view') GROUP BY 1)"""),
    "region_level": _w(
        """SELECT region, round(s / n, 6) AS mean,
                  round(SUM(s) OVER () / SUM(n) OVER (), 6) AS overall_mean,
                  round(s / n - SUM(s) OVER () / SUM(n) OVER (), 6) AS difference
           FROM (SELECT region, SUM(price) AS s, COUNT(price) AS n FROM G GROUP BY 1)"""),
    "price_volatility": _w("SELECT region, round(stddev_samp(price), 6) AS stddev_price FROM PHA GROUP BY 1"),
    "seasonal_profile": _w(
        """SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day,
                  CAST(SUM(CAST(value AS DECIMAL(18,6))) AS DOUBLE) / CAST(COUNT(value) AS DOUBLE) AS avg_price,
                  COUNT(value) AS observations
           FROM events GROUP BY 1"""),
}
