"""Independent SQL for every registered query, for DuckDB on the same test tables."""

from __future__ import annotations

import re

# Domain tables, stated on their own in SQL. Names start with t_ to stay clear of the test tables.
CTES = {
    "t_location": """
        SELECT CAST(n_nationkey AS VARCHAR) AS location_id, n_name AS location_name, r_name AS city
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "t_session": """
        SELECT *, CAST(year(class_datetime) AS INTEGER) AS year, CAST(month(class_datetime) AS INTEGER) AS month
        FROM (
          SELECT CAST(p_partkey AS VARCHAR) AS session_id, p_brand AS class_code, p_name AS class_name,
                 p_size AS instructor_id, CAST(p_partkey % 25 AS VARCHAR) AS location_id,
                 TIMESTAMP '2024-01-01 00:00:00' + to_hours(p_partkey * 7 % 2160) AS class_datetime,
                 30 + 15 * (p_size % 4) AS duration_mins
          FROM part)""",
    "t_user": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS first_name, c_mktsegment AS last_name,
               lower(c_name) || '@example.com' AS email,
               ['male', 'MALE', 'female', 'Female', 'unknown'][c_custkey % 5 + 1] AS gender,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(16 + c_custkey % 50 AS INTEGER) END AS age,
               CASE WHEN c_custkey % 4 <> 0
                    THEN DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) END AS date_of_birth
        FROM customer""",
    "t_attended": """
        SELECT upper(md5(CAST(o_custkey AS VARCHAR) || CAST(l_partkey AS VARCHAR))) AS attendance_id,
               CAST(o_custkey AS VARCHAR) AS user_id, CAST(l_partkey AS VARCHAR) AS session_id,
               CAST(l_partkey % 25 AS VARCHAR) AS location_id,
               TIMESTAMP '2023-01-01 00:00:00' + to_hours(l_orderkey * 7919 % 11000) AS class_datetime
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "t_raw_event": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
               regexp_extract(props, '([0-9]+)', 1) AS session_id,
               CASE event_type WHEN 'purchase' THEN 'checkin' WHEN 'error' THEN 'cancel' ELSE event_type END AS event_type,
               ts AS event_ts, ts + to_hours(event_id % 5) AS processed_time,
               CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day
        FROM events""",
    "t_event": """
        SELECT e.*, s.location_id, s.class_datetime
        FROM t_raw_event e LEFT JOIN t_session s ON e.session_id = s.session_id""",
    "t_stream": """
        SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, ts AS event_ts
        FROM events""",
    "t_flat": """
        SELECT s.class_code AS class_id, s.class_name, a.user_id, CAST(a.class_datetime AS DATE) AS class_date
        FROM t_attended a JOIN t_session s ON a.session_id = s.session_id""",
    "t_nested": """
        SELECT CAST(l_orderkey AS VARCHAR) AS session_id, 'Class ' || CAST(l_orderkey % 10 AS VARCHAR) AS class_name,
               CASE WHEN l_orderkey % 4 <> 0 THEN 'Coach ' || CAST(l_orderkey % 7 AS VARCHAR) END AS instructor_name,
               CAST(l_orderkey % 25 AS VARCHAR) AS location_id, count(*) AS attendance_count,
               CAST((1672531200 + l_orderkey * 7919 % 11000 * 3600) * 1000 AS VARCHAR) AS class_datetime,
               TIMESTAMP '2024-03-01' AS processed_time, TIMESTAMP '2024-03-01' AS processed_timestamp,
               list({'email': 'u' || CAST(l_suppkey AS VARCHAR) || '@example.com',
                     'user_id': CAST(l_suppkey AS VARCHAR)}) AS attendees
        FROM lineitem GROUP BY l_orderkey""",
    "t_renewal": """
        SELECT o_orderpriority AS membership_type,
               CASE WHEN o_orderstatus = 'F' THEN 'renewed' ELSE 'lapsed' END AS renewal_status,
               o_orderdate AS renewal_date
        FROM orders""",
    "t_facility": """
        SELECT CAST(l_suppkey AS VARCHAR) AS facility_id, s_name AS facility_name,
               CAST(l_shipdate AS DATE) AS usage_date, l_shipdate + to_hours(l_orderkey % 24) AS usage_time
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "t_dirty_user_once": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE ' ' || c_name END AS first_name,
               c_mktsegment AS last_name,
               CASE WHEN c_custkey % 5 <> 0 THEN '  ' || upper(c_name) || '@Example.COM ' END AS email,
               CASE WHEN c_custkey % 6 <> 0
                    THEN '(415) ' || CAST(5550000 + c_custkey % 9999 AS VARCHAR) || ' ext' END AS phone_number,
               CASE WHEN c_custkey % 4 <> 0
                    THEN CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
               ['male', 'MALE', 'female', 'Female', NULL][c_custkey % 5 + 1] AS gender,
               CAST(c_custkey % 25 AS VARCHAR) AS preferred_location_id,
               strftime(TIMESTAMP '2023-01-01 08:30:00' + to_hours(c_custkey * 11 % 9000), '%Y-%m-%dT%H:%M:%S') AS created_at,
               TIMESTAMP '2023-01-01 08:30:00' + to_hours(c_custkey * 11 % 9000) AS registered,
               CASE c_custkey % 3 WHEN 0 THEN TIMESTAMP '2024-02-03 04:05:06' END AS last_seen,
               [-5, NULL, 0, 30][c_custkey % 4 + 1] AS duration
        FROM customer""",
    "t_dirty_user": """
        SELECT * FROM t_dirty_user_once
        UNION ALL SELECT * FROM t_dirty_user_once WHERE CAST(user_id AS BIGINT) % 10 = 0""",
    "t_dirty_event_once": """
        SELECT CAST(event_id AS VARCHAR) AS event_id,
               CASE WHEN event_id % 9 = 0 THEN '  ' ELSE CAST(user_id AS VARCHAR) END AS user_id,
               CASE WHEN event_id % 6 = 0 THEN ' ' || upper(event_type) || ' ' ELSE event_type END AS event_type,
               CASE WHEN event_id % 11 = 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S')
                    WHEN event_id % 13 = 0 THEN 'unknown'
                    WHEN event_id % 17 = 0 THEN NULL
                    WHEN event_id % 19 = 0 THEN lower(strftime(ts, '%Y-%m-%dT%H:%M:%S'))
                    WHEN event_id % 23 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || '.123'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S') END AS event_ts,
               ['', NULL, ' Room A ', 'room a'][event_id % 4 + 1] AS location_id,
               [-5, NULL, 0, 30][event_id % 4 + 1] AS duration,
               ['(415) 555-0100', NULL, 'n/a'][event_id % 3 + 1] AS phone_number,
               CASE WHEN event_id % 11 <> 0 AND event_id % 13 <> 0 AND event_id % 17 <> 0
                         AND (event_id % 19 = 0 OR event_id % 23 <> 0)
                    THEN date_trunc('second', ts) END AS good_ts
        FROM events""",
    "t_dirty_event": """
        SELECT * FROM t_dirty_event_once
        UNION ALL SELECT * FROM t_dirty_event_once WHERE CAST(event_id AS BIGINT) % 10 = 0""",
    "t_dirty_schedule": """
        SELECT CAST(p_partkey AS VARCHAR) AS session_id,
               CASE WHEN p_partkey % 5 <> 0 THEN p_brand END AS class_code,
               CASE WHEN p_partkey % 7 <> 0 THEN '  ' || p_name || ' ' || n.suffix END AS class_name,
               CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS instructor_id,
               CASE WHEN p_partkey % 6 <> 0 THEN ' Coach ' || CAST(p_size AS VARCHAR) END AS instructor_name,
               CASE WHEN p_partkey % 8 <> 0 THEN CAST(p_partkey % 25 AS VARCHAR) END AS loc_id,
               CASE WHEN p_partkey % 9 <> 0 THEN p_type END AS city,
               CASE WHEN p_partkey % 10 <> 0 THEN p_type || ' ' END AS location_name,
               CASE WHEN p_partkey % 3 <> 0 THEN 30 + 15 * (p_size % 4) END AS duration_mins,
               TIMESTAMP '2024-01-01' + to_hours(p_partkey % 100 + n.later) AS processed_time
        FROM part JOIN (VALUES (0, ''), (5, '(moved)')) AS n(later, suffix) ON n.later = 0 OR p_partkey % 3 = 0""",
    "t_dirty_snapshot": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id,
               CASE WHEN c_custkey % 7 <> 0 THEN c_name END AS first_name,
               CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS last_name,
               CASE WHEN c_custkey % 6 <> 0 THEN ' ' || c_name || '@Example.COM' END AS email,
               CASE WHEN c_custkey % 4 <> 0
                    THEN '+1 415-' || CAST(5550000 + c_custkey % 9999 AS VARCHAR) END AS phone_number,
               CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 25 AS VARCHAR) END AS preferred_location_id,
               TIMESTAMP '2023-01-01' + to_hours(c_custkey * 11 % 9000 + n.later) AS created_at
        FROM customer JOIN (VALUES (0), (9)) AS n(later) ON n.later = 0 OR c_custkey % 4 = 0""",
    "t_users": """
        SELECT CAST(c_custkey AS VARCHAR) AS user_id, c_name AS first_name, c_mktsegment AS last_name,
               lower(c_name) || '@example.com' AS email, CAST(5550000 + c_custkey % 9999 AS VARCHAR) AS phone_number,
               CASE WHEN c_custkey % 4 <> 0
                    THEN CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) AS VARCHAR) END AS date_of_birth,
               ['male', 'MALE', 'female', 'Female', 'unknown'][c_custkey % 5 + 1] AS gender, 'UNKNOWN' AS city,
               CAST(c_custkey % 25 AS VARCHAR) AS preferred_location_id,
               strftime(TIMESTAMP '2023-01-01' + to_hours(c_custkey * 11 % 9000), '%Y-%m-%d %H:%M:%S') AS created_at,
               CAST(16 + c_custkey % 50 AS INTEGER) AS age, CAST(length(c_name) AS INTEGER) AS full_name_length,
               CAST(NULL AS TIMESTAMP) AS processed_time, CAST(NULL AS TIMESTAMP) AS processed_timestamp,
               CAST(NULL AS INTEGER) AS day, CAST(NULL AS VARCHAR) AS partition_0,
               CAST(NULL AS INTEGER) AS year, CAST(NULL AS INTEGER) AS month
        FROM customer WHERE c_custkey % 2 = 0
        UNION ALL
        SELECT CAST(c_custkey AS VARCHAR), lower(c_name), lower(c_mktsegment), lower(c_name) || '@example.com',
               CAST(5550000 + c_custkey % 9999 AS VARCHAR),
               CASE WHEN c_custkey % 3 = 0 THEN 'unknown'
                    ELSE CAST(DATE '1960-01-01' + CAST(c_custkey * 37 % 16000 AS INTEGER) AS VARCHAR) END,
               lower(['male', 'MALE', 'female', 'Female', 'unknown'][c_custkey % 5 + 1]), 'unknown',
               CAST(c_custkey % 25 AS VARCHAR),
               CASE WHEN c_custkey % 5 = 0 THEN 'unknown'
                    ELSE strftime(TIMESTAMP '2023-06-01' + to_hours(c_custkey * 13 % 5000), '%Y-%m-%d %H:%M:%S') END,
               NULL, NULL, TIMESTAMP '2024-03-01', TIMESTAMP '2024-03-01', CAST(1 + c_custkey % 28 AS INTEGER), 'users',
               2024, CAST(1 + c_custkey % 3 AS INTEGER)
        FROM customer WHERE c_custkey % 2 = 1""",
    "t_schedule": """
        SELECT CAST(p_partkey AS VARCHAR) AS session_id, CAST(d AS DATE) AS date, strftime(d, '%H:%M:%S') AS time,
               d AS datetime, p_brand AS class_code, p_name AS class_name,
               CASE WHEN p_partkey % 10 = 0 THEN -1 ELSE p_size END AS instructor_id,
               'Coach ' || CAST(p_size AS VARCHAR) AS instructor_name, CAST(p_partkey % 25 AS VARCHAR) AS loc_id,
               p_type AS city, 'Hall ' || CAST(p_partkey % 25 AS VARCHAR) AS location_name,
               CAST(1 + p_partkey % 52 AS INTEGER) AS week_number, CAST(year(d) AS INTEGER) AS year,
               CAST(month(d) AS INTEGER) AS month, dayname(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
               30 + 15 * (p_size % 4) AS duration_mins, CAST(NULL AS TIMESTAMP) AS release_timestamp,
               TIMESTAMP '2024-03-01' AS processed_time
        FROM (SELECT *, TIMESTAMP '2024-01-01' + to_hours(p_partkey * 7 % 2160) AS d FROM part) WHERE p_partkey % 2 = 0
        UNION ALL
        SELECT CAST(p_partkey AS VARCHAR), CASE WHEN p_partkey % 9 <> 0 THEN CAST(d AS DATE) END,
               strftime(d, '%H:%M:%S'), CASE WHEN p_partkey % 7 <> 0 THEN d END, lower(p_brand), lower(p_name),
               CASE WHEN p_partkey % 5 <> 0 THEN p_size END, 'coach ' || CAST(p_size AS VARCHAR),
               CAST(p_partkey % 25 AS VARCHAR), lower(p_type), 'hall ' || CAST(p_partkey % 25 AS VARCHAR),
               CAST(1 + p_partkey % 52 AS INTEGER), CAST(year(d) AS INTEGER), CAST(month(d) AS INTEGER),
               lower(dayname(d)), dayofweek(d) IN (0, 6), 30 + 15 * (p_size % 4),
               CASE WHEN p_partkey % 11 <> 0 THEN d END, TIMESTAMP '2024-03-01'
        FROM (SELECT *, TIMESTAMP '2024-01-01' + to_hours(p_partkey * 7 % 2160) AS d FROM part) WHERE p_partkey % 2 = 1""",
    "t_cleaned_event": """
        SELECT CASE WHEN CAST(event_id AS BIGINT) % 101 <> 0 THEN event_id END AS event_id, user_id, session_id,
               CASE WHEN CAST(event_id AS BIGINT) % 103 <> 0 THEN event_type END AS event_type, event_ts,
               CAST(CAST(session_id AS BIGINT) % 25 AS VARCHAR) AS location_id,
               CASE WHEN CAST(event_id AS BIGINT) % 13 <> 0
                    THEN TIMESTAMP '2024-01-01' + to_hours(CAST(session_id AS BIGINT) * 7 % 2160) END AS class_datetime,
               processed_time, year, month, day
        FROM t_raw_event""",
    # Results that several checks start from.
    "r_days": """
        SELECT CAST(dayofweek(class_datetime) + 1 AS INTEGER) AS weekday, count(*) AS total_sessions
        FROM (
          SELECT class_datetime FROM t_attended WHERE year(class_datetime) = 2024 AND class_datetime < DATE '2024-02-01'
          UNION ALL
          SELECT class_datetime FROM r_latest_ts
          WHERE event_type = 'signup' AND NOT EXISTS (
            SELECT 1 FROM t_event o
            WHERE o.year = 2024 AND o.month IN (1, 2) AND o.event_type IN ('checkin', 'cancel')
              AND o.user_id = r_latest_ts.user_id AND o.session_id = r_latest_ts.session_id))
        GROUP BY 1""",
    "r_hours": """
        SELECT CAST(hour(class_datetime) AS INTEGER) AS class_hour, count(*) AS total_sessions
        FROM (
          SELECT class_datetime FROM t_attended WHERE year(class_datetime) = 2024 AND class_datetime < DATE '2024-02-01'
          UNION ALL
          SELECT class_datetime FROM r_latest_ts WHERE event_type = 'signup')
        GROUP BY 1""",
    "r_latest_ts": """
        SELECT * FROM t_event WHERE year = 2024 AND month IN (1, 2)
        QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                   ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
    "r_trend": """
        SELECT location_id, lower(city) AS city, lower(location_name) AS location_name, year, month,
               CAST(sum(n) AS BIGINT) AS total_attendance
        FROM (
          SELECT l.location_id, l.city, l.location_name, s.year, s.month, count(DISTINCT p.user_id || p.session_id) AS n
          FROM (
            SELECT 1 AS half, user_id, session_id FROM t_attended
            UNION ALL
            SELECT 2, user_id, session_id FROM (
              SELECT * FROM t_event WHERE event_ts >= DATE '2024-01-01' AND event_ts < DATE '2025-01-01'
              QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                         ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
            WHERE event_type = 'signup') p
          JOIN t_session s ON p.session_id = s.session_id AND s.year = 2024
          JOIN t_location l ON s.location_id = l.location_id
          GROUP BY p.half, l.location_id, l.city, l.location_name, s.year, s.month)
        GROUP BY ALL""",
    "r_board": """
        SELECT u.user_id, u.first_name, u.last_name, c.total_classes_attended
        FROM (
          SELECT user_id, count(DISTINCT session_id) AS total_classes_attended
          FROM (
            SELECT user_id, session_id FROM t_attended
            WHERE class_datetime >= TIMESTAMP '2024-01-01' AND class_datetime < TIMESTAMP '2024-02-01'
            UNION ALL
            SELECT user_id, session_id FROM (
              SELECT * FROM t_event
              WHERE event_ts >= TIMESTAMP '2024-01-01' AND event_ts < TIMESTAMP '2024-02-01'
                AND event_type IN ('signup', 'cancel')
              QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                  ORDER BY event_ts DESC NULLS LAST, processed_time DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
            WHERE event_type = 'signup')
          GROUP BY user_id) c
        JOIN t_user u ON c.user_id = u.user_id
        ORDER BY total_classes_attended DESC, user_id LIMIT 20""",
    "r_popular": """
        SELECT s.class_name, count(DISTINCT p.user_id || p.session_id) AS attendance_count
        FROM (
          SELECT user_id, session_id FROM t_attended
          UNION ALL
          SELECT user_id, session_id FROM (
            SELECT * FROM t_event WHERE year = 2024
            QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                       ORDER BY processed_time DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
          WHERE event_type = 'signup') p
        JOIN t_session s ON p.session_id = s.session_id AND s.year = 2024
        GROUP BY s.class_name
        ORDER BY attendance_count DESC, class_name LIMIT 10""",
    "r_activity_processed": """
        SELECT user_id, max(t) AS last_activity_time FROM (
          SELECT user_id, class_datetime AS t FROM t_attended
          UNION
          SELECT user_id, event_ts FROM (
            SELECT * FROM t_event WHERE event_type IN ('signup', 'checkin', 'cancel')
            QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                       ORDER BY processed_time DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
          WHERE event_type = 'signup')
        GROUP BY user_id""",
    "r_activity_ts": """
        SELECT user_id, max(t) AS last_activity_time FROM (
          SELECT user_id, class_datetime AS t FROM t_attended
          UNION
          SELECT user_id, event_ts FROM (
            SELECT * FROM t_event WHERE event_type IN ('signup', 'checkin', 'cancel')
            QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                       ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
          WHERE event_type = 'signup')
        GROUP BY user_id""",
    "r_churned": """
        SELECT c.user_id, u.email, c.last_activity_time, c.days_inactive
        FROM (
          SELECT user_id, last_activity_time,
                 CAST(date_sub('day', last_activity_time, TIMESTAMP '2024-04-05') AS INTEGER) AS days_inactive
          FROM r_activity_ts) c
        LEFT JOIN t_user u ON c.user_id = u.user_id
        WHERE c.days_inactive > 90""",
    "r_age": """
        SELECT CASE WHEN a < 25 THEN '<25' WHEN a < 35 THEN '25-34' WHEN a < 45 THEN '35-44' ELSE '45+' END AS age_group,
               count(*) AS total
        FROM (
          SELECT DISTINCT user_id, coalesce(age, date_sub('year', date_of_birth, DATE '2024-04-05')) AS a
          FROM t_user WHERE age IS NOT NULL OR date_of_birth IS NOT NULL)
        GROUP BY 1""",
}


def with_tables(body: str) -> str:
    """``body`` preceded by the common tables it mentions, in dependency order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if re.search(rf"\b{name}\b", sql) and name not in needed:
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    head = ",\n".join(f"{name} AS ({CTES[name]})" for name in needed)
    return f"WITH {head}\n{body}" if needed else body


def _last_days(column: str, day: str, days: int) -> str:
    return f"{column} >= DATE '{day}' - INTERVAL {days} DAY"


BODIES: dict[str, str] = {
    "q01_total_events": "SELECT count(*) AS total_events FROM events",
    "q02_event_types": """SELECT event_type, count(*) AS event_count FROM events
        GROUP BY event_type ORDER BY event_count DESC, event_type LIMIT 10""",
    "q03_recent_events": """SELECT event_id, event_type, event_ts FROM t_stream
        ORDER BY event_ts DESC NULLS LAST, event_id DESC LIMIT 100""",
    "q04_daily_trends": f"""SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, count(*) AS event_count
        FROM events WHERE {_last_days('ts', '2024-01-31', 30)} GROUP BY 1""",
    "q05_hourly": f"""SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS event_count
        FROM events WHERE {_last_days('ts', '2024-01-31', 7)} GROUP BY 1""",
    "q06_weekly_trends": f"""SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS week, count(*) AS event_count
        FROM events WHERE {_last_days('ts', '2024-01-31', 90)} GROUP BY 1""",
    "q07_class_days": """SELECT weekday,
          ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][weekday] AS weekday_name,
          total_sessions FROM r_days""",
    "q08_class_times": "SELECT class_hour, total_sessions FROM r_hours",
    "q09_active_users": f"""SELECT user_id, count(*) AS activity_count FROM t_stream
        WHERE {_last_days('event_ts', '2024-01-31', 30)}
        GROUP BY user_id ORDER BY activity_count DESC, user_id LIMIT 20""",
    "q10_type_prefs": f"""SELECT user_id, event_type, count(*) AS type_count FROM t_stream
        WHERE {_last_days('event_ts', '2024-01-31', 30)}
        GROUP BY user_id, event_type ORDER BY user_id, type_count DESC, event_type LIMIT 100""",
    "q11_engagement": f"""SELECT user_id, count(DISTINCT CAST(event_ts AS DATE)) AS active_days,
          CAST(count(*) AS BIGINT) AS total_events,
          count(*) // count(DISTINCT CAST(event_ts AS DATE)) AS events_per_day
        FROM t_stream WHERE {_last_days('event_ts', '2024-01-31', 30)}
        GROUP BY user_id HAVING count(DISTINCT CAST(event_ts AS DATE)) > 1
        ORDER BY events_per_day DESC, user_id LIMIT 20""",
    "q12_churn_summary": """SELECT churn_status, count(*) AS user_count,
          round(CAST(count(*) AS DOUBLE) * 100 / sum(count(*)) OVER (), 2) AS percentage
        FROM (SELECT CASE WHEN last_activity_time < TIMESTAMP '2024-04-05' - INTERVAL 90 DAY
                          THEN 'Churned' ELSE 'Active' END AS churn_status FROM r_activity_processed)
        GROUP BY churn_status""",
    "q13_class_attendance": f"""SELECT class_id, class_name, count(DISTINCT user_id) AS attendance_count FROM t_flat
        WHERE {_last_days('class_date', '2024-04-05', 30)}
        GROUP BY class_id, class_name ORDER BY attendance_count DESC, class_id, class_name LIMIT 20""",
    "q14_renewal_rate": f"""SELECT membership_type, count(*) FILTER (renewal_status = 'renewed') AS renewed,
          count(*) AS total,
          CAST(count(*) FILTER (renewal_status = 'renewed') AS DOUBLE) * 100 / count(*) AS renewal_rate
        FROM t_renewal WHERE {_last_days('renewal_date', '2001-08-01', 90)} GROUP BY membership_type""",
    "q15_inactivity_risk": """SELECT user_id, last_activity_date, days_inactive,
          CASE WHEN days_inactive > 30 THEN 'High Risk' WHEN days_inactive > 14 THEN 'Medium Risk' ELSE 'Low Risk' END
            AS churn_risk
        FROM (SELECT user_id, max(event_ts) AS last_activity_date,
                     CAST(DATE '2024-01-31' - CAST(max(event_ts) AS DATE) AS INTEGER) AS days_inactive
              FROM t_stream GROUP BY user_id)
        ORDER BY days_inactive DESC NULLS LAST, user_id LIMIT 100""",
    "q16_facility_usage": f"""SELECT facility_id, facility_name, count(*) AS usage_count FROM t_facility
        WHERE {_last_days('usage_date', '2001-08-01', 30)} GROUP BY ALL""",
    "q17_facility_peak": f"""SELECT CAST(hour(usage_time) AS INTEGER) AS hour_of_day, facility_id, facility_name,
          count(*) AS usage_count
        FROM t_facility WHERE {_last_days('usage_date', '2001-08-01', 14)} GROUP BY ALL""",
    "q18_facility_trend": f"""SELECT CAST(usage_date AS TIMESTAMP) AS day, facility_id, facility_name,
          count(*) AS usage_count
        FROM t_facility WHERE {_last_days('usage_date', '2001-08-01', 30)} GROUP BY ALL""",
    "q19_location_trend": "SELECT * FROM r_trend",
    "q20_leaderboard": "SELECT * FROM r_board",
    "q21_popular_classes": "SELECT * FROM r_popular",
    "q22_churned_users": "SELECT * FROM r_churned",
    "q23_age": "SELECT * FROM r_age",
    "q24_gender": """SELECT CASE lower(gender) WHEN 'male' THEN 'Male' ELSE 'Female' END AS standardized_gender,
          count(*) AS total
        FROM t_user WHERE lower(gender) IN ('male', 'female') GROUP BY 1""",
    "q26_ad_hoc_sql": """SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n
        FROM events GROUP BY event_type, CAST(ts AS DATE)""",
    # Roll-ups.
    "p01_as_numbers": """SELECT first_name, count(*) AS n, sum(TRY_CAST(duration AS DOUBLE)) AS d,
          count(TRY_CAST(date_of_birth AS DOUBLE)) AS readable
        FROM t_dirty_user GROUP BY first_name""",
    "p02_top_classes": "SELECT * FROM r_popular ORDER BY attendance_count DESC, class_name LIMIT 5",
    "p03_periods": """SELECT CASE WHEN class_hour BETWEEN 5 AND 8 THEN 'Early Morning (5-8)'
            WHEN class_hour BETWEEN 9 AND 11 THEN 'Morning (9-11)' WHEN class_hour BETWEEN 12 AND 13 THEN 'Noon (12-13)'
            WHEN class_hour BETWEEN 14 AND 16 THEN 'Afternoon (14-16)' WHEN class_hour BETWEEN 17 AND 20
            THEN 'Evening (17-20)' ELSE 'Night (21-23)' END AS period,
          CAST(sum(total_sessions) AS BIGINT) AS total_sessions
        FROM r_hours WHERE class_hour >= 5 GROUP BY 1""",
    "p04_periods_zero": """SELECT period, CAST(coalesce(sum(total_sessions), 0) AS BIGINT) AS total_sessions
        FROM (VALUES ('Early Morning (5-8)', 5, 8), ('Morning (9-11)', 9, 11), ('Noon (12-13)', 12, 13),
                     ('Afternoon (14-16)', 14, 16), ('Evening (17-20)', 17, 20), ('Night (21-23)', 21, 23)) p(period, a, b)
        LEFT JOIN (SELECT * FROM r_hours WHERE class_hour < 12) ON class_hour BETWEEN a AND b
        GROUP BY period""",
    "p05_weekend": """SELECT CASE WHEN weekday IN (1, 7) THEN 'Weekend (Sat-Sun)' ELSE 'Weekday (Mon-Fri)' END AS period,
          CAST(sum(total_sessions) AS BIGINT) AS total_sessions
        FROM r_days WHERE weekday IS NOT NULL GROUP BY 1""",
    "p07_location_totals": """SELECT location_name, CAST(sum(total_attendance) AS BIGINT) AS total_attendance
        FROM r_trend GROUP BY 1""",
    "p08_city_totals": """SELECT city, CAST(sum(total_attendance) AS BIGINT) AS total_attendance
        FROM r_trend GROUP BY 1""",
    "p09_of_year": "SELECT * FROM r_trend WHERE year = 2024",
    "p10_age_order": "SELECT * FROM r_age",
    "p11_share": """SELECT class_hour, total_sessions,
          round(CAST(total_sessions AS DOUBLE) * 100 / (SELECT sum(total_sessions) FROM r_hours), 1) AS share
        FROM r_hours""",
    "p12_share_guard": """SELECT age_group, total,
          round(CAST(total AS DOUBLE) * 100 / (SELECT sum(total) FROM r_age WHERE age_group <> '45+'), 1) AS share
        FROM r_age WHERE age_group <> '45+'""",
    "p13_rank": """SELECT CAST(row_number() OVER (ORDER BY total_classes_attended DESC, user_id) AS INTEGER) AS "Rank",
          first_name AS "First Name", last_name AS "Last Name", total_classes_attended AS "Classes Attended"
        FROM r_board""",
    "p14_churned_total": "SELECT count(*) AS total FROM r_churned",
    "p15_histogram": """
        SELECT b.bin, e.lo + (e.hi - e.lo) * (b.bin - 1) / 10 AS bin_start, e.lo + (e.hi - e.lo) * b.bin / 10 AS bin_end,
               count(c.days_inactive) AS n
        FROM (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS bin) b
        CROSS JOIN (SELECT CAST(min(days_inactive) AS DOUBLE) AS lo, CAST(max(days_inactive) AS DOUBLE) AS hi
                    FROM r_churned) e
        LEFT JOIN r_churned c
          ON least(CAST(floor((c.days_inactive - e.lo) * 10 / (e.hi - e.lo)) AS INTEGER), 9) + 1 = b.bin
        GROUP BY b.bin, e.lo, e.hi""",
    # Latest state under its five parameter sets, and the two set operations.
    "w1_latest_state": "SELECT user_id, session_id, event_id, event_ts FROM r_latest_ts WHERE event_type = 'signup'",
    "w1_by_processed_time": """SELECT user_id, session_id, event_id, event_type FROM t_event
        WHERE event_type IN ('signup', 'checkin', 'cancel')
        QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                   ORDER BY processed_time DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
    "w1_by_two_times": """SELECT user_id, session_id, event_id FROM (
          SELECT * FROM t_event
          WHERE event_ts >= TIMESTAMP '2024-01-01' AND event_ts < TIMESTAMP '2024-02-01'
            AND event_type IN ('signup', 'cancel')
          QUALIFY row_number() OVER (PARTITION BY user_id, session_id
              ORDER BY event_ts DESC NULLS LAST, processed_time DESC NULLS LAST, event_id DESC NULLS LAST) = 1)
        WHERE event_type = 'signup'""",
    "r11_anti": """SELECT user_id, session_id, event_id FROM r_latest_ts
        WHERE event_type = 'signup' AND (user_id, session_id) NOT IN (
          SELECT (user_id, session_id) FROM t_event
          WHERE year = 2024 AND month IN (1, 2) AND event_type IN ('checkin', 'cancel'))""",
    "r25_union_distinct": """SELECT user_id, session_id FROM t_attended
        UNION SELECT user_id, session_id FROM t_event""",
    # Scalar functions by family.
    "f_text": """SELECT c_custkey, lower(c_name) AS low, trim('  ' || c_name || '  ') AS trimmed,
          replace(lower(c_mktsegment), 't', ' ') AS replaced, regexp_replace(c_name, '[^0-9]', '', 'g') AS digits,
          substring(c_name, 1, 10) AS head, c_name || c_mktsegment AS joined, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS padded,
          upper(md5(c_name)) AS hash
        FROM customer""",
    "f_casts": """SELECT user_id, TRY_CAST(date_of_birth AS DATE) AS born, TRY_CAST(created_at AS TIMESTAMP) AS created,
          coalesce(TRY_CAST(first_name AS BIGINT), -1) AS number
        FROM t_users""",
    "f_dates": """SELECT event_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day_start,
          CAST(date_trunc('week', ts) AS TIMESTAMP) AS week_start, CAST(hour(ts) AS INTEGER) AS hour_of_day,
          CAST(year(ts) AS INTEGER) AS y, CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday,
          CAST(date_sub('day', ts, TIMESTAMP '2024-04-05') AS INTEGER) AS whole_days,
          CAST(DATE '2024-04-05' - CAST(ts AS DATE) AS INTEGER) AS calendar_days,
          make_date(year(ts), month(ts), day(ts)) AS of_parts,
          CAST(make_timestamp((1746093600123 + event_id * 1000) // 1000 * 1000000) AS TIMESTAMP) AS from_millis
        FROM events""",
    "f_years": """SELECT user_id, CAST(date_sub('year', date_of_birth, DATE '2024-04-05') AS INTEGER) AS years
        FROM t_user WHERE date_of_birth IS NOT NULL""",
    "f_math": """SELECT o_orderkey, round(o_totalprice, 2) AS rounded, CAST(floor(o_totalprice) AS BIGINT) AS floored,
          o_custkey // 7 AS quotient
        FROM orders""",
    # Warehouse.
    "m01_users": "SELECT * FROM t_users",
    "m02_schedule": "SELECT * FROM t_schedule",
    "m03_instructor": "SELECT DISTINCT instructor_id, instructor_name FROM t_schedule WHERE instructor_id IS NOT NULL",
    "m04_expand": """SELECT attendance_count, class_datetime, class_name, instructor_name, location_id, session_id,
          processed_time, processed_timestamp, a.email AS email, a.user_id AS user_id
        FROM (SELECT * EXCLUDE (attendees), unnest(attendees) AS a FROM t_nested)""",
    "m05_dim_user": """SELECT user_id, first_name, last_name, gender, email, phone_number,
          TRY_CAST(date_of_birth AS DATE) AS date_of_birth, age, city, preferred_location_id,
          TRY_CAST(created_at AS TIMESTAMP) AS created_at
        FROM t_users""",
    "m06_dim_class_session": """SELECT session_id, class_code, class_name, instructor_id, loc_id AS location_id,
          datetime AS class_datetime, duration_mins, week_number, year, month, day_of_week, is_weekend, release_timestamp
        FROM t_schedule""",
    "m07_dim_location": "SELECT DISTINCT loc_id AS location_id, location_name, city FROM t_schedule",
    "m08_fact_attendance": """SELECT upper(md5(a.user_id || session_id)) AS attendance_id, a.user_id AS user_id, session_id,
          location_id, make_timestamp(CAST(class_datetime AS BIGINT) // 1000 * 1000000) AS class_datetime, processed_time
        FROM (SELECT *, unnest(attendees) AS a FROM t_nested)""",
    "m09_fact_event": """SELECT event_id, user_id, session_id, event_type, event_ts, location_id, class_datetime,
          processed_time, make_date(year, month, day) AS event_partition_date, year, month
        FROM t_cleaned_event WHERE event_id IS NOT NULL AND event_type IS NOT NULL""",
    # Cleaning.
    "c01_drop_copies": "SELECT DISTINCT event_id, user_id, event_type, event_ts, location_id, duration, phone_number FROM t_dirty_event",
    "c02_one_per_key": """SELECT session_id, class_name, processed_time FROM t_dirty_schedule
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY processed_time DESC) = 1""",
    "c03_drop_empty": """SELECT location_id, phone_number FROM t_dirty_event
        WHERE location_id IS NOT NULL OR phone_number IS NOT NULL""",
    "c05_c07_lower_fill": """SELECT user_id, coalesce(lower(first_name), 'unknown') AS first_name,
          coalesce(lower(gender), 'unknown') AS gender FROM t_dirty_user""",
    "c06_c08_trim_fill": """SELECT event_id, CASE WHEN coalesce(trim(user_id), '') = '' THEN 'unknown'
          ELSE lower(trim(user_id)) END AS user_id,
          CASE WHEN coalesce(trim(location_id), '') = '' THEN 'unknown' ELSE lower(trim(location_id)) END AS location_id
        FROM t_dirty_event""",
    "c09_defaults": """SELECT session_id, coalesce(class_code, 'UNKNOWN') AS class_code, coalesce(class_name, 'UNKNOWN') AS class_name,
          coalesce(instructor_id, -1) AS instructor_id, coalesce(instructor_name, 'UNKNOWN') AS instructor_name,
          coalesce(loc_id, 'UNKNOWN') AS loc_id, coalesce(city, 'UNKNOWN') AS city,
          coalesce(location_name, 'UNKNOWN') AS location_name, coalesce(duration_mins, 0) AS duration_mins, processed_time
        FROM t_dirty_schedule""",
    "c10_fill_text": """SELECT event_id, user_id, event_type, coalesce(event_ts, 'UNKNOWN') AS event_ts,
          coalesce(location_id, 'UNKNOWN') AS location_id, duration, coalesce(phone_number, 'UNKNOWN') AS phone_number
        FROM t_dirty_event""",
    "c11_trim_names": """SELECT session_id, trim(class_name) AS class_name, trim(instructor_name) AS instructor_name
        FROM t_dirty_schedule""",
    "c20_day_parts": """SELECT DISTINCT folder,
          CASE WHEN dated THEN CAST(left(d, 4) AS INTEGER) ELSE 2025 END AS year,
          CASE WHEN dated THEN CAST(substring(d, 5, 2) AS INTEGER) ELSE 1 END AS month,
          CASE WHEN dated THEN CAST(right(d, 2) AS INTEGER) ELSE 1 END AS day
        FROM (
          SELECT d, event_type IN ('click', 'error', 'signup') AS dated,
            CASE event_type WHEN 'click' THEN 'events_' || d WHEN 'view' THEN 'events_' || left(d, 4)
              WHEN 'error' THEN 'other_' || d WHEN 'signup' THEN 'events_' || d || '_x' ELSE 'events' END AS folder
          FROM (SELECT event_type, strftime(ts, '%Y%m%d') AS d FROM events))""",
    "c12_c13_contact": """SELECT user_id, lower(trim(email)) AS email, regexp_replace(phone_number, '[^0-9]', '', 'g') AS phone_number
        FROM t_dirty_user""",
    "c14_c15_duration": """SELECT event_id, CASE WHEN duration < 0 THEN 0 ELSE duration END AS keep_null,
          CASE WHEN duration IS NULL OR duration < 0 THEN 0 ELSE duration END AS no_null FROM t_dirty_event""",
    "c16_c17_event_time": "SELECT event_id, good_ts AS event_ts, CAST(good_ts AS DATE) AS event_date FROM t_dirty_event",
    "c18_default_times": """SELECT user_id, registered AS registration_date, last_seen AS last_login FROM t_dirty_user""",
    "c21_report": """SELECT count(*) AS rows_in, count(DISTINCT event_id) AS rows_out,
          count(*) - count(DISTINCT event_id) AS removed FROM t_dirty_event""",
    "c22_unreadable": """SELECT event_id, event_ts FROM t_dirty_event WHERE event_ts IS NOT NULL AND good_ts IS NULL""",
    "c23_clean_pii": """SELECT DISTINCT user_id, coalesce(lower(first_name), 'unknown') AS first_name,
          lower(last_name) AS last_name, coalesce(lower(trim(email)), 'unknown') AS email,
          coalesce(regexp_replace(phone_number, '[^0-9]', '', 'g'), '') AS phone_number,
          coalesce(date_of_birth, 'unknown') AS date_of_birth, coalesce(lower(gender), 'unknown') AS gender,
          preferred_location_id, lower(created_at) AS created_at, registered AS registration_date,
          last_seen AS last_login, TIMESTAMP '2024-03-01' AS processed_timestamp, 2024 AS year, 1 AS month, 15 AS day,
          CASE WHEN duration < 0 THEN 0 ELSE duration END AS duration
        FROM t_dirty_user""",
    "c24_clean_nonpii": """SELECT DISTINCT event_id,
          CASE WHEN trim(user_id) = '' THEN 'unknown' ELSE user_id END AS user_id, lower(trim(event_type)) AS event_type,
          good_ts AS event_ts, CASE WHEN coalesce(location_id, '') = '' THEN 'unknown' ELSE lower(trim(location_id)) END AS location_id,
          CASE WHEN coalesce(duration, 0) < 0 THEN 0 ELSE coalesce(duration, 0) END AS duration,
          coalesce(regexp_replace(phone_number, '[^0-9]', '', 'g'), '') AS phone_number,
          CAST(good_ts AS DATE) AS event_date, TIMESTAMP '2024-03-01' AS processed_timestamp,
          2024 AS year, 1 AS month, 15 AS day
        FROM t_dirty_event""",
    "c25_schedule": """SELECT session_id, coalesce(class_code, 'UNKNOWN') AS class_code,
          trim(coalesce(class_name, 'UNKNOWN')) AS class_name, coalesce(instructor_id, -1) AS instructor_id,
          trim(coalesce(instructor_name, 'UNKNOWN')) AS instructor_name, coalesce(loc_id, 'UNKNOWN') AS loc_id,
          coalesce(city, 'UNKNOWN') AS city, trim(coalesce(location_name, 'UNKNOWN')) AS location_name,
          coalesce(duration_mins, 0) AS duration_mins, processed_time
        FROM t_dirty_schedule
        QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY processed_time DESC) = 1""",
    "c26_users": """SELECT user_id, coalesce(first_name, 'UNKNOWN') AS first_name, coalesce(last_name, 'UNKNOWN') AS last_name,
          lower(coalesce(email, 'UNKNOWN')) AS email,
          coalesce(regexp_replace(phone_number, '[^0-9]', '', 'g'), '') AS phone_number,
          coalesce(preferred_location_id, 'UNKNOWN') AS preferred_location_id, created_at
        FROM t_dirty_snapshot
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY created_at DESC) = 1""",
    "c27_attendance": """SELECT session_id, class_name, coalesce(instructor_name, 'UNKNOWN') AS instructor_name, location_id,
          attendance_count, class_datetime, processed_time, CAST(len(attendees) AS INTEGER) AS attendees,
          TIMESTAMP '2024-03-01' AS processed_timestamp
        FROM t_nested""",
    # Files in and out: what must be found again.
    "s01_by_extension": """SELECT format, n_name, n_regionkey FROM nation,
          (VALUES ('csv'), ('txt'), ('json'), ('jsonl'), ('parquet'), ('orc')) f(format)""",
    "s02_csv": "SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer",
    "s03_json": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "s04_parquet": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "s05_orc": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "s06_glob": "SELECT c_custkey, c_name, c_acctbal FROM customer",
    "s07_manifest": "SELECT count(DISTINCT event_type) AS folders, true AS all_sized FROM events",
    "s08_units": """SELECT DISTINCT 'non-pii' AS category, 'events' AS data_type, strftime(ts, 'events_%Y%m%d') AS folder,
          strftime(ts, '%Y%m%d') AS day_text FROM events""",
    "s09_catalog_table": "SELECT r_name, count(*) AS n FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name",
    "s11_user_file": "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY c_mktsegment",
    "k02_overwrite": "SELECT o_orderstatus, count(*) AS n, sum(o_custkey)::BIGINT AS keys FROM orders GROUP BY o_orderstatus",
    "k03_append_month": """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
          CAST(2 * count(*) AS BIGINT) AS n FROM orders GROUP BY ALL""",
    "k04_append_day": """SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
          count(*) AS n FROM events GROUP BY ALL""",
    "k05_table_as": """SELECT year, month, count(*) AS n, count(DISTINCT user_id) AS users FROM t_cleaned_event
        WHERE event_id IS NOT NULL AND event_type IS NOT NULL GROUP BY ALL""",
    "k06_materialize": "SELECT * FROM r_popular",
    "k07_export_csv": "SELECT * FROM r_trend",
    "k08_write_checked": "SELECT count(*) AS written, count(*) AS found, true AS ok FROM lineitem",
    "k09_verify_paths": """SELECT 'schedule' AS name, count(*) AS n, true AS ok FROM part
        UNION ALL SELECT 'user_snapshot', count(*), true FROM customer
        UNION ALL SELECT 'class_attendance', NULL, false""",
    "k10_views": "SELECT month, count(*) AS n FROM t_event GROUP BY month",
    # Ingest and streams: the state of the results after the runs.
    "i01_convert": """SELECT CASE WHEN c_custkey % 2 = 0 THEN 'csv' ELSE 'json' END AS dir, c_custkey, c_name FROM customer""",
    "i02_ledger_anti": """SELECT DISTINCT strftime(ts, 'non-pii/events/events_%Y%m%d') AS unit FROM events
        WHERE CAST(ts AS DATE) > (SELECT min(CAST(ts AS DATE)) FROM events)""",
    "i04_folder_names": """SELECT DISTINCT CASE event_type WHEN 'click' THEN 'events_' || d WHEN 'view' THEN 'events_' || left(d, 4)
            WHEN 'error' THEN 'other_' || d WHEN 'signup' THEN 'events_' || d || '_x' ELSE 'events' END AS folder,
          CASE WHEN event_type IN ('click', 'error', 'signup') THEN d END AS strict_day,
          CASE WHEN event_type IN ('click', 'error', 'signup') THEN d
               WHEN event_type = 'purchase' THEN '20250501' END AS lenient_day
        FROM (SELECT event_type, strftime(ts, '%Y%m%d') AS d FROM events)""",
    "i03_ingest_batch": """SELECT DISTINCT event_id, lower(trim(event_type)) AS event_type, good_ts AS event_ts,
          2024 AS year, 1 AS month, CAST(1 + CAST(event_id AS BIGINT) % 5 AS INTEGER) AS day
        FROM t_dirty_event""",
    "i05_lenient_ingest": """SELECT DISTINCT user_id, coalesce(lower(trim(email)), 'unknown') AS email,
          coalesce(regexp_replace(phone_number, '[^0-9]', '', 'g'), '') AS phone_number,
          CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN 2024 ELSE 2025 END AS year,
          CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN 1 ELSE 5 END AS month,
          CASE WHEN CAST(user_id AS BIGINT) % 2 = 0 THEN 7 ELSE 1 END AS day
        FROM t_dirty_user""",
    "i06_empty_unit": """SELECT 'non-pii/events/events_2024010' || CAST(1 + event_id % 5 AS VARCHAR) AS unit
        FROM events GROUP BY 1 UNION ALL SELECT 'non-pii/events/events_20240109'""",
    "t2_copies_per_folder": """SELECT DISTINCT event_id, n.day FROM t_dirty_event, (VALUES (8), (9)) AS n(day)""",
    "i07_isolation": """SELECT strftime(DATE '2024-01-01' + CAST(i AS INTEGER), 'non-pii/events/events_%Y%m%d') AS unit,
          CASE WHEN i = 5 THEN 'failed' ELSE 'loaded' END AS outcome
        FROM (SELECT DISTINCT event_id % 5 AS i FROM events UNION ALL SELECT 5)
        UNION ALL SELECT 'non-pii/events/events', 'skipped'""",
    "t1_ingest": """SELECT DISTINCT event_id, lower(trim(event_type)) AS event_type, good_ts AS event_ts,
          2024 AS year, 1 AS month, CAST(1 + CAST(event_id AS BIGINT) % 5 AS INTEGER) AS day
        FROM t_dirty_event""",
    "t3_state": """SELECT user_id, session_id, event_type, event_ts FROM t_event
        QUALIFY row_number() OVER (PARTITION BY user_id, session_id
                                   ORDER BY event_ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1""",
    "t4_daily": "SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, count(*) AS event_count FROM events GROUP BY 1",
    "t4_hourly": "SELECT CAST(hour(ts) AS INTEGER) AS hour_of_day, count(*) AS event_count FROM events GROUP BY 1",
    "t4_weekly": "SELECT CAST(date_trunc('week', ts) AS TIMESTAMP) AS window_start, count(*) AS event_count FROM events GROUP BY 1",
    "t5_quarantine": """SELECT event_id, 'event_ts' AS reason FROM t_dirty_event WHERE event_ts IS NOT NULL AND good_ts IS NULL""",
}
# The same result reached by another route.
BODIES["q25_catalog"] = BODIES["q12_churn_summary"]
BODIES["s10_stored_result"] = BODIES["q21_popular_classes"]
BODIES["k01_overwrite_parquet"] = BODIES["k02_overwrite"]


def _pivot_sql() -> str:
    """P-6 needs one column per location, so its text is built from the fixed list of nation names."""
    from checks.queries import LOCATIONS

    columns = ", ".join(
        f"""CAST(coalesce(sum(total_attendance) FILTER (location_name = '{n}'), 0) AS BIGINT) AS "{n}\"""" for n in LOCATIONS
    )
    return f"SELECT month, {columns} FROM r_trend GROUP BY month"


def oracle_sql() -> dict[str, str]:
    from checks import loading, truth, zoned

    bodies = {**BODIES, "p06_pivot": _pivot_sql(), **loading.SQL, **truth.SQL}
    bodies["q22_hot_users"] = truth.HOT_CHURN.format(plain=bodies["q22_churned_users"])
    bodies |= {name: bodies[plain] for name, plain in zoned.SAME_SQL.items()}
    return {name: with_tables(body) for name, body in bodies.items()}
