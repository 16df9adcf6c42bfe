"""Independent SQL for the registered queries, written for DuckDB.

Named blocks are chained into one WITH clause per query; each block lists nothing but its
SQL, the blocks it reads are found by name.
"""

from __future__ import annotations

import re

REF = "DATE '2024-01-31'"

BLOCKS: dict[str, str] = {}

# ---- raw tables ------------------------------------------------------------------------

BLOCKS["moved_events"] = r"""
SELECT event_id, user_id, event_type, value,
       CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
       CAST(ts AS DATE) - CAST(CASE user_id % 5
           WHEN 0 THEN CASE WHEN event_id % 4 = 3 THEN 30 ELSE 0 END
           WHEN 1 THEN 30 * (event_id % 3)
           WHEN 2 THEN CASE event_id % 4
               WHEN 0 THEN CASE WHEN day(ts) > 15 AND event_id % 3 > 0 THEN 15 ELSE 0 END
               WHEN 3 THEN 60
               ELSE 30 END
           WHEN 3 THEN 30 * (event_id % 12)
           ELSE 45 + 30 * (event_id % 4) END AS INTEGER) AS d
FROM events"""

BLOCKS["raw_user_logs"] = """
SELECT CAST(user_id AS VARCHAR) AS msno,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date,
       CAST(count(*) FILTER (WHERE event_type = 'click') AS INTEGER) AS num_25,
       CAST(count(*) FILTER (WHERE event_type = 'error') AS INTEGER) AS num_50,
       CAST(count(*) FILTER (WHERE event_type = 'signup') AS INTEGER) AS num_75,
       CAST(count(*) FILTER (WHERE event_type = 'view') AS INTEGER) AS num_985,
       CAST(count(*) FILTER (WHERE event_type = 'purchase') AS INTEGER) AS num_100,
       CAST(count(DISTINCT k) AS INTEGER) AS num_unq,
       CAST(sum(CAST(floor(value * 60) AS BIGINT)) AS DOUBLE)
           + CASE WHEN user_id % 3 = 0 AND d >= CAST(['2024-01-08', '2023-12-16', '2023-12-16',
                  '2023-08-01', '2023-10-20'][user_id % 5 + 1] AS DATE) THEN 40000 ELSE 0 END
           AS total_secs
FROM moved_events GROUP BY user_id, d"""

BLOCKS["raw_feature_events"] = """
SELECT CAST(user_id AS VARCHAR) AS msno, CAST(d AS VARCHAR) AS event_date,
       ' ' || upper(event_type) || ' ' AS feature_name,
       CAST(floor(value) AS INTEGER) AS session_duration_sec
FROM moved_events"""

BLOCKS["raw_support_tickets"] = """
SELECT event_id AS ticket_id, CAST(user_id AS VARCHAR) AS msno,
       CAST(d AS VARCHAR) AS ticket_date,
       CASE WHEN k < 3 THEN ' Cancellation_Inquiry' WHEN k < 25 THEN 'BILLING'
            WHEN k < 50 THEN 'technical' WHEN k < 75 THEN 'account '
            ELSE 'feature_request' END AS category,
       CASE k % 3 WHEN 0 THEN 'Negative' WHEN 1 THEN 'neutral' ELSE 'positive' END AS sentiment,
       CASE event_id % 3 WHEN 0 THEN 'resolved' WHEN 1 THEN 'unresolved ' ELSE 'escalated' END
           AS resolution_status,
       CASE WHEN event_id % 3 = 0 THEN floor(value) END AS time_to_fix_hours
FROM moved_events WHERE event_type = 'error'"""

BLOCKS["moved_orders"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, CAST(left(o_orderpriority, 1) AS INTEGER) AS method,
       CAST(o_orderdate AS DATE) + 8217 AS d
FROM orders"""

BLOCKS["order_amounts"] = """
SELECT l_orderkey, sum(CAST(floor(l_extendedprice) AS BIGINT)) AS listed,
       coalesce(sum(CAST(floor(l_extendedprice * (1 - l_discount)) AS BIGINT))
           FILTER (WHERE l_returnflag <> 'R'), 0) AS paid
FROM lineitem GROUP BY l_orderkey"""

BLOCKS["raw_transactions"] = """
SELECT CAST(o_custkey AS VARCHAR) AS msno, o_orderkey AS txn_key, method AS payment_method_id,
       method * 30 AS payment_plan_days,
       CAST(coalesce(listed, 0) AS DOUBLE) AS plan_list_price,
       CAST(coalesce(paid, 0) AS DOUBLE) AS actual_amount_paid,
       CAST(o_orderstatus = 'F' AS INTEGER) AS is_auto_renew,
       CAST(o_orderstatus = 'P' AS INTEGER) AS is_cancel,
       CAST(strftime(d, '%Y%m%d') AS INTEGER) AS transaction_date,
       CAST(strftime(d + method * 30, '%Y%m%d') AS INTEGER) AS membership_expire_date
FROM moved_orders LEFT JOIN order_amounts ON l_orderkey = o_orderkey"""

BLOCKS["raw_members"] = """
SELECT CAST(c_custkey AS VARCHAR) AS msno,
       CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'male' WHEN 'MACHINERY' THEN 'male'
            WHEN 'BUILDING' THEN 'female' WHEN 'HOUSEHOLD' THEN 'female' END AS gender,
       c_nationkey AS city, c_nationkey % 5 AS registered_via,
       (SELECT CAST(strftime(min(d), '%Y%m%d') AS INTEGER) FROM moved_orders
        WHERE o_custkey = c_custkey) AS registration_init_time,
       CAST(floor(c_acctbal / 100) AS INTEGER) AS bd
FROM customer"""

BLOCKS["raw_train"] = f"""
SELECT CAST(o_custkey AS VARCHAR) AS msno,
       CAST(date_diff('day', max(d), {REF}) > 540 AS INTEGER) AS is_churn
FROM moved_orders GROUP BY o_custkey
HAVING arg_max(o_orderstatus, (d, o_orderkey)) <> 'P'"""

BLOCKS["raw_interventions"] = f"""
SELECT CAST(c_custkey AS VARCHAR) AS msno,
       ['no_treatment', ' Discount_Offer', 'feature_highlight_email', 'personal_outreach ',
        're_onboarding_flow'][c_custkey % 5 + 1] AS intervention_type,
       CAST({REF} - CAST(7 + c_custkey % 15 AS INTEGER) AS VARCHAR) AS intervention_date,
       CASE WHEN c_custkey % 5 IN (1, 2, 4) THEN c_custkey % 3 = 0 END AS email_opened,
       CASE WHEN c_custkey % 5 IN (1, 2, 4) THEN c_custkey % 6 = 0 END AS email_clicked
FROM customer"""

BLOCKS["raw_outcomes"] = """
SELECT msno, intervention_type, NOT churner OR saved AS renewed, saved AS was_saved,
       churner AND NOT saved AS observed_churn
FROM (SELECT i.msno, intervention_type, coalesce(is_churn = 1, false) AS churner,
             coalesce(is_churn = 1, false)
                 AND CAST(i.msno AS BIGINT) % 7 < CAST(i.msno AS BIGINT) % 5 AS saved
      FROM raw_interventions i LEFT JOIN raw_train t ON t.msno = i.msno)"""

# ---- staging ---------------------------------------------------------------------------


def int_day(column: str) -> str:
    return f"CAST(try_strptime(CAST({column} AS VARCHAR), '%Y%m%d') AS DATE)"


BLOCKS["stg_members"] = f"""
SELECT msno, gender_male_flag, city, registered_via, registration_date, age,
       CASE WHEN age IS NULL THEN 'unknown' WHEN age >= 50 THEN '50+'
            WHEN age < 20 THEN '10-19'
            ELSE CAST(age // 10 * 10 AS VARCHAR) || '-' || CAST(age // 10 * 10 + 9 AS VARCHAR)
       END AS age_bucket,
       CAST({REF} - registration_date AS INTEGER) AS tenure_days
FROM (SELECT msno, CASE gender WHEN 'male' THEN 1 WHEN 'female' THEN 0 END AS gender_male_flag,
             city, registered_via, {int_day('registration_init_time')} AS registration_date,
             CASE WHEN bd >= 10 AND bd <= 75 THEN bd END AS age
      FROM raw_members WHERE msno IS NOT NULL)"""

BLOCKS["stg_user_logs"] = f"""
SELECT msno, log_date, num_25, num_50, num_75, num_985, num_100, num_unq, total_secs,
       plays AS total_tracks, round(total_secs / 3600, 4) AS listening_hours,
       round(CAST(num_100 AS DOUBLE) / nullif(plays, 0), 4) AS completion_rate,
       round(CAST(num_25 AS DOUBLE) / nullif(plays, 0), 4) AS skip_rate
FROM (SELECT msno, {int_day('date')} AS log_date, num_25, num_50, num_75, num_985, num_100,
             num_unq, total_secs,
             CAST(num_25 + num_50 + num_75 + num_985 + num_100 AS INTEGER) AS plays
      FROM raw_user_logs)
WHERE log_date IS NOT NULL"""

BLOCKS["stg_transactions"] = f"""
SELECT *, CAST(coalesce(plan_list_price < prev_plan_list_price, false) AS INTEGER)
           AS plan_downgrade_flag
FROM (SELECT *,
             CAST(membership_expire_date - transaction_date AS INTEGER) AS days_until_expiry,
             CAST(actual_amount_paid = 0 AND plan_list_price > 0 AS INTEGER)
                 AS payment_failure_flag,
             coalesce(round(1 - actual_amount_paid / nullif(plan_list_price, 0), 4), 0)
                 AS discount_rate,
             lag(plan_list_price) OVER (PARTITION BY msno
                 ORDER BY transaction_date NULLS LAST, txn_key) AS prev_plan_list_price
      FROM (SELECT msno, txn_key, payment_method_id, payment_plan_days, plan_list_price,
                   actual_amount_paid, is_auto_renew, is_cancel,
                   {int_day('transaction_date')} AS transaction_date,
                   {int_day('membership_expire_date')} AS membership_expire_date
            FROM raw_transactions))"""

BLOCKS["stg_feature_events"] = """
SELECT msno, TRY_CAST(event_date AS DATE) AS event_date,
       lower(trim(feature_name)) AS feature_name,
       coalesce(session_duration_sec, 0) AS session_duration_sec
FROM raw_feature_events WHERE event_date IS NOT NULL"""

BLOCKS["stg_support_tickets"] = """
SELECT *, CAST(sentiment = 'negative' AS INTEGER) AS is_negative,
       CAST(resolution_status = 'unresolved' AS INTEGER) AS is_unresolved,
       CAST(category = 'cancellation_inquiry' AS INTEGER) AS is_cancellation
FROM (SELECT ticket_id, msno, TRY_CAST(ticket_date AS DATE) AS ticket_date,
             lower(trim(category)) AS category, lower(trim(sentiment)) AS sentiment,
             lower(trim(resolution_status)) AS resolution_status, time_to_fix_hours
      FROM raw_support_tickets)"""

BLOCKS["stg_interventions"] = """
SELECT msno, lower(trim(intervention_type)) AS intervention_type,
       TRY_CAST(intervention_date AS DATE) AS intervention_date,
       coalesce(email_opened, false) AS email_opened,
       coalesce(email_clicked, false) AS email_clicked
FROM raw_interventions"""

BLOCKS["stg_outcomes"] = """
SELECT msno, lower(trim(intervention_type)) AS intervention_type,
       coalesce(renewed, false) AS renewed, coalesce(was_saved, false) AS was_saved,
       coalesce(observed_churn, false) AS observed_churn
FROM raw_outcomes"""

# ---- sessions and cadence --------------------------------------------------------------


def units(column: str) -> str:
    return f"CAST(round({column} * 10000) AS BIGINT)"


BLOCKS["daily_units"] = f"""
SELECT msno, log_date, sum({units('listening_hours')}) AS hu, sum(total_tracks) AS tr
FROM stg_user_logs GROUP BY msno, log_date"""

BLOCKS["daily_activity"] = """
SELECT msno, log_date, CAST(hu AS DOUBLE) / 10000 AS daily_hours,
       CAST(tr AS BIGINT) AS daily_tracks
FROM daily_units"""

BLOCKS["numbered_days"] = """
SELECT *, log_date - CAST(row_number() OVER (PARTITION BY msno ORDER BY log_date) AS INTEGER)
           AS island
FROM daily_units"""

BLOCKS["sessions"] = """
SELECT msno, CAST(row_number() OVER (PARTITION BY msno ORDER BY session_start) AS BIGINT)
           AS session_id,
       session_start, session_end, session_length_days, session_total_hours,
       session_avg_daily_tracks, session_total_tracks
FROM (SELECT msno, min(log_date) AS session_start, max(log_date) AS session_end,
             count(*) AS session_length_days,
             CAST(sum(hu) AS DOUBLE) / 10000 AS session_total_hours,
             CAST(sum(tr) AS DOUBLE) / count(*) AS session_avg_daily_tracks,
             CAST(sum(tr) AS BIGINT) AS session_total_tracks
      FROM numbered_days GROUP BY msno, island)"""

BLOCKS["session_gaps"] = """
SELECT s.*, CAST(s.session_start - p.session_end AS INTEGER) AS gap_before_session
FROM sessions s LEFT JOIN sessions p ON p.msno = s.msno AND p.session_id = s.session_id - 1"""

BLOCKS["login_frequency"] = f"""
SELECT g.msno, coalesce(any_value(w.d30), 0) AS login_days_last_30d,
       coalesce(any_value(w.d60), 0) AS login_days_last_60d,
       round(coalesce(avg(gap_before_session), 0), 2) AS login_gap_days_avg,
       coalesce(max(gap_before_session), 0) AS login_gap_days_max,
       coalesce(max(CASE WHEN latest THEN gap_before_session END), 0) AS login_gap_days_recent,
       max(session_length_days) AS login_streak_max,
       max(CASE WHEN latest AND {REF} - session_end <= 3 THEN session_length_days ELSE 0 END)
           AS login_streak_current,
       CAST({REF} - max(session_end) AS INTEGER) AS days_since_last_login
FROM (SELECT *, session_id = max(session_id) OVER (PARTITION BY msno) AS latest
      FROM session_gaps) g
LEFT JOIN (SELECT msno, count(DISTINCT log_date) FILTER (WHERE {REF} - log_date <= 30) AS d30,
                  count(DISTINCT log_date) FILTER (WHERE {REF} - log_date <= 60) AS d60
           FROM stg_user_logs GROUP BY msno) w ON w.msno = g.msno
GROUP BY g.msno"""


def _usage_sql() -> str:
    """Usage windows straight from the log rows, one window at a time."""
    cols = ["msno"]
    for n, _ in ((30, 15), (60, 30), (90, 45)):
        inside = f"FILTER (WHERE age <= {n})"
        cols += [
            f"count(DISTINCT log_date) {inside} AS sessions_last_{n}d",
            f"CAST(coalesce(sum(hu) {inside}, 0) AS DOUBLE) / 10000 AS hours_last_{n}d",
            f"CAST(coalesce(sum(total_tracks) {inside}, 0) AS BIGINT) AS tracks_last_{n}d",
            f"CAST(sum(hu) {inside} AS DOUBLE) / 10000 / count(hu) {inside} "
            f"AS avg_daily_hours_last_{n}d",
        ]
    for out, u in (("completion_rate", "cu"), ("skip_rate", "su")):
        inside = "FILTER (WHERE age <= 30)"
        cols.append(
            f"CAST(sum({u}) {inside} AS DOUBLE) / 10000 / nullif(count({u}) {inside}, 0) "
            f"AS {out}_avg_30d"
        )
    for n, half in ((30, 15), (60, 30), (90, 45)):
        for name, lo, hi in (("old", half + 1, n), ("new", 1, half)):
            inside = f"FILTER (WHERE age >= {lo} AND age <= {hi})"
            cols.append(
                f"CAST(sum(hu) {inside} AS DOUBLE) / 10000 / nullif(count(hu) {inside}, 0) "
                f"AS {name}{n}"
            )
    decays = ", ".join(
        f"round((old{n} - new{n}) / nullif(old{n}, 0), 4) + 0.0 AS usage_decay_{n}d"
        for n in (30, 60, 90)
    )
    hidden = ", ".join(f"{h}{n}" for n in (30, 60, 90) for h in ("old", "new"))
    return f"""
SELECT * EXCLUDE ({hidden}), {decays}
FROM (SELECT {', '.join(cols)}
      FROM (SELECT msno, log_date, total_tracks, {REF} - log_date AS age,
                   {units('listening_hours')} AS hu, {units('completion_rate')} AS cu,
                   {units('skip_rate')} AS su
            FROM stg_user_logs WHERE log_date >= {REF} - 90)
      GROUP BY msno)"""


BLOCKS["usage_decay"] = _usage_sql()

# ---- other feature families ------------------------------------------------------------

BLOCKS["support_signals"] = f"""
SELECT msno, c30 AS ticket_count_30d, c90 AS ticket_count_90d, n AS ticket_count_all,
       round(c30 * 3.0::DOUBLE / nullif(c90, 0), 4) AS ticket_velocity,
       round(neg::DOUBLE / n, 4) AS pct_negative_sentiment, neg AS negative_ticket_count,
       open AS unresolved_ticket_count, round(fix, 2) AS avg_time_to_fix_hours,
       CAST(cancel > 0 AS INTEGER) AS has_cancellation_inquiry,
       CAST(cancel30 > 0 AS INTEGER) AS cancellation_inquiry_30d,
       bill AS billing_ticket_count, bill30 AS billing_ticket_30d
FROM (SELECT msno, count(*) AS n, count(*) FILTER (WHERE age <= 30) AS c30,
             count(*) FILTER (WHERE age <= 90) AS c90,
             count(*) FILTER (WHERE sentiment = 'negative') AS neg,
             count(*) FILTER (WHERE resolution_status = 'unresolved') AS open,
             avg(time_to_fix_hours) AS fix,
             count(*) FILTER (WHERE category = 'cancellation_inquiry') AS cancel,
             count(*) FILTER (WHERE category = 'cancellation_inquiry' AND age <= 30) AS cancel30,
             count(*) FILTER (WHERE category = 'billing') AS bill,
             count(*) FILTER (WHERE category = 'billing' AND age <= 30) AS bill30
      FROM (SELECT *, {REF} - ticket_date AS age FROM stg_support_tickets)
      GROUP BY msno)"""

BLOCKS["latest_transaction"] = """
SELECT msno, transaction_date AS last_txn_date, membership_expire_date,
       is_auto_renew AS auto_renew_flag, is_cancel AS is_cancel_flag,
       plan_list_price AS current_plan_price
FROM stg_transactions
QUALIFY row_number() OVER (PARTITION BY msno
                           ORDER BY transaction_date DESC NULLS LAST, txn_key DESC) = 1"""

BLOCKS["transaction_signals"] = f"""
SELECT t.msno, any_value(l.auto_renew_flag) AS auto_renew_flag,
       any_value(l.is_cancel_flag) AS is_cancel_flag,
       CAST({REF} - any_value(l.last_txn_date) AS INTEGER) AS days_since_last_txn,
       CAST(any_value(l.membership_expire_date) - {REF} AS INTEGER) AS membership_expire_days,
       max(plan_downgrade_flag) AS plan_downgrade_flag,
       count(*) FILTER (WHERE payment_failure_flag = 1 AND {REF} - transaction_date <= 90)
           AS payment_failure_count_90d,
       round(CAST(sum({units('discount_rate')}) AS DOUBLE) / 10000 / count(*), 4)
           AS avg_discount_rate,
       CAST(count(*) FILTER (WHERE discount_rate > 0 AND {REF} - transaction_date <= 90) > 0
            AS INTEGER) AS received_discount_90d,
       count(DISTINCT payment_method_id) AS payment_method_changes,
       coalesce(sum(actual_amount_paid) FILTER (WHERE {REF} - transaction_date <= 90), 0)
           AS total_paid_90d,
       count(DISTINCT t.plan_list_price) AS distinct_plan_count,
       count(*) FILTER (WHERE is_cancel = 1) AS cancellation_count
FROM stg_transactions t LEFT JOIN latest_transaction l ON l.msno = t.msno
GROUP BY t.msno"""

BLOCKS["feature_adoption"] = f"""
SELECT msno, n30 AS unique_features_used_30d, n AS unique_features_used_all,
       round(n30 / 10, 4) AS feature_diversity_score,
       CAST(newest AS INTEGER) AS days_since_last_feature_use,
       CAST(s30 AS DOUBLE) / nullif(c30, 0) AS avg_session_duration_30d,
       CAST(coalesce(s30, 0) AS BIGINT) AS total_session_sec_30d
FROM (SELECT msno, count(DISTINCT feature_name) FILTER (WHERE age <= 30) AS n30,
             count(DISTINCT feature_name) AS n, min(age) FILTER (WHERE age >= 0) AS newest,
             sum(session_duration_sec) FILTER (WHERE age <= 30) AS s30,
             count(*) FILTER (WHERE age <= 30) AS c30
      FROM (SELECT *, {REF} - event_date AS age FROM stg_feature_events)
      GROUP BY msno)"""

BLOCKS["intervention_engagement"] = """
SELECT msno, intervention_type AS last_intervention_type, email_opened, email_clicked
FROM stg_interventions
QUALIFY row_number() OVER (PARTITION BY msno ORDER BY intervention_date DESC NULLS LAST,
        intervention_type DESC, email_opened DESC, email_clicked DESC) = 1"""

BLOCKS["activity_stats"] = f"""
SELECT msno, avg(total_secs) AS total_seconds_mean,
       floor(coalesce(stddev_samp(total_secs), 50) * 1000 + 0.5) / 1000 AS total_seconds_std,
       avg(num_25) AS num_25_mean, count({int_day('date')}) AS active_days,
       min({int_day('date')}) AS first_log, max({int_day('date')}) AS last_log,
       CAST(greatest(max({int_day('date')}) - min({int_day('date')}), 1) AS INTEGER)
           AS tenure_days
FROM raw_user_logs GROUP BY msno"""

BLOCKS["last_transaction_date"] = f"""
SELECT msno, max({int_day('transaction_date')}) AS last_transaction_date
FROM raw_transactions GROUP BY msno"""

# ---- change-point table with a fixed rule, so that everything after it is comparable ----

BLOCKS["breakpoints"] = """
SELECT msno, CASE WHEN n >= 16 THEN n // 2 END AS cp_idx
FROM (SELECT msno, count(*) AS n FROM daily_units GROUP BY msno)"""

def _shift_stats(breakpoints: str) -> str:
    return """
SELECT b.msno, b.cp_idx IS NOT NULL AS change_point_detected, s.change_point_date,
       CAST(s.last_day - s.change_point_date AS INTEGER) AS days_since_change_point,
       s.slope AS usage_slope_post_change, s.pre AS pre_change_daily_mean,
       s.post AS post_change_daily_mean, (s.post - s.pre) / (s.pre + 1e-9) AS pct_usage_change
FROM breakpoints b
LEFT JOIN (SELECT msno, max(log_date) AS last_day,
                  max(log_date) FILTER (WHERE i = cp_idx) AS change_point_date,
                  sum(secs) FILTER (WHERE i < cp_idx) / count(*) FILTER (WHERE i < cp_idx) AS pre,
                  sum(secs) FILTER (WHERE i >= cp_idx) / count(*) FILTER (WHERE i >= cp_idx)
                      AS post,
                  CASE WHEN count(*) FILTER (WHERE i >= cp_idx) < 3 THEN 0 ELSE
                      (sum((i - cp_idx) * secs) FILTER (WHERE i >= cp_idx)
                       - (count(*) FILTER (WHERE i >= cp_idx) - 1) / 2.0::DOUBLE
                         * sum(secs) FILTER (WHERE i >= cp_idx))
                      / (count(*) FILTER (WHERE i >= cp_idx)::DOUBLE
                         * (count(*) FILTER (WHERE i >= cp_idx)
                            * count(*) FILTER (WHERE i >= cp_idx) - 1) / 12) END AS slope
           FROM (SELECT d.msno, log_date, secs, cp_idx,
                        row_number() OVER (PARTITION BY d.msno ORDER BY log_date) - 1 AS i
                 FROM (SELECT msno, log_date, sum(total_secs) AS secs FROM stg_user_logs
                       GROUP BY msno, log_date) d
                 JOIN breakpoints USING (msno))
           WHERE cp_idx IS NOT NULL GROUP BY msno) s ON s.msno = b.msno""".replace(
        "breakpoints", breakpoints
    )


BLOCKS["change_point_stats"] = _shift_stats("breakpoints")

# ---- change points by exact segmentation -------------------------------------------------

BLOCKS["day_series"] = """
SELECT msno, secs, row_number() OVER (PARTITION BY msno ORDER BY log_date) - 1 AS i,
       count(*) OVER (PARTITION BY msno) AS n
FROM (SELECT msno, log_date, sum(total_secs) AS secs FROM stg_user_logs GROUP BY msno, log_date)"""

BLOCKS["kernel_width"] = """
SELECT a.msno, median((a.secs - b.secs) * (a.secs - b.secs)) AS spread
FROM day_series a JOIN day_series b ON a.msno = b.msno AND a.i < b.i GROUP BY a.msno"""

BLOCKS["kernel_pairs"] = """
SELECT a.msno, a.i, b.i AS j,
       exp(-least(greatest((a.secs - b.secs) * (a.secs - b.secs)
                           / CASE WHEN spread > 0 THEN spread ELSE 1 END, 0.01), 100)) AS k
FROM day_series a JOIN day_series b ON a.msno = b.msno AND a.i < b.i
JOIN kernel_width w ON w.msno = a.msno"""

BLOCKS["segment_ends"] = """
SELECT msno, n, e, row_number() OVER (PARTITION BY msno ORDER BY e) AS step
FROM (SELECT msno, max(n) AS n, unnest(list_append(range(5, max(n), 5), max(n))) AS e
      FROM day_series GROUP BY msno)"""

BLOCKS["segment_costs"] = """
SELECT b.msno, b.step, b.e, a.s, b.e - a.s
           - (b.e - a.s + 2 * coalesce(sum(p.k), 0)) / (b.e - a.s) AS cost
FROM segment_ends b
JOIN (SELECT msno, e AS s FROM segment_ends WHERE e < n
      UNION ALL SELECT DISTINCT msno, 0 FROM segment_ends) a ON a.msno = b.msno AND a.s <= b.e - 2
LEFT JOIN kernel_pairs p ON p.msno = b.msno AND p.i >= a.s AND p.j < b.e
GROUP BY b.msno, b.step, b.e, a.s"""

BLOCKS["best_segmentations"] = """
SELECT msno, 0 AS step, [0.0::DOUBLE] AS best, [0::BIGINT] AS ends, 0::BIGINT AS start
FROM segment_ends GROUP BY msno
UNION ALL
SELECT d.msno, d.step + 1,
       list_append(any_value(d.best), 10 + min(d.best[list_position(d.ends, c.s)] + c.cost)),
       list_append(any_value(d.ends), any_value(c.e)),
       arg_min(c.s, d.best[list_position(d.ends, c.s)] + c.cost)
FROM best_segmentations d JOIN segment_costs c ON c.msno = d.msno AND c.step = d.step + 1
GROUP BY d.msno, d.step"""

BLOCKS["located"] = """
SELECT msno, CASE WHEN n >= 14 AND start > 7 AND start < n - 7 THEN start END AS cp_idx
FROM (SELECT msno, arg_max(start, step) AS start, max(ends[-1]) AS n
      FROM best_segmentations GROUP BY msno)"""

BLOCKS["change_points"] = _shift_stats("located")

BLOCKS["change_point_share"] = """
SELECT count(*) FILTER (WHERE change_point_detected) AS detected_users, count(*) AS users,
       count(*) FILTER (WHERE change_point_detected)::DOUBLE / count(*) AS detected_share
FROM change_points"""

# ---- wide table and marts --------------------------------------------------------------


def _master_sql(labels_join: str) -> str:
    zero = {
        "u": "sessions_last_30d sessions_last_60d sessions_last_90d hours_last_30d "
        "completion_rate_avg_30d skip_rate_avg_30d",
        "l": "login_days_last_30d login_days_last_60d login_gap_days_avg login_gap_days_max "
        "login_gap_days_recent login_streak_max login_streak_current",
        "s": "ticket_count_30d ticket_count_90d ticket_velocity pct_negative_sentiment "
        "unresolved_ticket_count has_cancellation_inquiry cancellation_inquiry_30d "
        "billing_ticket_count",
        "x": "auto_renew_flag is_cancel_flag plan_downgrade_flag payment_failure_count_90d "
        "membership_expire_days avg_discount_rate total_paid_90d cancellation_count",
        "f": "unique_features_used_30d feature_diversity_score",
        "c": "usage_slope_post_change pct_usage_change",
    }
    cols = [f"coalesce({a}.{n}, 0) AS {n}" for a, names in zero.items() for n in names.split()]
    return f"""
SELECT m.msno, t.is_churn, m.gender_male_flag, m.city AS city_encoded, m.registered_via, m.age,
       m.age_bucket AS age_bucket_encoded, m.tenure_days,
       coalesce(u.avg_daily_hours_last_30d, 0) AS avg_session_duration_30d,
       u.usage_decay_30d, u.usage_decay_60d, u.usage_decay_90d,
       coalesce(l.days_since_last_login, 999) AS days_since_last_login,
       coalesce(x.days_since_last_txn, 999) AS days_since_last_txn,
       coalesce(x.payment_method_changes, 1) AS payment_method_changes,
       coalesce(f.days_since_last_feature_use, 999) AS days_since_last_feature_use,
       coalesce(c.change_point_detected, false) AS change_point_detected, c.change_point_date,
       coalesce(c.days_since_change_point, 999) AS days_since_change_point,
       e.last_intervention_type, coalesce(e.email_opened, false) AS email_opened,
       coalesce(e.email_clicked, false) AS email_clicked,
       {', '.join(cols)}
FROM stg_members m {labels_join} raw_train t ON t.msno = m.msno
LEFT JOIN usage_decay u ON u.msno = m.msno
LEFT JOIN login_frequency l ON l.msno = m.msno
LEFT JOIN support_signals s ON s.msno = m.msno
LEFT JOIN transaction_signals x ON x.msno = m.msno
LEFT JOIN feature_adoption f ON f.msno = m.msno
LEFT JOIN change_point_stats c ON c.msno = m.msno
LEFT JOIN intervention_engagement e ON e.msno = m.msno"""


BLOCKS["feature_master"] = _master_sql("JOIN")
BLOCKS["wide_members"] = _master_sql("LEFT JOIN")

BLOCKS["clipped"] = """
SELECT *, least(greatest(coalesce(usage_decay_30d, 0), -2), 2) AS k30,
       least(greatest(coalesce(usage_decay_60d, 0), -2), 2) AS k60,
       least(greatest(coalesce(usage_decay_90d, 0), -2), 2) AS k90
FROM wide_members"""

BLOCKS["churn_mart"] = """
SELECT msno, is_churn, k30 AS usage_decay_30d, k60 AS usage_decay_60d, k90 AS usage_decay_90d,
       sessions_last_30d, sessions_last_60d, sessions_last_90d, avg_session_duration_30d,
       completion_rate_avg_30d, skip_rate_avg_30d, login_days_last_30d, login_gap_days_avg,
       least(login_gap_days_max, 180) AS login_gap_days_max, login_streak_max,
       login_streak_current, least(days_since_last_login, 180) AS days_since_last_login,
       ticket_count_30d, ticket_count_90d, ticket_velocity, pct_negative_sentiment,
       unresolved_ticket_count, has_cancellation_inquiry, cancellation_inquiry_30d,
       auto_renew_flag, plan_downgrade_flag, payment_failure_count_90d,
       least(days_since_last_txn, 180) AS days_since_last_txn, membership_expire_days,
       avg_discount_rate, cancellation_count, unique_features_used_30d,
       feature_diversity_score, days_since_last_feature_use, change_point_detected,
       days_since_change_point, usage_slope_post_change, pct_usage_change, gender_male_flag,
       city_encoded,
       CAST(coalesce(list_position(['10-19', '20-29', '30-39', '40-49', '50+'],
                                   age_bucket_encoded), 0) AS INTEGER) AS age_bucket_encoded,
       tenure_days,
       CASE WHEN sessions_last_30d >= 20 AND k30 > -0.2 THEN 'power_user'
            WHEN sessions_last_30d >= 10 THEN 'regular'
            WHEN sessions_last_30d > 0 THEN 'casual'
            WHEN days_since_last_login <= 30 THEN 'recently_inactive'
            ELSE 'dormant' END AS behavioral_cohort,
       CASE WHEN k30 > 0.3 AND ticket_count_30d > 1 THEN 'critical'
            WHEN k30 > 0.2 OR has_cancellation_inquiry = 1 THEN 'high'
            WHEN sessions_last_30d < 5 AND days_since_last_login > 14 THEN 'medium'
            ELSE 'low' END AS risk_tier,
       CASE WHEN is_churn IS NULL THEN 'score' ELSE 'train' END AS split
FROM clipped"""

BLOCKS["intervention_mart"] = """
SELECT o.msno, o.intervention_type,
       CASE o.intervention_type WHEN 'discount_offer' THEN 1
            WHEN 'feature_highlight_email' THEN 2 WHEN 'personal_outreach' THEN 3
            WHEN 're_onboarding_flow' THEN 4 ELSE 0 END AS intervention_type_encoded,
       i.email_opened, i.email_clicked, o.observed_churn, o.was_saved, o.renewed,
       m.* EXCLUDE (msno, is_churn, completion_rate_avg_30d, skip_rate_avg_30d,
                    login_gap_days_max, login_streak_current, cancellation_inquiry_30d,
                    membership_expire_days, cancellation_count, pct_usage_change, split)
FROM stg_outcomes o
JOIN (SELECT msno, intervention_type,
             arg_max(email_opened, intervention_date) AS email_opened,
             arg_max(email_clicked, intervention_date) AS email_clicked
      FROM stg_interventions GROUP BY ALL) i
  ON i.msno = o.msno AND i.intervention_type = o.intervention_type
JOIN churn_mart m ON m.msno = o.msno AND m.is_churn IS NOT NULL"""

# ---- scoring ---------------------------------------------------------------------------

WEIGHTS = {
    "usage_decay_30d": "1.2",
    "sessions_last_30d": "-0.08",
    "ticket_count_30d": "0.35",
    "login_days_last_30d": "-0.05",
    "pct_negative_sentiment": "0.7",
    "has_cancellation_inquiry": "0.9",
    "payment_failure_count_90d": "0.6",
    "days_since_last_txn": "0.01",
    "tenure_days": "-0.0001",
}

BLOCKS["matrix"] = (
    "SELECT msno, is_churn, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0) AS {c}" for c in WEIGHTS)
    + " FROM churn_mart"
)

BLOCKS["linear_attributions"] = f"""
SELECT msno, churn_prob, CAST(churn_prob >= 0.65 AS INTEGER) AS churn_flag,
       CASE WHEN churn_prob >= 0.65 THEN (CAST(msno AS BIGINT) % 17 - 4) / 100 END
           AS uplift_score,
       {', '.join(f'''CASE WHEN churn_prob >= 0.65
            THEN round(({c} - mean_{c}) * {w}::DOUBLE, 6) + 0.0 END AS shap_{c}'''
            for c, w in WEIGHTS.items())}
FROM (SELECT *, round(1 / (1 + exp(-(-0.3::DOUBLE + {' + '.join(f'{c} * {w}::DOUBLE' for c, w in WEIGHTS.items())}))), 6) AS churn_prob
      FROM matrix)
CROSS JOIN (SELECT {', '.join(f'avg({c}) AS mean_{c}' for c in WEIGHTS)} FROM matrix)"""

BLOCKS["scored_linear"] = "SELECT msno, churn_prob, churn_flag FROM linear_attributions"

BLOCKS["long_factors"] = (
    "SELECT msno, feature, value, row_number() OVER (PARTITION BY msno "
    "ORDER BY abs(value) DESC, place) AS position FROM ("
    + " UNION ALL ".join(
        f"SELECT msno, '{c}' AS feature, {i} AS place, shap_{c} AS value FROM linear_attributions"
        for i, c in enumerate(WEIGHTS)
    )
    + ") WHERE value IS NOT NULL"
)

BLOCKS["top_factors"] = """
SELECT msno, CAST(position AS INTEGER) AS position, feature,
       round(value, 4) + 0.0 AS shap_value,
       CASE WHEN value > 0 THEN 'risk_increase' ELSE 'risk_decrease' END AS direction
FROM long_factors WHERE position <= 5"""

BLOCKS["labelled_factors"] = """
SELECT msno, CAST(position AS INTEGER) AS position, feature,
       CASE feature WHEN 'usage_decay_30d' THEN '30-day usage decay'
            WHEN 'ticket_count_30d' THEN 'support tickets (last 30 days)'
            WHEN 'login_days_last_30d' THEN 'login days (last 30 days)'
            WHEN 'pct_negative_sentiment' THEN '% negative support sentiment'
            WHEN 'has_cancellation_inquiry' THEN 'cancellation inquiry ticket'
            WHEN 'payment_failure_count_90d' THEN 'payment failures (90 days)'
            ELSE replace(feature, '_', ' ') END AS label,
       CASE WHEN value > 0 THEN 'increases' ELSE 'decreases' END || ' churn risk' AS impact,
       abs(value) AS magnitude
FROM long_factors WHERE position <= 5"""

BLOCKS["narration_candidates"] = """
SELECT msno, churn_prob FROM scored_linear WHERE churn_flag = 1
ORDER BY churn_prob DESC, msno LIMIT 200"""


def whole_percent(share: str) -> str:
    return f"CAST(CAST(round_even({share} * 100, 0) AS INTEGER) AS VARCHAR) || '%'"


BLOCKS["prompts"] = f"""
SELECT n.msno, 'The churn model flagged this subscriber as high risk.' || chr(10)
    || 'Churn probability: ' || {whole_percent('n.churn_prob')} || chr(10)
    || 'Strongest factors behind the score:' || chr(10) || f.lines || chr(10)
    || coalesce(CASE WHEN c.change_point_detected THEN
           '- Daily use moved to another level ' || c.days_since_change_point
           || ' days back, on ' || CAST(c.change_point_date AS VARCHAR)
           || ': ' || {whole_percent('c.pct_usage_change')}
           || ' against the level before.' || chr(10) END, '')
    || 'What else is known:' || chr(10)
    || '- Tenure: ' || coalesce(CAST(m.tenure_days AS VARCHAR), 'unknown') || ' days' || chr(10)
    || '- Plan downgrade: ' || m.plan_downgrade_flag || chr(10)
    || '- Tickets still open: ' || m.unresolved_ticket_count || chr(10)
    || '- Last campaign mail: opened=' || CASE WHEN e.email_opened THEN 'True' ELSE 'False' END
    || ', clicked=' || CASE WHEN e.email_clicked THEN 'True' ELSE 'False' END || chr(10)
    || 'Explain in two or three plain sentences why this user may leave,' || chr(10)
    || 'choose one action of [discount_offer, feature_highlight_email, personal_outreach, '
    || 're_onboarding_flow, no_action]' || chr(10)
    || 'and justify it in one sentence. Answer with bare JSON holding the fields' || chr(10)
    || 'explanation, recommended_action and action_justification.' AS prompt
FROM (SELECT msno, churn_prob FROM scored_linear WHERE churn_flag = 1) n
JOIN (SELECT msno, string_agg('- ' || label || ': ' || impact || ' (magnitude: '
             || printf('%.3f', round_even(magnitude * 1000, 0) / 1000) || ')', chr(10)
             ORDER BY position) AS lines
      FROM labelled_factors GROUP BY msno) f ON f.msno = n.msno
JOIN churn_mart m ON m.msno = n.msno
LEFT JOIN change_point_stats c ON c.msno = n.msno
LEFT JOIN intervention_engagement e ON e.msno = n.msno"""

BLOCKS["template_narrative"] = f"""
SELECT s.msno,
       CASE WHEN churn_flag = 1 THEN 'What weighs most is ' || replace(f.feature, '_', ' ')
                || '; the model puts the chance of leaving at ' || {whole_percent('churn_prob')} || '.'
                || CASE WHEN c.change_point_detected THEN
                       ' Use shifted on '
                       || CAST(c.change_point_date AS VARCHAR) || '.' ELSE '' END
            ELSE 'This user is not currently flagged as high-risk.' END AS explanation,
       CASE WHEN churn_flag = 1 THEN 'personal_outreach' ELSE 'no_action' END
           AS recommended_action,
       CASE WHEN churn_flag = 1
            THEN 'Template narrative: a personal contact is the default offer.'
            ELSE 'Churn probability is below the risk threshold.' END AS action_justification
FROM scored_linear s
LEFT JOIN long_factors f ON f.msno = s.msno AND f.position = 1
LEFT JOIN change_point_stats c ON c.msno = s.msno"""

BLOCKS["parsed_replies"] = """
SELECT msno,
       CASE WHEN readable THEN 'User ' || msno || ' may leave.'
            ELSE 'Unable to generate explanation.' END AS explanation,
       CASE WHEN readable THEN ['discount_offer', 'feature_highlight_email', 'personal_outreach',
                 're_onboarding_flow', 'call_a_friend'][CAST(msno AS BIGINT) % 5 + 1]
            ELSE 'no_action' END AS recommended_action,
       CASE WHEN readable THEN 'Segment ' || registered_via || '.' ELSE 'LLM unavailable.' END
           AS action_justification
FROM (SELECT *, CAST(msno AS BIGINT) % 4 <> 3 AS readable FROM raw_members)"""

BLOCKS["action_plan"] = """
SELECT s.msno, s.churn_prob, s.uplift_score,
       CASE WHEN s.uplift_score >= 0.05 AND r.recommended_action IN
                 ('discount_offer', 'feature_highlight_email', 'personal_outreach',
                  're_onboarding_flow')
            THEN r.recommended_action ELSE 'no_action' END AS final_action,
       r.explanation, r.action_justification
FROM linear_attributions s LEFT JOIN parsed_replies r ON r.msno = s.msno
WHERE s.churn_flag = 1"""

BLOCKS["plan_kpis"] = """
SELECT count(*) AS high_risk_users,
       count(*) FILTER (WHERE final_action <> 'no_action') AS actionable_users,
       round(count(*) FILTER (WHERE final_action <> 'no_action') * 100::DOUBLE / count(*), 1)
           AS intervention_rate
FROM action_plan"""

BLOCKS["top_plan"] = "SELECT * FROM action_plan ORDER BY churn_prob DESC, msno LIMIT 200"


def segment_sql(segment: str) -> str:
    return f"""
SELECT {segment}, count(DISTINCT p.msno) AS high_risk_users,
       round(avg(churn_prob), 8) AS avg_churn_prob,
       round(avg(CASE WHEN final_action = 'no_action' THEN 0.0 ELSE 1.0 END::DOUBLE) * 100, 1)
           AS intervention_rate
FROM action_plan p JOIN churn_mart m ON m.msno = p.msno GROUP BY {segment}"""


BLOCKS["risk_lookup"] = """
SELECT s.msno, s.churn_prob AS churn_probability, s.churn_flag = 1 AS churn_flag,
       coalesce((SELECT string_agg(feature || ':' || direction, ',' ORDER BY position)
                 FROM top_factors t WHERE t.msno = s.msno), '') AS top_risk_factors,
       s.uplift_score, n.explanation, n.recommended_action, n.action_justification,
       coalesce(c.change_point_detected, false) AS change_point_detected,
       CAST(c.change_point_date AS VARCHAR) AS change_point_date
FROM linear_attributions s
JOIN template_narrative n ON n.msno = s.msno
LEFT JOIN change_point_stats c ON c.msno = s.msno
WHERE s.msno IN (SELECT msno FROM raw_user_logs)"""

# ---- measurement and profiles ----------------------------------------------------------

BLOCKS["save_rate"] = """
SELECT treated AS treated_save_rate, control AS control_save_rate,
       treated - control AS save_rate_lift
FROM (SELECT avg(CAST(was_saved AS INTEGER)) FILTER (WHERE intervention_type <> 'no_treatment')
                 AS treated,
             avg(CAST(was_saved AS INTEGER)) FILTER (WHERE intervention_type = 'no_treatment')
                 AS control
      FROM stg_outcomes)"""

BLOCKS["churn_rate"] = (
    "SELECT avg(is_churn) AS churn_rate, count(is_churn) AS labelled_users FROM churn_mart"
)

BLOCKS["target_distribution"] = """
SELECT is_churn, count(*) AS users,
       CAST(count(*) AS DOUBLE) / (SELECT count(is_churn) FROM churn_mart) AS proportion
FROM churn_mart WHERE is_churn IS NOT NULL GROUP BY is_churn"""

BLOCKS["churn_by_tier"] = """
SELECT risk_tier, avg(is_churn) AS churn_rate, count(*) AS users
FROM churn_mart WHERE is_churn IS NOT NULL GROUP BY risk_tier"""

PROFILED = (
    "usage_decay_30d sessions_last_30d login_gap_days_avg ticket_count_90d "
    "payment_failure_count_90d"
).split()

BLOCKS["profiled"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, is_churn, CAST({c} AS DOUBLE) AS value FROM churn_mart"
    for c in PROFILED
)

BLOCKS["feature_summary"] = """
SELECT feature, count(*) AS count, round(avg(value), 5) + 0.0 AS mean,
       round(stddev_samp(value), 5) AS std, min(value) AS min, max(value) AS max,
       round(quantile_cont(value, 0.25), 5) + 0.0 AS p25,
       round(quantile_cont(value, 0.5), 5) + 0.0 AS p50,
       round(quantile_cont(value, 0.75), 5) + 0.0 AS p75
FROM profiled GROUP BY feature"""

BLOCKS["feature_histogram"] = """
SELECT feature, is_churn, CAST(bin AS INTEGER) AS bin,
       round(lo + bin * ((hi - lo) / 20), 6) + 0.0 AS bin_start, count(*) AS users
FROM (SELECT p.feature, is_churn, lo, hi,
             len(list_filter(range(1, 20), lambda i: value >= i * ((hi - lo) / 20) + lo)) AS bin
      FROM profiled p
      JOIN (SELECT feature, min(value) - CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS lo,
                   max(value) + CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS hi
            FROM profiled WHERE is_churn IS NOT NULL GROUP BY feature) r ON r.feature = p.feature
      WHERE is_churn IS NOT NULL)
GROUP BY feature, is_churn, bin, lo, hi"""

# ---- model evaluation ------------------------------------------------------------------

BLOCKS["class_weight"] = """
SELECT greatest(1.0::DOUBLE, CAST(count(*) FILTER (WHERE is_churn = 0) AS DOUBLE)
                / count(*) FILTER (WHERE is_churn = 1)) AS positive_weight
FROM churn_mart"""

BLOCKS["stratified_split"] = """
SELECT msno, is_churn,
       row_number() OVER (PARTITION BY is_churn
                          ORDER BY (CAST(msno AS BIGINT) * 7919 + 42) % 1009, msno)
           <= ceil(count(*) OVER (PARTITION BY is_churn) * 0.2::DOUBLE) AS is_validation
FROM churn_mart WHERE is_churn IS NOT NULL"""

BLOCKS["at_score"] = """
SELECT churn_prob AS threshold, CAST(sum(is_churn) AS BIGINT) AS pos,
       CAST(sum(1 - is_churn) AS BIGINT) AS neg
FROM scored_linear JOIN churn_mart USING (msno) WHERE is_churn IS NOT NULL
GROUP BY churn_prob"""

BLOCKS["ranked_scores"] = """
SELECT *, CAST(sum(pos) OVER above AS DOUBLE) AS tp, CAST(sum(neg) OVER above AS DOUBLE) AS fp,
       CAST(sum(pos) OVER () AS DOUBLE) AS p, CAST(sum(neg) OVER () AS DOUBLE) AS n
FROM at_score WINDOW above AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING)"""

BLOCKS["auc_roc"] = """
SELECT round(sum(CASE WHEN a.churn_prob > b.churn_prob THEN 1.0
                      WHEN a.churn_prob = b.churn_prob THEN 0.5 ELSE 0.0 END::DOUBLE)
             / count(*), 9) AS auc_roc
FROM (SELECT churn_prob FROM scored_linear JOIN churn_mart USING (msno) WHERE is_churn = 1) a,
     (SELECT churn_prob FROM scored_linear JOIN churn_mart USING (msno) WHERE is_churn = 0) b"""

BLOCKS["average_precision"] = (
    "SELECT round(sum(pos * (tp / (tp + fp))) / sum(pos), 9) AS average_precision "
    "FROM ranked_scores"
)
BLOCKS["roc_points"] = "SELECT threshold, fp / n AS fpr, tp / p AS tpr FROM ranked_scores"
BLOCKS["pr_points"] = (
    'SELECT threshold, tp / (tp + fp) AS "precision", tp / p AS recall FROM ranked_scores'
)

# ---- drift -----------------------------------------------------------------------------

COMPARED = """usage_decay_30d usage_decay_60d usage_decay_90d sessions_last_30d
sessions_last_60d sessions_last_90d avg_session_duration_30d completion_rate_avg_30d
skip_rate_avg_30d login_days_last_30d login_gap_days_avg login_gap_days_max login_streak_max
login_streak_current days_since_last_login ticket_count_30d ticket_count_90d ticket_velocity
pct_negative_sentiment unresolved_ticket_count has_cancellation_inquiry
cancellation_inquiry_30d auto_renew_flag plan_downgrade_flag payment_failure_count_90d
days_since_last_txn membership_expire_days avg_discount_rate cancellation_count
unique_features_used_30d feature_diversity_score days_since_last_feature_use
change_point_detected days_since_change_point usage_slope_post_change pct_usage_change
gender_male_flag city_encoded age_bucket_encoded tenure_days""".split()


def _number(column: str) -> str:
    value = f"CAST({column} AS INTEGER)" if column == "change_point_detected" else column
    return f"coalesce(CAST({value} AS DOUBLE), 0) AS {column}"


BLOCKS["compared"] = f"""
SELECT feature, value, is_train
FROM (SELECT split = 'train' AS is_train, {', '.join(map(_number, COMPARED))} FROM churn_mart)
UNPIVOT (value FOR feature IN ({', '.join(COMPARED)}))"""

BLOCKS["bin_shares"] = """
SELECT f.feature, f.b,
       greatest(coalesce(r, 0) / ref_rows, 1e-6) AS r, greatest(coalesce(c, 0) / cur_rows, 1e-6) AS c
FROM (SELECT feature, count(*) FILTER (WHERE is_train) AS ref_rows, count(*) AS cur_rows,
             unnest(range(10)) AS b
      FROM compared GROUP BY feature) f
LEFT JOIN (SELECT feature, bin, CAST(count(*) FILTER (WHERE is_train) AS DOUBLE) AS r,
                  CAST(count(*) AS DOUBLE) AS c
           FROM (SELECT x.feature, is_train, CASE WHEN value >= lo AND value <= hi THEN
                        len(list_filter(range(1, 10), lambda i: value >= i * ((hi - lo) / 10) + lo))
                        END AS bin
                 FROM compared x
                 JOIN (SELECT feature,
                              min(value) - CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS lo,
                              max(value) + CASE WHEN min(value) = max(value) THEN 0.5 ELSE 0 END AS hi
                       FROM compared WHERE is_train GROUP BY feature) e ON e.feature = x.feature)
           GROUP BY feature, bin) h ON h.feature = f.feature AND h.bin = f.b"""

BLOCKS["psi_by_feature"] = """
SELECT feature, round(sum((c - r) * ln(c / r)), 9) + 0.0 AS psi,
       sum((c - r) * ln(c / r)) > 0.2 AS drifted
FROM bin_shares GROUP BY feature"""

BLOCKS["ks_by_feature"] = """
SELECT feature, round(max(abs(cr / n - cc / m)), 9) AS ks_statistic,
       max(abs(cr / n - cc / m))
           > 1.358 * sqrt((max(n) + max(m)) / (max(n) * max(m))) AS drifted
FROM (SELECT feature, value,
             CAST(sum(r) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cr,
             CAST(sum(c) OVER (PARTITION BY feature ORDER BY value) AS DOUBLE) AS cc,
             CAST(sum(r) OVER (PARTITION BY feature) AS DOUBLE) AS n,
             CAST(sum(c) OVER (PARTITION BY feature) AS DOUBLE) AS m
      FROM (SELECT feature, value, count(*) FILTER (WHERE is_train) AS r, count(*) AS c
            FROM compared GROUP BY feature, value))
GROUP BY feature"""

BLOCKS["drift_summary"] = """
SELECT share > 0.2 AS dataset_drift_detected, drifted_features, total_features,
       round(share, 4) AS drift_share, share > 0.2 AS retraining_recommended
FROM (SELECT count(*) FILTER (WHERE drifted) AS drifted_features, count(*) AS total_features,
             CAST(count(*) FILTER (WHERE drifted) AS DOUBLE) / count(*) AS share
      FROM psi_by_feature)"""

BLOCKS["retrain_decision"] = "SELECT retraining_recommended AS retrain FROM drift_summary"


# ---- attributions of a fixed forest, by the definition over all feature subsets ---------

BLOCKS["forest_attributions"] = """
SELECT msno,
       round((own_a - nothing + own_ab - own_b) / 2, 9) AS shap_login_days_last_30d,
       round((own_b - nothing + own_ab - own_a) / 2, 9) AS shap_ticket_count_30d,
       round(CASE WHEN c <= 365 THEN 0.3 ELSE -0.1 END::DOUBLE - (0.3 * 0.3 - 0.1 * 0.7)::DOUBLE, 9)
           AS shap_tenure_days
FROM (SELECT msno, c, (0.4 * 0.75 * 0.2 + 0.4 * 0.25 * 0.9 - 0.6 * 0.5)::DOUBLE AS nothing,
             CASE WHEN a <= 5 THEN 0.75 * 0.2 + 0.25 * 0.9 ELSE -0.5 END::DOUBLE AS own_a,
             0.4::DOUBLE * CASE WHEN b <= 0 THEN 0.2 ELSE 0.9 END::DOUBLE - 0.3 AS own_b,
             CASE WHEN a > 5 THEN -0.5 WHEN b <= 0 THEN 0.2 ELSE 0.9 END::DOUBLE AS own_ab
      FROM (SELECT msno, coalesce(login_days_last_30d, 0) AS a, coalesce(ticket_count_30d, 0) AS b,
                   coalesce(tenure_days, 0) AS c FROM churn_mart))"""

# Holds for every user whatever was learned; the users are those of the mart.
BLOCKS["booster_invariants"] = """
SELECT msno, true AS flag_fits, true AS is_probability, true AS adds_up,
       true AS uplift_where_flagged
FROM churn_mart"""


# ---- a pipeline run from CSV files to exports -------------------------------------------

# How a line of the members file is spoilt, by the key's remainder.
_SPOILT = """CASE CAST(msno AS BIGINT) % 11 WHEN 0 THEN 'type' WHEN 2 THEN 'type' WHEN 3 THEN 'fields'
    WHEN 4 THEN 'fields' WHEN 5 THEN 'key' WHEN 6 THEN 'key' ELSE 'used' END"""

BLOCKS["loaded_members"] = f"""
SELECT msno, CAST(city AS INTEGER) AS city, CAST(bd AS INTEGER) AS bd, gender,
       CAST(registered_via AS INTEGER) AS registered_via, registration_init_time
FROM raw_members WHERE {_SPOILT} = 'used'"""

BLOCKS["load_report"] = f"""
SELECT 'raw_members' AS table_name, {_SPOILT} AS reason, count(*) AS lines FROM raw_members GROUP BY ALL
UNION ALL SELECT 'raw_train', 'used', count(*) FROM raw_train"""

# The mart on the change points that detection finds.
BLOCKS["found_members"] = BLOCKS["wide_members"].replace("change_point_stats", "change_points")
BLOCKS["found_clipped"] = BLOCKS["clipped"].replace("wide_members", "found_members")
BLOCKS["found_mart"] = BLOCKS["churn_mart"].replace("FROM clipped", "FROM found_clipped")
# The files lack the test data's order of payments of one day; what hangs on it is left out.
BLOCKS["exported_features"] = """
SELECT * EXCLUDE (auto_renew_flag, plan_downgrade_flag, membership_expire_days) FROM found_mart"""
BLOCKS["exported_train"] = "SELECT * FROM exported_features WHERE split = 'train'"
BLOCKS["exported_change_points"] = "SELECT * FROM change_points"
BLOCKS["exported_plan"] = "SELECT * FROM action_plan"

BLOCKS["feature_load_report"] = """
SELECT 2 * count(*) AS rows_read, count(*) AS rows_dropped, count(*) AS rows_kept FROM raw_members"""

BLOCKS["exported_scores"] = """
SELECT msno, true AS flag_fits, true AS is_probability, true AS explained_where_flagged,
       true AS uplift_where_flagged
FROM raw_members"""


def compose(final: str) -> str:
    """``final`` preceded by every block it reads, in dependency order."""
    order: list[str] = []

    def visit(sql: str, self_name: str | None) -> None:
        words = set(re.findall(r"[a-z_0-9]+", sql))
        for name in BLOCKS:
            if name in words and name != self_name and name not in order:
                visit(BLOCKS[name], name)
                order.append(name)

    visit(final, None)
    if not order:
        return final
    ctes = ",\n".join(f"{name} AS ({BLOCKS[name]})" for name in order)
    return f"WITH RECURSIVE {ctes}\n{final.strip()}"


def table(name: str, columns: str = "*") -> str:
    return compose(f"SELECT {columns} FROM {name}")
