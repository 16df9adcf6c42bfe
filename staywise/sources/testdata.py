"""The raw tables derived from the TPC-H-like test tables.

Each function reads whole tables. Activity patterns come from moving events in time and from
a step in the level of every third user. Tickets are the error events; customers whose last
order is pending have no label. User ``user_id`` of the events is customer ``c_custkey``.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from staywise.config import EngineConfig
from staywise.functions.columns import columns, day

TEST_CONFIG = EngineConfig(ref_date=date(2024, 1, 31))

# Known schemas spare the driver one footer-reading job per table.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
    "c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
    "value double, props string",
}

# Brings the last order (2001-08-01) to the day before the reference date.
ORDER_SHIFT = 8217


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def key(column: str) -> str:
    return f"CAST({column} AS STRING) AS msno"


def as_int_day(value: str) -> str:
    return f"year({value}) * 10000 + month({value}) * 100 + day({value})"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with their user's activity profile written into the day.

    By ``user_id % 5``: 0 mostly this month, 1 spread over three months, 2 fading out,
    3 spread thin over a year, 4 gone for at least 45 days.
    """
    back = """CASE user_id % 5
        WHEN 0 THEN if(event_id % 4 = 3, 30, 0)
        WHEN 1 THEN event_id % 3 * 30
        WHEN 2 THEN CASE WHEN event_id % 4 = 0 AND day(ts) > 15 AND event_id % 3 > 0 THEN 15
                         WHEN event_id % 4 = 0 THEN 0
                         WHEN event_id % 4 = 3 THEN 60
                         ELSE 30 END
        WHEN 3 THEN event_id % 12 * 30
        ELSE event_id % 4 * 30 + 45 END"""
    return read(spark, sf_dir, "events").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        f"date_sub(CAST(ts AS DATE), CAST({back} AS INT)) AS day",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )


# The day from which the users of a profile listen more, halfway through their histories.
STEP_DAYS = ("2024-01-08", "2023-12-16", "2023-12-16", "2023-08-01", "2023-10-20")
STEP_SECONDS = 40_000


def raw_user_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log line per user and day; every third user's level rises for good on some day."""
    kinds = {
        "num_25": "click",
        "num_50": "error",
        "num_75": "signup",
        "num_985": "view",
        "num_100": "purchase",
    }
    sums = {
        **{n: f"CAST(count_if(event_type = '{kind}') AS INT)" for n, kind in kinds.items()},
        "num_unq": "CAST(count(DISTINCT k) AS INT)",
        "total_secs": "CAST(sum(floor(value * 60)) AS DOUBLE)",
    }
    return (
        events(spark, sf_dir)
        .groupBy("user_id", "day")
        .agg(*columns(sums))
        .selectExpr(
            key("user_id"),
            f"{as_int_day('day')} AS date",
            *[n for n in sums if n != "total_secs"],
            f"""total_secs + if(user_id % 3 = 0 AND day >= CAST(elt(CAST(user_id % 5 AS INT) + 1,
                {', '.join(f"'{d}'" for d in STEP_DAYS)}) AS DATE), {STEP_SECONDS}D, 0D) AS total_secs""",
        )
    )


def raw_feature_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).selectExpr(
        key("user_id"),
        "CAST(day AS STRING) AS event_date",
        "' ' || upper(event_type) || ' ' AS feature_name",
        "CAST(floor(value) AS INT) AS session_duration_sec",
    )


def raw_support_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter("event_type = 'error'")
        .selectExpr(
            "event_id AS ticket_id",
            key("user_id"),
            "CAST(day AS STRING) AS ticket_date",
            """CASE WHEN k < 3 THEN ' Cancellation_Inquiry' WHEN k < 25 THEN 'BILLING'
                    WHEN k < 50 THEN 'technical' WHEN k < 75 THEN 'account '
                    ELSE 'feature_request' END AS category""",
            "elt(k % 3 + 1, 'Negative', 'neutral', 'positive') AS sentiment",
            """elt(CAST(event_id % 3 AS INT) + 1, 'resolved', 'unresolved ', 'escalated')
               AS resolution_status""",
            "if(event_id % 3 = 0, CAST(floor(value) AS DOUBLE), NULL) AS time_to_fix_hours",
        )
    )


def shifted_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "CAST(left(o_orderpriority, 1) AS INT) AS method",
        f"date_add(CAST(o_orderdate AS DATE), {ORDER_SHIFT}) AS day",
    )


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payment per order; orders without lines are unpriced plans."""
    amounts = {
        "listed": "sum(floor(l_extendedprice))",
        "paid": "sum(if(l_returnflag <> 'R', floor(l_extendedprice * (1 - l_discount)), 0))",
    }
    lines = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(*columns(amounts))
    orders = shifted_orders(spark, sf_dir)
    return orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left").selectExpr(
        key("o_custkey"),
        "o_orderkey AS txn_key",
        "method AS payment_method_id",
        "method * 30 AS payment_plan_days",
        "CAST(coalesce(listed, 0) AS DOUBLE) AS plan_list_price",
        "CAST(coalesce(paid, 0) AS DOUBLE) AS actual_amount_paid",
        "if(o_orderstatus = 'F', 1, 0) AS is_auto_renew",
        "if(o_orderstatus = 'P', 1, 0) AS is_cancel",
        f"{as_int_day('day')} AS transaction_date",
        f"{as_int_day('date_add(day, method * 30)')} AS membership_expire_date",
    )


def raw_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = shifted_orders(spark, sf_dir)
    joined = orders.groupBy("o_custkey").agg(*columns({"first_day": "min(day)"}))
    customers = read(spark, sf_dir, "customer")
    return customers.join(joined, customers.c_custkey == joined.o_custkey, "left").selectExpr(
        key("c_custkey"),
        """CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'MACHINERY') THEN 'male'
                WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'female' END AS gender""",
        "c_nationkey AS city",
        "c_nationkey % 5 AS registered_via",
        f"{as_int_day('first_day')} AS registration_init_time",
        "CAST(floor(c_acctbal / 100) AS INT) AS bd",
    )


def raw_train(spark: SparkSession, sf_dir: str, cfg: EngineConfig = TEST_CONFIG) -> DataFrame:
    """Churn label of every customer whose last order is not pending."""
    return (
        shifted_orders(spark, sf_dir)
        .groupBy("o_custkey")
        .agg(*columns({"last": "max(struct(day, o_orderkey, o_orderstatus))"}))
        .filter("last.o_orderstatus <> 'P'")
        .selectExpr(
            key("o_custkey"), f"if(datediff({day(cfg.ref_date)}, last.day) > 540, 1, 0) AS is_churn"
        )
    )


def raw_interventions(spark: SparkSession, sf_dir: str, cfg: EngineConfig = TEST_CONFIG) -> DataFrame:
    return read(spark, sf_dir, "customer").selectExpr(
        key("c_custkey"),
        """elt(CAST(c_custkey % 5 AS INT) + 1, 'no_treatment', ' Discount_Offer',
               'feature_highlight_email', 'personal_outreach ', 're_onboarding_flow')
           AS intervention_type""",
        f"""CAST(date_sub({day(cfg.ref_date)}, CAST(7 + c_custkey % 15 AS INT)) AS STRING)
            AS intervention_date""",
        "if(c_custkey % 5 IN (1, 2, 4), c_custkey % 3 = 0, NULL) AS email_opened",
        """if(c_custkey % 5 IN (1, 2, 4), c_custkey % 3 = 0 AND c_custkey % 2 = 0, NULL)
           AS email_clicked""",
    )


def raw_outcomes(spark: SparkSession, sf_dir: str, cfg: EngineConfig = TEST_CONFIG) -> DataFrame:
    treated = raw_interventions(spark, sf_dir, cfg)
    return (
        treated.join(raw_train(spark, sf_dir, cfg), "msno", "left")
        .selectExpr(
            "msno",
            "intervention_type",
            "coalesce(is_churn = 1, false) AS churner",
            "CAST(msno AS BIGINT) % 7 < CAST(msno AS BIGINT) % 5 AS persuaded",
        )
        .selectExpr(
            "msno",
            "intervention_type",
            "NOT churner OR persuaded AS renewed",
            "churner AND persuaded AS was_saved",
            "churner AND NOT persuaded AS observed_churn",
        )
    )


RAW_BUILDERS = {
    "raw_members": raw_members,
    "raw_train": raw_train,
    "raw_transactions": raw_transactions,
    "raw_user_logs": raw_user_logs,
    "raw_feature_events": raw_feature_events,
    "raw_support_tickets": raw_support_tickets,
    "raw_interventions": raw_interventions,
    "raw_outcomes": raw_outcomes,
}


class RawTables(Mapping):
    """The raw tables by name, each built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self._built = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = RAW_BUILDERS[name](self.spark, self.sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(RAW_BUILDERS)

    def __len__(self) -> int:
        return len(RAW_BUILDERS)
