"""Schemas and file names of the raw tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
}


def _struct(spec: str) -> T.StructType:
    """Schema from ``name type, ...`` without needing a running session."""
    columns = [part.split() for part in spec.split(",")]
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in columns])


MEMBERS = _struct(
    "msno string, city int, bd int, gender string, registered_via int, registration_init_time int"
)
LABELS = _struct("msno string, is_churn int")
TRANSACTIONS = _struct(
    "msno string, payment_method_id int, payment_plan_days int, plan_list_price double, "
    "actual_amount_paid double, is_auto_renew int, transaction_date int, "
    "membership_expire_date int, is_cancel int"
)
USER_LOGS = _struct(
    "msno string, date int, num_25 int, num_50 int, num_75 int, num_985 int, num_100 int, "
    "num_unq int, total_secs double"
)
FEATURE_EVENTS = _struct(
    "msno string, event_date string, feature_name string, session_duration_sec int"
)
SUPPORT_TICKETS = _struct(
    "ticket_id bigint, msno string, ticket_date string, category string, sentiment string, "
    "resolution_status string, time_to_fix_hours double"
)
INTERVENTIONS = _struct(
    "msno string, intervention_type string, intervention_date string, email_opened boolean, "
    "email_clicked boolean"
)
OUTCOMES = _struct(
    "msno string, intervention_type string, renewed boolean, was_saved boolean, "
    "observed_churn boolean"
)
CHANGE_POINTS = _struct(
    "msno string, change_point_detected boolean, change_point_date date, "
    "days_since_change_point int, usage_slope_post_change double, pre_change_daily_mean double, "
    "post_change_daily_mean double, pct_usage_change double"
)


@dataclass(frozen=True)
class TableSpec:
    """A raw table: its schema and the file names it may come under, best first."""

    schema: T.StructType
    files: tuple[str, ...] = field(default_factory=tuple)


# Table and file names.
RAW_TABLES = {
    "raw_members": TableSpec(MEMBERS, ("members_v3.csv",)),
    "raw_train": TableSpec(LABELS, ("train_v2.csv", "train.csv")),
    "raw_transactions": TableSpec(TRANSACTIONS, ("transactions_v2.csv", "transactions.csv")),
    "raw_user_logs": TableSpec(USER_LOGS, ("user_logs_v2.csv", "user_logs.csv")),
    "raw_feature_events": TableSpec(FEATURE_EVENTS, ("feature_events.csv",)),
    "raw_support_tickets": TableSpec(SUPPORT_TICKETS, ("support_tickets.csv",)),
    "raw_interventions": TableSpec(INTERVENTIONS, ("interventions.csv",)),
    "raw_outcomes": TableSpec(OUTCOMES, ("outcomes.csv",)),
}
