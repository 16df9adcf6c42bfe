"""SQL expression builders shared by the operators.

They return expression text for ``selectExpr`` / ``F.expr``: the driver hands each whole
expression to Spark in one call, and everything stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, functions as F


def columns(named: Mapping[str, str]) -> list[Column]:
    """``{name: expression}`` as aliased columns."""
    return [F.expr(f"{sql} AS {name}") for name, sql in named.items()]


def day_from_int(column: str) -> str:
    """YYYYMMDD integer to date; anything that is no calendar day becomes NULL."""
    return f"try_to_date(CAST({column} AS STRING), 'yyyyMMdd')"


def day_from_text(column: str) -> str:
    return f"TRY_CAST({column} AS DATE)"


def clean_text(column: str) -> str:
    return f"lower(trim({column}))"


def day(value: date) -> str:
    return f"DATE'{value.isoformat()}'"


def days_ago(ref_date: date, column: str) -> str:
    """Whole days from ``column`` to the reference date; negative for later days."""
    return f"datediff({day(ref_date)}, {column})"


def round_to(value: str, digits: int) -> str:
    """Binary half-away-from-zero rounding of a double.

    ``round`` goes through BigDecimal: slower, and it settles halves on the decimal text
    of the number instead of on the number itself.
    """
    scale = f"{10**digits}D"
    return (
        f"(CASE WHEN ({value}) < 0 THEN -floor(-({value}) * {scale} + 0.5D) "
        f"ELSE floor(({value}) * {scale} + 0.5D) END / {scale})"
    )


def ratio(numerator: str, denominator: str) -> str:
    """Double division that yields NULL for a zero denominator."""
    return f"(CAST({numerator} AS DOUBLE) / nullif(CAST({denominator} AS DOUBLE), 0D))"


def to_units(value: str, digits: int) -> str:
    """A double holding at most ``digits`` decimals as an exact count of its last digit.

    Sums of such counts do not depend on row order, so a retried task or another
    partitioning returns the very same total.
    """
    return f"CAST(rint({value} * {10**digits}D) AS BIGINT)"


def from_units(units: str, digits: int) -> str:
    return f"(CAST({units} AS DOUBLE) / {10**digits}D)"


def flag(condition: str) -> str:
    """1 when the condition holds, 0 when it is false or unknown."""
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"
