"""Ordered look-back for keys of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Undated rows form one last day.
UNDATED = 2**31 - 1
# Ties are sliced by their leading bits: 256 slices of a day where ties are hashes.
SLICE_BITS = 56


def previous_value(df: DataFrame, key: str, day: str, tie: str, value: str, out: str) -> DataFrame:
    """``lag(value)`` within ``key``, by ``day`` (NULL last) and then by the whole number ``tie``.

    Rows are ordered inside (key, day, slice of ties) only. The first row of each takes the
    last value of the slice before it, from a table with one row per (key, day, slice) that
    is reduced before it is shuffled. So a key is never ordered in one task as a whole: its
    rows are spread over its days and, where ties are hashes, over 256 slices of a day.
    """
    names = [key, "__day", "__slice"]
    rows = df.selectExpr(
        "*",
        f"coalesce(unix_date({day}), {UNDATED}) AS __day",
        f"shiftright({tie}, {SLICE_BITS}) AS __slice",
    )
    inside = Window.partitionBy(*names).orderBy(tie)
    ordered = rows.withColumns(
        {"__inside": F.lag(value).over(inside), "__nth": F.row_number().over(inside)}
    )
    tails = rows.groupBy(*names).agg(F.max_by(value, tie).alias("__tail"))
    before = Window.partitionBy(key).orderBy("__day", "__slice")
    carried = tails.select(*names, F.lag("__tail").over(before).alias("__carry"))
    return ordered.join(carried, names).selectExpr(
        *df.columns, f"if(__nth = 1, __carry, __inside) AS {out}"
    )
