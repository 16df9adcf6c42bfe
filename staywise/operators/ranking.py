"""Running totals over an ordering, spread over many tasks, and exact quantiles from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staywise.functions.columns import columns
from staywise.sources.writers import settle

# Rows of one slice of the ordering, which a single task sums up.
SLICE_ROWS = 1_000_000


def running_totals(
    df: DataFrame,
    order: str,
    sums: list[str],
    group: str | None = None,
    descending: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inclusive running totals ``cum_<name>`` and group totals ``all_<name>``.

    ``df`` holds one row per (group, order value), so copies are already collapsed. It is
    dealt into ranges of (group, value), as many as its number of rows asks for, and written
    with the number of the range; a task sums one range of a group, and the totals of the
    ranges before it come from a table with a row per group and range.
    """
    keys = [group] if group else []
    rows = settle(df)
    slices = max(2, -(-rows.count() // slice_rows))  # the count is in the file footers
    ordering = [F.col(order).desc() if descending else F.col(order)]
    dealt = rows.repartitionByRange(slices, *keys, *ordering)
    placed = settle(dealt.withColumn("__slice", F.spark_partition_id()))

    direction = "DESC" if descending else "ASC"
    inside = f"""(PARTITION BY {", ".join([*keys, "__slice"])} ORDER BY {order} {direction}
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
    of_group = f"PARTITION BY {group}" if group else ""
    before = f"({of_group} ORDER BY __slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    per_slice = placed.groupBy(*keys, "__slice").agg(*columns({s: f"sum({s})" for s in sums}))
    offsets = per_slice.selectExpr(
        *keys,
        "__slice",
        *[f"coalesce(sum({s}) OVER {before}, 0) AS __before_{s}" for s in sums],
        *[f"sum({s}) OVER ({of_group}) AS all_{s}" for s in sums],
    )
    totals = placed.selectExpr("*", *[f"sum({s}) OVER {inside} AS __cum_{s}" for s in sums])
    return totals.join(offsets, [*keys, "__slice"]).selectExpr(
        *df.columns,
        *[f"__cum_{s} + __before_{s} AS cum_{s}" for s in sums],
        *[f"all_{s}" for s in sums],
    )


def exact_quantiles(values: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """Linearly interpolated quantiles per group: columns ``q0``, ``q1``, ...

    Ranks come from running counts of distinct values, so no task holds a whole group.
    """
    counts = values.groupBy(group, value).agg(*columns({"n": "count(*)"}))
    ranked = running_totals(counts, value, ["n"], group)
    picks, blends = {}, {}
    for i, share in enumerate(shares):
        rank = f"{share}D * (all_n - 1)"
        for side, whole in (("lo", f"floor({rank})"), ("hi", f"ceil({rank})")):
            covered = f"{whole} BETWEEN cum_n - n AND cum_n - 1"
            picks[f"{side}{i}"] = f"max(CASE WHEN {covered} THEN {value} END)"
        picks[f"w{i}"] = f"max({rank} - floor({rank}))"
        blends[f"q{i}"] = f"lo{i} + (hi{i} - lo{i}) * w{i}"
    return ranked.groupBy(group).agg(*columns(picks)).select(group, *columns(blends))
