"""Feature drift between a reference and a current frame, and the retraining decision."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from staywise.config import DRIFT_EXCLUDED, EngineConfig
from staywise.functions.columns import columns, round_to
from staywise.operators.ranking import running_totals


def drift_columns(reference: DataFrame, current: DataFrame) -> tuple[list[str], list[str]]:
    """Compared columns in reference order, split into numeric and text ones."""
    shared = set(current.columns)
    kinds = {f.name: f.dataType for f in reference.schema.fields}
    common = [c for c in reference.columns if c in shared and c not in DRIFT_EXCLUDED]
    numeric = [c for c in common if isinstance(kinds[c], (T.NumericType, T.BooleanType))]
    return numeric, [c for c in common if c not in numeric]


def as_number(frame: DataFrame, column: str) -> str:
    """Value as a double, NULL as 0, booleans as 0 and 1."""
    boolean = isinstance(frame.schema[column].dataType, T.BooleanType)
    inner = f"CAST({column} AS INT)" if boolean else column
    return f"coalesce(CAST({inner} AS DOUBLE), 0D)"


def long_values(frame: DataFrame, names: list[str], *keep: str) -> DataFrame:
    """(feature, value) rows; nothing is shuffled before they are counted."""
    pairs = ", ".join(f"'{c}', {as_number(frame, c)}" for c in names)
    return frame.selectExpr(*keep, f"stack({len(names)}, {pairs}) AS (feature, value)")


def feature_ranges(frame: DataFrame, names: list[str]) -> DataFrame:
    """Minimum and maximum per feature: one aggregate row turned into one row per column.

    A constant column gets half a unit on either side.
    """
    ends = {}
    for c in names:
        ends[f"lo_{c}"] = f"min({as_number(frame, c)})"
        ends[f"hi_{c}"] = f"max({as_number(frame, c)})"
    rows = ", ".join(f"'{c}', lo_{c}, hi_{c}" for c in names)
    listed = frame.agg(*columns(ends)).selectExpr(
        f"stack({len(names)}, {rows}) AS (feature, low, high)"
    )
    flat = "CASE WHEN low = high THEN 0.5D ELSE 0D END"
    return listed.selectExpr("feature", f"low - {flat} AS lo", f"high + {flat} AS hi")


def bin_of(bins: int) -> str:
    """Equal-width bin of ``value`` within [lo, hi], NULL outside; the last bin is closed."""
    passed = " + ".join(
        f"CAST(value >= {i} * ((hi - lo) / {bins}D) + lo AS INT)" for i in range(1, bins)
    )
    return f"CASE WHEN value BETWEEN lo AND hi THEN {passed} END"


def bin_counts(reference: DataFrame, current: DataFrame, numeric: list[str], bins: int) -> DataFrame:
    """Counts per (feature, side, bin); partial counts leave each task, not values."""
    sides = (
        long_values(reference, numeric)
        .selectExpr("*", "true AS is_ref")
        .unionByName(long_values(current, numeric).selectExpr("*", "false AS is_ref"))
    )
    # As many rows as the table has columns.
    ranges = F.broadcast(feature_ranges(reference, numeric))
    return (
        sides.join(ranges, "feature")
        .selectExpr("feature", "is_ref", f"{bin_of(bins)} AS bin")
        .groupBy("feature", "is_ref", "bin")
        .agg(*columns({"n": "count(*)"}))
    )


def psi_by_feature(reference: DataFrame, current: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Population stability index per compared column.

    Bins span the reference values. Current values outside them are in no bin but stay in
    the denominator. Text columns are listed without an index and never drift.
    """
    numeric, text = drift_columns(reference, current)
    return _stability(bin_counts(reference, current, numeric, cfg.psi_bins), text, cfg)


def _stability(counts: DataFrame, text: list[str], cfg: EngineConfig) -> DataFrame:
    """The index of the numeric columns from their counts per side and bin, and the text ones."""
    bins = range(cfg.psi_bins)

    def rows(condition: str) -> str:
        return f"sum(CASE WHEN {condition} THEN n ELSE 0 END)"

    sums = {"ref_rows": rows("is_ref"), "cur_rows": rows("NOT is_ref")}
    for b in bins:
        sums[f"r{b}"] = rows(f"is_ref AND bin = {b}")
        sums[f"c{b}"] = rows(f"NOT is_ref AND bin = {b}")
    shares = {
        f"{side}{b}": f"greatest(coalesce(try_divide({side}{b}, {whole}), 0D), {cfg.psi_floor}D)"
        for b in bins
        for side, whole in (("r", "ref_rows"), ("c", "cur_rows"))
    }
    index = " + ".join(f"(c{b} - r{b}) * ln(c{b} / r{b})" for b in bins)
    result = (
        counts.groupBy("feature")
        .agg(*columns(sums))
        .select("feature", *columns(shares))
        .selectExpr("feature", f"{index} AS psi")
        .selectExpr("*", f"psi > {cfg.psi_threshold}D AS drifted")
    )
    if text:
        listed = counts.sparkSession.createDataFrame(
            [(c, None, False) for c in text], "feature string, psi double, drifted boolean"
        )
        result = result.unionByName(listed)
    return result


def ks_by_feature(reference: DataFrame, current: DataFrame) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic per numeric column.

    Drift is called beyond the asymptotic 5 % critical value.
    """
    numeric, _ = drift_columns(reference, current)
    known = long_values(reference, numeric).selectExpr("*", "1L AS n")
    return _distance(known, long_values(current, numeric))


def _distance(known: DataFrame, values: DataFrame) -> DataFrame:
    """The statistic between counted reference values and single current ones."""
    sides = known.selectExpr("feature", "value", "n AS r", "0L AS c").unionByName(
        values.selectExpr("feature", "value", "0L AS r", "1L AS c")
    )
    sums = columns({"r": "sum(r)", "c": "sum(c)"})
    counts = sides.groupBy("feature", "value").agg(*sums)
    ranked = running_totals(counts, "value", ["r", "c"], "feature")
    statistic = "max(abs(cum_r / all_r - cum_c / all_c))"
    n, m = "CAST(max(all_r) AS DOUBLE)", "CAST(max(all_c) AS DOUBLE)"
    critical = f"1.358D * sqrt(({n} + {m}) / ({n} * {m}))"
    return ranked.groupBy("feature").agg(
        *columns({"ks_statistic": statistic, "drifted": f"{statistic} > {critical}"})
    )


# ---- a stored reference ----------------------------------------------------------------


def reference_profile(reference: DataFrame) -> DataFrame:
    """How often each value of each compared column occurs: (feature, value, n).

    Text columns have one row without a value. All that the index and the distance need of the
    reference is in here, so reports read the current side only. Profiles of parts of a
    reference add up (``merged_profiles``). It has a row per distinct value, so at most as many
    as the reference has cells, and far fewer where features are counts.
    """
    numeric, text = drift_columns(reference, reference)
    counted = (
        long_values(reference, numeric).groupBy("feature", "value").agg(*columns({"n": "count(*)"}))
    )
    if not text:
        return counted
    names = [(c, None, None) for c in text]
    return counted.unionByName(
        reference.sparkSession.createDataFrame(names, "feature string, value double, n bigint")
    )


def merged_profiles(*profiles: DataFrame) -> DataFrame:
    """Profile of all rows that the given profiles describe."""
    rows = reduce(DataFrame.unionByName, profiles)
    return rows.groupBy("feature", "value").agg(*columns({"n": "sum(n)"}))


def _profiled(profile: DataFrame, current: DataFrame) -> tuple[list[tuple[str, float, float]], list[str]]:
    """Ranges of the numeric columns that both have, and the text ones: a row per column."""
    ends = columns({"low": "min(value)", "high": "max(value)"})
    facts = {r["feature"]: r for r in profile.groupBy("feature").agg(*ends).collect()}
    shared = [c for c in current.columns if c in facts]
    ranges = []
    for name in shared:
        low, high = facts[name]["low"], facts[name]["high"]
        if low is not None:
            flat = 0.5 if low == high else 0.0
            ranges.append((name, low - flat, high + flat))
    return ranges, [c for c in shared if facts[c]["low"] is None]


def psi_against(profile: DataFrame, current: DataFrame, cfg: EngineConfig) -> DataFrame:
    """``psi_by_feature`` against a stored profile; columns that it lacks are not compared."""
    ranges, text = _profiled(profile, current)
    spark = current.sparkSession
    spans = spark.createDataFrame(ranges, "feature string, lo double, hi double")
    values = current.limit(0).selectExpr("'' AS feature", "0D AS value")
    if ranges:
        values = long_values(current, [name for name, *_ in ranges])
    sides = (
        profile.filter("value IS NOT NULL")
        .selectExpr("feature", "value", "n", "true AS is_ref")
        .unionByName(values.selectExpr("feature", "value", "1L AS n", "false AS is_ref"))
    )
    counts = (
        sides.join(F.broadcast(spans), "feature")
        .selectExpr("feature", "is_ref", f"{bin_of(cfg.psi_bins)} AS bin", "n")
        .groupBy("feature", "is_ref", "bin")
        .agg(*columns({"n": "sum(n)"}))
    )
    return _stability(counts, text, cfg)


def ks_against(profile: DataFrame, current: DataFrame) -> DataFrame:
    """``ks_by_feature`` against a stored profile."""
    ranges, _ = _profiled(profile, current)
    names = [name for name, *_ in ranges]
    known = profile.filter(F.col("feature").isin(names))
    return _distance(known, long_values(current, names))


def drift_summary(by_feature: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One-row report; drift of the data set means that too large a share of columns drifted."""
    share = "coalesce(try_divide(count_if(drifted), count(*)), 0D)"
    metrics = {
        "dataset_drift_detected": f"{share} > {cfg.drift_share}D",
        "drifted_features": "count_if(drifted)",
        "total_features": "count(*)",
        "drift_share": round_to(share, 4),
        "retraining_recommended": f"{share} > {cfg.drift_share}D",
    }
    return by_feature.agg(*columns(metrics))


def should_retrain(report: Callable[[], DataFrame], force: bool = False) -> bool:
    """Forced, drifted, or no feature exports to compare yet; the report runs once at most."""
    if force:
        return True
    try:
        return bool(report().first()["retraining_recommended"])
    except FileNotFoundError:
        return True
