"""Exact classifier metrics and curves from a score column."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staywise.functions.columns import columns
from staywise.operators.ranking import SLICE_ROWS, running_totals


def class_weight(labelled: DataFrame, label: str = "is_churn") -> DataFrame:
    """Weight of the positive class: negatives per positive, at least 1."""
    weight = f"greatest(1D, try_divide(count({label}) - sum({label}), sum({label})))"
    return labelled.agg(*columns({"positive_weight": weight}))


def stratified_split(
    labelled: DataFrame,
    draw: str,
    label: str = "is_churn",
    key: str = "msno",
    share: float = 0.2,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Tag an exact share of each class as validation rows (``is_validation``).

    ``draw`` is a deterministic per-row number. The cut is the exact order statistic of
    the draw within each class, taken from distributed running counts.
    """
    drawn = labelled.selectExpr(key, label, f"{draw} AS __draw")
    counts = drawn.groupBy(label, "__draw").agg(*columns({"n": "count(*)"}))
    ranked = running_totals(counts, "__draw", ["n"], label)
    wanted = f"ceil(all_n * {share}D)"
    # One row per class: the draw at the cut and how many of its rows still fit.
    cut = F.broadcast(
        ranked.filter(f"cum_n >= {wanted} AND cum_n - n < {wanted}").selectExpr(
            label, "__draw AS __cut", f"{wanted} - cum_n + n AS __room"
        )
    )
    placed = drawn.join(cut, label)
    clear = placed.filter("__draw <> __cut").selectExpr(
        key, label, "__draw < __cut AS is_validation"
    )
    # Rows sharing the draw value at the cut are told apart by their key. A draw of few values
    # leaves many of them, so they are ranked in key ranges, not in one window of a class.
    at_cut = placed.filter("__draw = __cut").groupBy(label, key)
    copies = at_cut.agg(*columns({"n": "count(*)", "__room": "max(__room)"}))
    tied = running_totals(copies, key, ["n"], label, slice_rows=slice_rows).selectExpr(
        key, label, "explode(transform(sequence(1L, n), i -> cum_n - n + i <= __room)) AS is_validation"
    )
    return clear.unionByName(tied)


def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    sums = {"pos": f"sum(CAST({label} AS BIGINT))", "neg": f"sum(CAST(1 - {label} AS BIGINT))"}
    return scored.withColumnRenamed(score, "threshold").groupBy("threshold").agg(*columns(sums))


def _ranked(scored: DataFrame, score: str, label: str) -> DataFrame:
    return running_totals(
        score_counts(scored, score, label), "threshold", ["pos", "neg"], descending=True
    )


def auc_roc(scored: DataFrame, score: str = "churn_prob", label: str = "is_churn") -> DataFrame:
    """Area under the ROC curve; tied scores count half."""
    return auc_of_counts(score_counts(scored, score, label))


def auc_of_counts(counts: DataFrame) -> DataFrame:
    """The same from the numbers ``pos`` and ``neg`` of each distinct ``threshold``."""
    # Products of counts outgrow 64 bits with some 3e9 rows of each class.
    wide = "CAST({} AS DECIMAL(19,0))"
    wins = f"sum({wide.format('neg')} * {wide.format('2 * cum_pos - pos')})"
    pairs = f"{wide.format('sum(pos)')} * {wide.format('sum(neg)')}"
    area = f"try_divide(CAST({wins} AS DOUBLE) / 2D, CAST({pairs} AS DOUBLE))"
    ranked = running_totals(counts, "threshold", ["pos", "neg"], descending=True)
    return ranked.agg(*columns({"auc_roc": area}))


def average_precision(
    scored: DataFrame, score: str = "churn_prob", label: str = "is_churn"
) -> DataFrame:
    """Recall-weighted mean of the precision at each distinct score."""
    gained = "sum(pos * (cum_pos / (cum_pos + cum_neg)))"
    return _ranked(scored, score, label).agg(
        *columns({"average_precision": f"try_divide({gained}, sum(pos))"})
    )


def roc_points(scored: DataFrame, score: str = "churn_prob", label: str = "is_churn") -> DataFrame:
    return _ranked(scored, score, label).selectExpr(
        "threshold",
        "try_divide(cum_neg, all_neg) AS fpr",
        "try_divide(cum_pos, all_pos) AS tpr",
    )


def pr_points(scored: DataFrame, score: str = "churn_prob", label: str = "is_churn") -> DataFrame:
    return _ranked(scored, score, label).selectExpr(
        "threshold",
        "cum_pos / (cum_pos + cum_neg) AS precision",
        "try_divide(cum_pos, all_pos) AS recall",
    )
