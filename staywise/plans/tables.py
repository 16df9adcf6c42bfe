"""Lazily composed tables of the engine over one set of raw tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame

from staywise.config import EngineConfig
from staywise.operators import changepoint, features, marts, sessions, staging
from staywise.sources.schemas import CHANGE_POINTS


class Tables:
    """Every stage as a lazy DataFrame built from its inputs on first use.

    ``stage`` is applied to the tables that several later stages read. The default keeps
    them lazy; a pipeline passes a function that writes the table and reads it back.
    ``locate`` adds the change index ``cp_idx`` to users' ``days`` and ``secs``.
    """

    def __init__(self, raw: Mapping[str, DataFrame], cfg: EngineConfig, stage=None, locate=None):
        self.raw = raw
        self.cfg = cfg
        self._stage = stage or (lambda name, frame: frame)
        self._locate = locate or (lambda series: changepoint.with_breakpoints(series, cfg))

    @cached_property
    def members(self) -> DataFrame:
        return staging.stage_members(self.raw["raw_members"], self.cfg)

    @property
    def labels(self) -> DataFrame:
        return self.raw["raw_train"]

    @cached_property
    def user_logs(self) -> DataFrame:
        return staging.stage_user_logs(self.raw["raw_user_logs"])

    @cached_property
    def payments(self) -> DataFrame:
        return staging.stage_payments(self.raw["raw_transactions"])

    @cached_property
    def transactions(self) -> DataFrame:
        return self._stage("stg_transactions", staging.stage_transactions(self.payments))

    @cached_property
    def feature_events(self) -> DataFrame:
        return staging.stage_feature_events(self.raw["raw_feature_events"])

    @cached_property
    def support_tickets(self) -> DataFrame:
        return staging.stage_support_tickets(self.raw["raw_support_tickets"])

    @cached_property
    def interventions(self) -> DataFrame:
        return staging.stage_interventions(self.raw["raw_interventions"])

    @cached_property
    def outcomes(self) -> DataFrame:
        return staging.stage_outcomes(self.raw["raw_outcomes"])

    @cached_property
    def rollup(self) -> DataFrame:
        return sessions.daily_rollup(self.user_logs)

    @cached_property
    def log_features(self) -> DataFrame:
        """Cadence, usage and change point of every log user from one pass over the log."""
        fused = sessions.activity_features(self.rollup, self.cfg, with_series=True)
        kept = [c for c in fused.columns if c not in ("msno", "days", "secs")]
        found = changepoint.change_point_stats(self._locate(fused), *kept)
        return self._stage("log_features", found)

    @cached_property
    def change_points(self) -> DataFrame:
        return self.log_features.select(*CHANGE_POINTS.names)

    def _master(self, labelled_only: bool) -> DataFrame:
        return features.feature_master(
            members=self.members,
            labels=self.labels,
            activity=self.log_features,
            support=features.support_signals(self.support_tickets, self.cfg),
            payments=features.transaction_signals(self.transactions, self.cfg),
            adoption=features.feature_adoption(self.feature_events, self.cfg),
            change_points=None,
            engagement=features.intervention_engagement(self.interventions),
            labelled_only=labelled_only,
        )

    @cached_property
    def feature_master(self) -> DataFrame:
        return self._master(labelled_only=True)

    @cached_property
    def mart(self) -> DataFrame:
        """Churn mart of all members; the train split is its labelled part."""
        return self._stage("mart_churn_features", marts.churn_mart(self._master(False), self.cfg))

    @cached_property
    def intervention_mart(self) -> DataFrame:
        return self._stage(
            "mart_intervention_results",
            marts.intervention_mart(self.mart, self.interventions, self.outcomes),
        )
