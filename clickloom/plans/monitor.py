"""The daily monitoring run over all days."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.config import Config
from clickloom.operators import monitoring as m
from clickloom.operators.cleaning import normalise_schema


def monitored_days(raw: DataFrame, cfg: Config, headers: DataFrame | None = None) -> DataFrame:
    """Day profiles with the baseline of the first days."""
    events = normalise_schema(raw, cfg)
    return m.with_baseline(m.day_profile(events, cfg, headers), cfg)


def monitoring_tables(days: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """All that follows from day profiles with their baseline; no event is read for it."""
    found = m.alerts(days, cfg)
    history = m.history_of_days(days)
    return {
        "alerts": found,
        "alert_counts": m.alert_counts(found),
        "metrics": m.metric_results(days, cfg),
        "verdicts": m.critical_verdict(days, found),
        "z_scores": m.metric_zscores(history, m.baseline_stats(history, cfg), cfg),
        "rolling_baseline": m.rolling_baseline(history, cfg),
    }


def run_monitoring(raw: DataFrame, cfg: Config, headers: DataFrame | None = None) -> dict[str, DataFrame]:
    """Alerts, metrics and verdicts of every day as lazy tables side by side."""
    return monitoring_tables(monitored_days(raw, cfg, headers), cfg)
