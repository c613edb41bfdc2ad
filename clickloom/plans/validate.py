"""The data-quality run over all files."""

from __future__ import annotations

from pyspark.sql import DataFrame

from clickloom.config import Config
from clickloom.operators import quality as q
from clickloom.operators.cleaning import normalise_schema
from clickloom.operators.conversions import transactions


def validation_tables(profile: DataFrame, bought: DataFrame, samples: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """All that follows from one row per file, the extracted transactions and the samples; no event is read for it."""
    results = q.dq_results(profile, cfg)
    verdicts = q.file_verdicts(results)
    daily = q.daily_metrics(profile)
    return {
        "results": q.with_samples(results, samples),
        "samples": samples,
        "verdicts": verdicts,
        "totals": q.batch_totals(verdicts),
        "daily_metrics": daily,
        "trend_anomalies": q.trend_anomalies(daily, cfg),
        "purchase_rate_band": q.purchase_rate_band(daily, cfg),
        "null_rate_vs_history": q.null_rate_vs_history(daily, cfg),
        "schema_changes": q.schema_changes(profile.select("source_file", "columns")),
        "cross_file_duplicates": q.repeated_ids(bought),
        "duplicate_occurrences": q.occurrences_of_repeated(bought),
    }


def run_validation(raw: DataFrame, headers: DataFrame, cfg: Config) -> dict[str, DataFrame]:
    """Results, verdicts, samples and cross-file findings as lazy tables side by side.

    `passed_events` and `quarantined_events` are the events of files that passed and of the others.
    """
    events = normalise_schema(raw, cfg, fill_referrer=False)
    tables = validation_tables(q.file_profile(events, headers, cfg), transactions(events, cfg), q.all_samples(events, cfg), cfg)
    passed, held = q.quarantine_split(events, tables["verdicts"])
    return tables | {
        "invalid_event_names": q.invalid_event_names(events, cfg),
        "passed_events": passed,
        "quarantined_events": held,
    }
