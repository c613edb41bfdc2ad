"""Report tables over the derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from clickloom.functions.basics import count_if, exact_sum, ratio
from clickloom.operators.conversions import lenient_revenue

FUNNEL_STEPS = (
    ("sessions", None),
    ("add_to_cart", "has_add_to_cart"),
    ("checkout_started", "has_checkout_started"),
    ("purchase", "has_purchase"),
)


def _percent(part: Column, whole: Column) -> Column:
    return F.round(ratio(part, whole) * 100, 4)


def kpi_summary(sessions: DataFrame, conversions: DataFrame) -> DataFrame:
    """Revenue, orders, order value and the share of sessions that purchase."""
    totals = conversions.agg(
        exact_sum(F.col("revenue")).alias("revenue"), F.count("*").alias("orders")
    )
    visits = sessions.agg(F.count("*").alias("n"), count_if(F.col("has_purchase")).alias("bought"))
    return totals.select(
        "revenue",
        "orders",
        F.round(ratio(F.col("revenue"), F.col("orders")), 4).alias("aov"),
        visits.select(_percent(F.col("bought"), F.col("n"))).scalar().alias("session_conversion_pct"),
    )


def channel_efficiency(attributed: DataFrame, model: str = "last") -> DataFrame:
    """Conversions, revenue and order value per channel of one attribution model."""
    return (
        attributed.groupBy(F.col(f"{model}_click_channel").alias("channel"))
        .agg(F.count("*").alias("conversions"), exact_sum(F.col("revenue")).alias("revenue"))
        .withColumn("aov", F.round(ratio(F.col("revenue"), F.col("conversions")), 4))
    )


def revenue_share(attributed: DataFrame, model: str = "last") -> DataFrame:
    """Share of revenue per channel. The window runs over one row per channel."""
    per_channel = channel_efficiency(attributed, model)
    total = F.sum("revenue").over(Window.partitionBy())
    return per_channel.select(
        "channel", "revenue", _percent(F.col("revenue"), total).alias("revenue_pct")
    )


def attribution_shift(summary: DataFrame) -> DataFrame:
    """Revenue per channel under both models, and the change from first to last click."""
    def under(model: str) -> Column:
        return exact_sum(F.when(F.col("attribution_model") == model, F.col("revenue")))

    change = F.try_divide(F.col("last_click_revenue"), F.col("first_click_revenue")) - 1
    return (
        summary.groupBy("channel")
        .agg(under("first_click").alias("first_click_revenue"),
             under("last_click").alias("last_click_revenue"))
        .withColumn("change_pct", F.round(change * 100, 4))
    )


def funnel_report(sessions: DataFrame) -> DataFrame:
    """Sessions that reach each step, as a share of all and against the step before."""
    counted = sessions.agg(
        *[
            (F.count("*") if column is None else count_if(F.col(column))).alias(step)
            for step, column in FUNNEL_STEPS
        ]
    )
    rows, previous = [], None
    for number, (step, _) in enumerate(FUNNEL_STEPS, start=1):
        lost = F.lit(None).cast("double") if previous is None else F.round(
            F.lit(100.0) - ratio(F.col(step), F.col(previous)) * 100, 4
        )
        rows.append(
            F.struct(
                F.lit(number).alias("step_number"),
                F.lit(step).alias("step"),
                F.col(step).alias("sessions"),
                _percent(F.col(step), F.col("sessions")).alias("pct_of_sessions"),
                lost.alias("drop_off_pct"),
            )
        )
        previous = step
    return counted.select(F.inline(F.array(*rows)))


def journey_averages(journeys: DataFrame) -> DataFrame:
    return journeys.agg(
        F.round(F.avg("total_sessions"), 4).alias("avg_sessions"),
        F.round(F.avg("days_from_first_visit"), 4).alias("avg_days"),
        F.round(F.avg("channels_touched"), 4).alias("avg_channels"),
    )


def device_conversion(sessions: DataFrame) -> DataFrame:
    """Sessions, conversion rate and share of all conversions per device (one row each)."""
    per_device = sessions.groupBy("device_type").agg(
        F.count("*").alias("sessions"), count_if(F.col("has_purchase")).alias("conversions")
    )
    total = F.sum("conversions").over(Window.partitionBy())
    return per_device.withColumns(
        {
            "conversion_rate_pct": _percent(F.col("conversions"), F.col("sessions")),
            "conversion_share_pct": _percent(F.col("conversions"), total),
        }
    )


def weekend_conversion(sessions: DataFrame) -> DataFrame:
    weekend = F.dayofweek("session_date").isin(1, 7)
    return (
        sessions.filter("session_date is not null")
        .groupBy(F.when(weekend, "weekend").otherwise("weekday").alias("day_kind"))
        .agg(F.count("*").alias("sessions"), count_if(F.col("has_purchase")).alias("conversions"))
        .withColumn("conversion_rate_pct", _percent(F.col("conversions"), F.col("sessions")))
    )


def duplicate_revenue(purchases: DataFrame, conversions: DataFrame) -> DataFrame:
    """How much duplicates overstate revenue. `purchases` carry `payload`."""
    raw = purchases.agg(exact_sum(lenient_revenue()).alias("raw_revenue"))
    kept = conversions.agg(exact_sum(F.col("revenue")).alias("revenue"))
    return raw.withColumn("deduplicated_revenue", kept.scalar()).withColumn(
        "overstated", F.round(F.col("raw_revenue") - F.col("deduplicated_revenue"), 2)
    )


def daily_trend(conversions: DataFrame) -> DataFrame:
    return (
        conversions.filter("event_date is not null")
        .groupBy(F.col("event_date").alias("date"))
        .agg(F.count("*").alias("conversions"), exact_sum(F.col("revenue")).alias("revenue"))
    )
