"""First- and last-click attribution over a lookback window, and its daily summary.

Sessions of one client start more than a session gap apart, so at most (lookback / gap) of
them fall into a window of the lookback length. Each client's touches are packed into an
array per lookback-wide bucket, covering that bucket and the one before; a conversion finds
all its touches in the one array of its bucket. The join is one row to one row: no pairs are
made, and nothing is grouped again afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config
from clickloom.functions.basics import exact_sum, floor_div, micros, whole_days

_PARTS = ("source", "medium", "campaign", "channel")


def touch_windows(sessions: DataFrame, cfg: Config) -> DataFrame:
    """Per client and bucket the external touches that a conversion in it may look back to."""
    start = micros(F.col("session_start"))
    external = F.coalesce(F.col("marketing_channel") != "Internal", F.lit(True))
    touch = F.struct(
        start.alias("start_us"),
        F.col("traffic_source").alias("source"),
        F.col("traffic_medium").alias("medium"),
        F.col("traffic_campaign").alias("campaign"),
        F.col("marketing_channel").alias("channel"),
    )
    own = floor_div(start, cfg.lookback_us)
    return (
        sessions.filter(external & F.col("session_start").isNotNull())
        .select("client_id", F.explode(F.array(own, own + 1)).alias("bucket"), touch.alias("touch"))
        .groupBy("client_id", "bucket")
        .agg(F.sort_array(F.collect_list("touch")).alias("touches"))
    )


def lookback_touchpoints(conversions: DataFrame, sessions: DataFrame, cfg: Config) -> DataFrame:
    """Conversions with `touches`, their ordered external touches; both window ends count."""
    at = micros(F.col("conversion_timestamp"))
    located = conversions.withColumns(
        {"bucket": floor_div(at, cfg.lookback_us), "_at": at}
    )
    # Few clients convert; the sessions of all others end here, before they are packed. Both
    # sides of this join are partitioned by client already or small.
    buyers = conversions.select("client_id").distinct()
    windows = touch_windows(sessions.join(buyers, "client_id", "left_semi"), cfg)
    # One row of `windows` at most for each key; a client's many conversions are split by Spark.
    found = located.join(windows, ["client_id", "bucket"], "left")
    in_window = F.filter(
        F.col("touches"),
        lambda t: (t["start_us"] >= F.col("_at") - F.lit(cfg.lookback_us))
        & (t["start_us"] <= F.col("_at")),
    )
    empty = F.array().cast("array<struct<start_us:bigint,source:string,medium:string,"
                            "campaign:string,channel:string>>")
    return found.withColumn("touches", F.coalesce(in_window, empty)).drop("bucket")


def attribution(conversions: DataFrame, sessions: DataFrame, cfg: Config) -> DataFrame:
    """One row per conversion with its first and last touch; direct when there is none."""
    found = lookback_touchpoints(conversions, sessions, cfg).withColumns(
        {"_first": F.get("touches", F.lit(0)), "_last": F.try_element_at("touches", F.lit(-1))}
    )
    return found.select(
        "transaction_id",
        "client_id",
        "conversion_timestamp",
        "revenue",
        *_click("first"),
        *_click("last"),
        F.size("touches").alias("touchpoint_count"),
        F.coalesce(whole_days(F.col("_at"), F.col("_first.start_us")), F.lit(0))
        .cast("int").alias("days_to_convert"),
        F.to_date("conversion_timestamp").alias("conversion_date"),
    )


def _click(which: str) -> list[Column]:
    touch = F.col(f"_{which}")
    untouched = dict(zip(_PARTS, ("direct", "none", "", "Direct"), strict=True))
    return [
        F.when(touch.isNull(), untouched[p]).otherwise(touch[p]).alias(f"{which}_click_{p}")
        for p in _PARTS
    ]


def channel_summary(attributed: DataFrame) -> DataFrame:
    """Conversions and revenue per day and channel under both models, in one aggregation."""
    models = F.array(
        *[
            F.struct(F.lit(f"{m}_click").alias("model"), F.col(f"{m}_click_channel").alias("channel"))
            for m in ("first", "last")
        ]
    )
    return (
        attributed.select(
            "conversion_date", "transaction_id", "revenue", F.explode(models).alias("m")
        )
        .filter(F.col("conversion_date").isNotNull() & F.col("m.channel").isNotNull())
        .groupBy(
            F.col("conversion_date").alias("date"),
            F.col("m.channel").alias("channel"),
            F.col("m.model").alias("attribution_model"),
        )
        .agg(
            F.count("transaction_id").alias("conversions"),
            exact_sum(F.col("revenue")).alias("revenue"),
        )
        .select("date", "channel", "conversions", "revenue", "attribution_model")
    )


def linear_attribution(conversions: DataFrame, sessions: DataFrame, cfg: Config) -> DataFrame:
    """Revenue shared evenly over a conversion's touches, per day and channel."""
    found = lookback_touchpoints(conversions, sessions, cfg)
    shares = F.greatest(F.size("touches"), F.lit(1))
    channels = F.when(F.size("touches") == 0, F.array(F.lit("Direct"))).otherwise(
        F.transform("touches", lambda t: t["channel"])
    )
    touched = found.select(
        F.to_date("conversion_timestamp").alias("date"),
        F.explode(channels).alias("channel"),
        shares.alias("shares"),
        "revenue",
    ).filter(F.col("date").isNotNull())
    # Conversions of equally many touches are added up before they are divided, so no row is rounded.
    alike = touched.groupBy("date", "channel", "shares").agg(
        F.count("*").alias("n"), exact_sum(F.col("revenue")).alias("total")
    )
    return alike.groupBy("date", "channel").agg(
        F.sum(F.col("n") / F.col("shares")).alias("conversions"),
        F.sum(F.col("total") / F.col("shares")).alias("revenue"),
    )
