"""One immutable configuration shared by every operator."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from datetime import timedelta

# Text cells read as missing (the public pandas CSV reader defaults).
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# The columns and event names of the clickstream format.
EXPECTED_COLUMNS = (
    "client_id", "page_url", "referrer", "timestamp", "event_name", "event_data", "user_agent",
)
EVENT_NAMES = (
    "page_viewed", "email_filled_on_popup", "product_added_to_cart", "checkout_started",
    "checkout_completed", "purchase",
)


@dataclass(frozen=True)
class QualityLimits:
    """Bounds of the per-file data-quality checks."""

    max_null_client_rate: float = 0.05
    min_daily_events: int = 1000
    max_daily_events: int = 10000
    max_orphan_rate: float = 0.5
    min_purchase_rate: float = 0.003
    max_purchase_rate: float = 0.02
    null_spike_factor: float = 3.0
    revenue_drop_factor: float = 0.3
    history_spike_factor: float = 2.0
    sample_size: int = 5
    payload_sample_size: int = 3


@dataclass(frozen=True)
class MonitorLimits:
    """Bounds of the daily monitoring alerts."""

    min_daily_events: int = 2000
    max_daily_events: int = 8000
    min_daily_conversions: int = 10
    min_daily_revenue: float = 10000.0
    max_null_client_rate: float = 0.05
    max_duplicate_transactions: int = 0
    revenue_z: float = 2.5
    conversions_z: float = 2.5
    events_z: float = 3.0
    aov_z: float = 2.0
    max_channel_share: float = 0.8
    zero_conversion_floor: float = 0.001
    baseline_days: int = 7


@dataclass(frozen=True)
class Config:
    """Names, windows and limits. All brand-specific literals live here."""

    own_domain: str = "shop.example"
    checkout_domain: str = "checkout.shop.example"

    expected_columns: tuple[str, ...] = EXPECTED_COLUMNS
    valid_events: tuple[str, ...] = EVENT_NAMES
    page_view_event: str = "page_viewed"
    cart_event: str = "product_added_to_cart"
    checkout_event: str = "checkout_started"
    conversion_event: str = "checkout_completed"
    email_event: str = "email_filled_on_popup"
    purchase_events: tuple[str, ...] = ("checkout_completed", "purchase")
    null_tokens: tuple[str, ...] = NULL_TOKENS

    session_gap: timedelta = timedelta(minutes=30)
    lookback: timedelta = timedelta(days=7)
    path_length: int = 5

    # "client": the duplicate with the lowest (client, time) wins; "time": the earliest one.
    dedupe_order: str = "client"
    # "sha256": 16 hex digits of the digest; "prefix": the first 16 characters as they are.
    email_output: str = "sha256"
    # Let paid clicks from social networks be Paid Social instead of Paid Search.
    paid_social_first: bool = False
    # Daily files may hold line breaks inside quoted cells; such files are not split.
    multi_line: bool = False

    quality: QualityLimits = field(default_factory=QualityLimits)
    monitor: MonitorLimits = field(default_factory=MonitorLimits)

    @property
    def gap_us(self) -> int:
        return self.session_gap // timedelta(microseconds=1)

    @property
    def lookback_us(self) -> int:
        return self.lookback // timedelta(microseconds=1)

    @property
    def url_pattern(self) -> str:
        domains = "|".join(re.escape(d) for d in (self.own_domain, self.checkout_domain))
        return f"^https://({domains})"
