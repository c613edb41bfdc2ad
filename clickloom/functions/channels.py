"""Traffic source and marketing channel. The two classifiers differ on purpose.

The one for the derived tables knows `Internal`; the one for monitoring sends own-domain
referrers to `Direct`, has `Organic Social` and lets `fbclid` win over UTM tags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config
from clickloom.functions.urls import authority, has_param, query_param, query_string

TRAFFIC_COLUMNS = ("traffic_source", "traffic_medium", "traffic_campaign", "marketing_channel")

# The rules of the two classifiers. The first rule that holds wins.
_TOUCH = """
CASE WHEN _gclid THEN named_struct('source', 'google', 'medium', 'cpc', 'campaign', coalesce(_campaign, 'google_ads'))
     WHEN _source IS NOT NULL THEN named_struct('source', _source, 'medium', _medium, 'campaign', coalesce(_campaign, ''))
     WHEN _fbclid THEN named_struct('source', 'facebook', 'medium', 'cpc', 'campaign', 'facebook_ads')
     WHEN contains(_host, 'google') THEN named_struct('source', 'google', 'medium', 'organic', 'campaign', '')
     WHEN contains(_host, 'bing') THEN named_struct('source', 'bing', 'medium', 'organic', 'campaign', '')
     WHEN contains(_host, 'facebook') THEN named_struct('source', 'facebook', 'medium', 'social', 'campaign', '')
     WHEN contains(_host, '{own}') THEN named_struct('source', 'internal', 'medium', 'internal', 'campaign', '')
     WHEN contains(_host, 'source-') THEN named_struct('source', 'affiliate', 'medium', 'referral', 'campaign', '')
     WHEN _host <> '' THEN named_struct('source', _host, 'medium', 'referral', 'campaign', '')
     ELSE named_struct('source', 'direct', 'medium', 'none', 'campaign', '') END"""

_PAID = "WHEN {medium} IN ('cpc', 'ppc', 'paid') THEN 'Paid Search'"
_SOCIAL = "WHEN {source} IN ('facebook', 'instagram') AND {medium} IN ('cpc', 'paid') THEN 'Paid Social'"
_CHANNEL = """
CASE {first} {second}
     WHEN {source} IN ('email', 'klaviyo') OR {medium} = 'email' THEN 'Email'
     WHEN {source} IN ('google', 'bing') AND {medium} = 'organic' THEN 'Organic Search'
     WHEN {source} = 'affiliate' OR {medium} = 'affiliate' THEN 'Affiliate'
     WHEN {medium} = 'referral' THEN 'Referral'
     WHEN {source} = 'direct' THEN 'Direct'
     WHEN {source} = 'internal' THEN 'Internal'
     ELSE 'Other' END"""

_MONITOR = """
CASE WHEN _gclid THEN 'Paid Search'
     WHEN _fbclid THEN 'Paid Social'
     WHEN _source IS NOT NULL THEN
       CASE WHEN lower(_medium) IN ('cpc', 'ppc', 'paid') THEN 'Paid Search'
            WHEN lower(_source) IN ('email', 'klaviyo') OR lower(_medium) = 'email' THEN 'Email'
            WHEN lower(_medium) = 'affiliate' THEN 'Affiliate'
            ELSE 'Other' END
     WHEN contains(_host, 'google') OR contains(_host, 'bing') THEN 'Organic Search'
     WHEN contains(_host, 'facebook') OR contains(_host, 'instagram') THEN 'Organic Social'
     WHEN contains(_host, 'source-') THEN 'Affiliate'
     WHEN _host <> '' AND NOT contains(_host, '{own}') THEN 'Referral'
     ELSE 'Direct' END"""

_HELPERS = ("_query", "_host", "_gclid", "_fbclid", "_source", "_medium", "_campaign")


def _quoted(text: str) -> str:
    """Text as it stands between the quotes of an SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def marketing_channel(source: str, medium: str, cfg: Config) -> Column:
    """Channel from two column names, case-insensitive."""
    words = {"source": f"lower({source})", "medium": f"lower({medium})"}
    paid, social = _PAID.format(**words), _SOCIAL.format(**words)
    first, second = (social, paid) if cfg.paid_social_first else (paid, social)
    return F.expr(_CHANNEL.format(first=first, second=second, **words))


def _with_parts(events: DataFrame) -> DataFrame:
    """Add what both classifiers read from the URL and the referrer."""
    query = F.col("_query")
    return events.withColumns(
        {
            "_query": F.coalesce(query_string(F.col("page_url")), F.lit("")),
            "_host": F.coalesce(authority(F.col("referrer")), F.lit("")),
        }
    ).withColumns(
        {
            "_gclid": has_param(query, "gclid"),
            "_fbclid": has_param(query, "fbclid"),
            "_source": query_param(query, "utm_source"),
            "_medium": F.coalesce(query_param(query, "utm_medium"), F.lit("")),
            "_campaign": query_param(query, "utm_campaign"),
        }
    )


def with_traffic_source(events: DataFrame, cfg: Config) -> DataFrame:
    """Add the four `TRAFFIC_COLUMNS` derived from `page_url` and `referrer`."""
    staged = _with_parts(events).withColumn("_touch", F.expr(_TOUCH.format(own=_quoted(cfg.own_domain))))
    return staged.withColumns(
        {
            "traffic_source": F.col("_touch.source"),
            "traffic_medium": F.expr("if(_touch.medium = '', 'none', _touch.medium)"),
            "traffic_campaign": F.col("_touch.campaign"),
            "marketing_channel": marketing_channel("_touch.source", "_touch.medium", cfg),
        }
    ).drop(*_HELPERS, "_touch")


def with_monitor_channel(events: DataFrame, cfg: Config) -> DataFrame:
    """Add `monitor_channel`, the classification used by the daily alerts."""
    channel = F.expr(_MONITOR.format(own=_quoted(cfg.own_domain)))
    return _with_parts(events).withColumn("monitor_channel", channel).drop(*_HELPERS)
