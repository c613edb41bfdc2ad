"""Parts of a URL by pattern, so that malformed URLs never raise."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def query_string(url: Column) -> Column:
    """Text after the first `?` and before the first `#`; empty when there is none."""
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def decode(text: Column) -> Column:
    """Percent- and plus-decoding; a `%` without two hex digits stays as it is."""
    return F.try_url_decode(F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25"))


def query_param(query: Column, key: str) -> Column:
    """First non-blank value of `key` in a query string, decoded; null when absent."""
    raw = F.regexp_extract(query, rf"(?:^|&){key}=([^&]+)", 1)
    return decode(F.nullif(raw, F.lit("")))


def has_param(query: Column, key: str) -> Column:
    """Whether `key` has a non-blank value."""
    return F.coalesce(query.rlike(rf"(?:^|&){key}=[^&]"), F.lit(False))


def authority(url: Column) -> Column:
    """Lower-cased host part with user info and port; empty without `//`."""
    return F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))
