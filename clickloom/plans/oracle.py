"""The named queries as plain SQL for an independent engine.

Written from the definitions, without the shortcuts of the operators: row-by-row windows,
range joins and grouped lists over the same derived clickstream.
"""

from __future__ import annotations

from clickloom.plans.registry import ALERT_QUERIES, CFG, HALF_HOUR
from clickloom.operators.quality import CHECKS
from clickloom.sources.event_table import FILE_DAY, HEADER, RAW_TEXT, TRANSACTION_ID

_WORDS = {
    "text": "VARCHAR",
    "day": "day(ts)",
    "iso": "strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ')",
    "plain": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
    "day_text": "strftime(ts, '%Y%m%d')",
    "day_before": "strftime(ts - INTERVAL 1 DAY, '%Y%m%d')",
}
_WORDS["transaction_id"] = TRANSACTION_ID.format(**_WORDS)

_ORDER = "source_file, event_id"
_EXPECTED = "['client_id','page_url','referrer','timestamp','event_name','event_data','user_agent']"


def _show(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%g')"


def _raw() -> str:
    columns = ", ".join(f"{sql.format(**_WORDS)} AS {name}" for name, sql in RAW_TEXT.items())
    return f"""raw AS MATERIALIZED (
  SELECT event_id, {columns}, 'events_' || {FILE_DAY.format(**_WORDS)} || '.csv' AS source_file FROM events)"""


_HEADERS = f"""headers AS (
  SELECT source_file, string_split({HEADER.format(file_day="CAST(substr(source_file, 14, 2) AS INT)")}, ',') AS columns
  FROM (SELECT DISTINCT source_file FROM raw))"""

_TIMED = r"""timed AS (
  SELECT *, CASE WHEN regexp_matches(timestamp, '^\d{4}-\d{2}-\d{2}')
                 THEN TRY_CAST(replace(replace(timestamp, 'T', ' '), 'Z', '') AS TIMESTAMP) END AS ets
  FROM raw)"""

# Parts of URLs, shared by both classifiers.
_PARTS = r"""parts AS MATERIALIZED (
  SELECT *, nullif(url_decode(replace(regexp_extract(q, '(?:^|&)utm_source=([^&]+)', 1), '+', ' ')), '') AS us,
         nullif(url_decode(replace(regexp_extract(q, '(?:^|&)utm_medium=([^&]+)', 1), '+', ' ')), '') AS um,
         nullif(url_decode(replace(regexp_extract(q, '(?:^|&)utm_campaign=([^&]+)', 1), '+', ' ')), '') AS uc,
         regexp_matches(q, '(^|&)gclid=[^&]') AS gclid, regexp_matches(q, '(^|&)fbclid=[^&]') AS fbclid
  FROM (SELECT *, coalesce(regexp_extract(page_url, '^[^?#]*\?([^#]*)', 1), '') AS q,
               coalesce(lower(regexp_extract(referrer, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)), '') AS host
        FROM timed))"""

_TRAFFIC = """traffic AS (
  SELECT *, CASE WHEN lower(m) IN ('cpc','ppc','paid') THEN 'Paid Search'
                 WHEN lower(s) IN ('email','klaviyo') OR lower(m) = 'email' THEN 'Email'
                 WHEN lower(s) IN ('google','bing') AND lower(m) = 'organic' THEN 'Organic Search'
                 WHEN lower(s) = 'affiliate' OR lower(m) = 'affiliate' THEN 'Affiliate'
                 WHEN lower(m) = 'referral' THEN 'Referral'
                 WHEN lower(s) = 'direct' THEN 'Direct'
                 WHEN lower(s) = 'internal' THEN 'Internal' ELSE 'Other' END AS marketing_channel,
         s AS traffic_source, CASE WHEN m = '' THEN 'none' ELSE m END AS traffic_medium, c AS traffic_campaign
  FROM (SELECT *,
    CASE WHEN gclid THEN 'google' WHEN us IS NOT NULL THEN us WHEN fbclid THEN 'facebook'
         WHEN contains(host,'google') THEN 'google' WHEN contains(host,'bing') THEN 'bing'
         WHEN contains(host,'facebook') THEN 'facebook' WHEN contains(host,'shop.example') THEN 'internal'
         WHEN contains(host,'source-') THEN 'affiliate' WHEN host <> '' THEN host ELSE 'direct' END AS s,
    CASE WHEN gclid THEN 'cpc' WHEN us IS NOT NULL THEN coalesce(um,'') WHEN fbclid THEN 'cpc'
         WHEN contains(host,'google') THEN 'organic' WHEN contains(host,'bing') THEN 'organic'
         WHEN contains(host,'facebook') THEN 'social' WHEN contains(host,'shop.example') THEN 'internal'
         WHEN contains(host,'source-') THEN 'referral' WHEN host <> '' THEN 'referral' ELSE 'none' END AS m,
    CASE WHEN gclid THEN coalesce(uc,'google_ads') WHEN us IS NOT NULL THEN coalesce(uc,'')
         WHEN fbclid THEN 'facebook_ads' ELSE '' END AS c
    FROM parts))"""

_MONITOR = """monitor AS (
  SELECT *, CASE WHEN gclid THEN 'Paid Search' WHEN fbclid THEN 'Paid Social'
    WHEN us IS NOT NULL THEN
      CASE WHEN lower(coalesce(um,'')) IN ('cpc','ppc','paid') THEN 'Paid Search'
           WHEN lower(us) IN ('email','klaviyo') OR lower(coalesce(um,'')) = 'email' THEN 'Email'
           WHEN lower(coalesce(um,'')) = 'affiliate' THEN 'Affiliate' ELSE 'Other' END
    WHEN contains(host,'google') OR contains(host,'bing') THEN 'Organic Search'
    WHEN contains(host,'facebook') OR contains(host,'instagram') THEN 'Organic Social'
    WHEN contains(host,'source-') THEN 'Affiliate'
    WHEN host <> '' AND NOT contains(host,'shop.example') THEN 'Referral' ELSE 'Direct' END AS monitor_channel
  FROM parts)"""


def _device(agent: str) -> str:
    return f"""CASE WHEN {agent} IS NULL THEN 'Unknown'
      WHEN regexp_matches(lower({agent}), 'ipad|tablet') THEN 'Tablet'
      WHEN regexp_matches(lower({agent}), 'mobile|iphone|android') THEN 'Mobile' ELSE 'Desktop' END"""


def _browser(agent: str) -> str:
    return f"""CASE WHEN {agent} IS NULL THEN 'Unknown'
      WHEN contains(lower({agent}),'chrome') AND NOT contains(lower({agent}),'edg') THEN 'Chrome'
      WHEN contains(lower({agent}),'safari') AND NOT contains(lower({agent}),'chrome') THEN 'Safari'
      WHEN contains(lower({agent}),'firefox') THEN 'Firefox'
      WHEN contains(lower({agent}),'edg') THEN 'Edge' ELSE 'Other' END"""


def _sessionized(gap_us: int) -> str:
    return f"""clean AS (
  SELECT * FROM traffic WHERE (timestamp IS NULL OR ets IS NOT NULL) AND client_id IS NOT NULL AND client_id <> ''),
stepped AS (
  SELECT *, row_number() OVER w AS n, epoch_us(ets) - epoch_us(lag(ets) OVER w) AS idle
  FROM clean WINDOW w AS (PARTITION BY client_id ORDER BY ets NULLS LAST, {_ORDER})),
enriched AS MATERIALIZED (
  SELECT *, client_id || '_' || CAST(sno AS VARCHAR) AS session_id, CAST(ets AS DATE) AS event_date
  FROM (SELECT *, CAST(sum(CASE WHEN idle IS NULL OR idle > {gap_us} THEN 1 ELSE 0 END)
        OVER (PARTITION BY client_id ORDER BY n ROWS UNBOUNDED PRECEDING) AS BIGINT) AS sno FROM stepped))"""


_SESSIONS = f"""sess AS MATERIALIZED (
  SELECT *, {_device('user_agent')} AS device_type, {_browser('user_agent')} AS browser
  FROM (SELECT session_id, client_id, sno, min(ets) AS session_start, max(ets) AS session_end,
    count(ets) AS event_count,
    arg_min(traffic_source, n) AS traffic_source, arg_min(traffic_medium, n) AS traffic_medium,
    arg_min(traffic_campaign, n) AS traffic_campaign, arg_min(marketing_channel, n) AS marketing_channel,
    arg_min(page_url, n) FILTER (page_url IS NOT NULL) AS landing_page,
    arg_min(referrer, n) FILTER (referrer IS NOT NULL) AS referrer,
    arg_min(user_agent, n) FILTER (user_agent IS NOT NULL) AS user_agent,
    CAST(min(ets) AS DATE) AS session_date,
    (epoch_us(max(ets)) - epoch_us(min(ets))) / 1000000.0::DOUBLE AS session_duration_seconds,
    coalesce(bool_or(event_name = 'product_added_to_cart'), false) AS has_add_to_cart,
    coalesce(bool_or(event_name = 'checkout_started'), false) AS has_checkout_started,
    coalesce(bool_or(event_name = 'checkout_completed'), false) AS has_purchase,
    coalesce(bool_or(event_name = 'email_filled_on_popup'), false) AS has_email_signup
    FROM enriched GROUP BY session_id, client_id, sno))"""

_SESSION_COLUMNS = f"""session_id, client_id, {_show('session_start')} AS session_start, {_show('session_end')} AS session_end,
  event_count, traffic_source, traffic_medium, traffic_campaign, marketing_channel, landing_page, referrer, user_agent,
  CAST(session_date AS VARCHAR) AS session_date, session_duration_seconds, has_add_to_cart, has_checkout_started,
  has_purchase, has_email_signup, device_type, browser"""


def _payload(source: str) -> str:
    """Payload fields of the purchase events in `source`."""
    return rf"""parsed AS MATERIALIZED (
  SELECT * EXCLUDE (j), j IS NOT NULL AND json_type(j) = 'OBJECT' AS is_object,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.transaction_id') END AS tid,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_type(j, '$.revenue') END AS rtype,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.revenue') END AS rtext,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_type(j, '$.items') END AS itype,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_array_length(j, '$.items') END AS ilen,
    CASE WHEN json_type(j) = 'OBJECT' THEN
      len(list_filter(json_extract(j, '$.items[*].item_price'), lambda x: json_type(x) = 'NULL')) END AS nulls_given,
    CASE WHEN json_type(j) = 'OBJECT' THEN len(json_extract(j, '$.items[*].item_price')) END AS prices_given,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_type(j, '$.user_email') END AS etype,
    CASE WHEN json_type(j) = 'OBJECT' THEN json_extract_string(j, '$.user_email') END AS email
  FROM (SELECT *, CASE WHEN json_valid(event_data) THEN event_data::JSON END AS j
        FROM {source} WHERE event_name IN ('checkout_completed', 'purchase'))),
paid AS MATERIALIZED (
  SELECT *, is_object AND tid IS NOT NULL AND tid <> '' AS has_tid,
    CASE WHEN NOT is_object THEN NULL WHEN rtype IS NULL THEN 0.0
         WHEN rtype = 'NULL' THEN NULL ELSE TRY_CAST(rtext AS DOUBLE) END AS rev,
    rtype IS NOT NULL AND rtype <> 'NULL' AS rev_given,
    CASE WHEN NOT is_object THEN NULL WHEN itype IS NULL THEN 0 WHEN itype = 'ARRAY' THEN ilen END AS icount,
    CASE WHEN itype = 'ARRAY' THEN (ilen - prices_given) + nulls_given ELSE 0 END AS unpriced,
    CASE WHEN NOT is_object THEN NULL WHEN etype IS NULL THEN '' WHEN etype = 'VARCHAR' THEN email END AS mail
  FROM parsed)"""


_RECORD = """record AS MATERIALIZED (
  SELECT *, CASE WHEN sound THEN tid END AS transaction_id,
    CASE WHEN sound THEN rev ELSE 0.0 END AS revenue, CAST(CASE WHEN sound THEN icount ELSE 0 END AS INTEGER) AS item_count,
    CASE WHEN NOT sound OR mail = '' THEN '' ELSE left(sha256(mail), 16) END AS user_email_hash
  FROM (SELECT *, rev IS NOT NULL AND icount IS NOT NULL AND mail IS NOT NULL AS sound
        FROM paid WHERE event_name = 'checkout_completed'))"""

_CONVERSIONS = f"""conv AS MATERIALIZED (
  SELECT * FROM record
  QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY client_id, ets NULLS LAST, {_ORDER}) = 1)"""


def _touches(lookback_us: int) -> str:
    return f"""touched AS MATERIALIZED (
  SELECT c.event_id, c.transaction_id, c.client_id, c.ets, c.revenue, s.session_id AS sid, s.session_start,
    s.traffic_source, s.traffic_medium, s.traffic_campaign, s.marketing_channel
  FROM conv c LEFT JOIN sess s ON s.client_id = c.client_id AND s.marketing_channel <> 'Internal'
   AND epoch_us(s.session_start) BETWEEN epoch_us(c.ets) - {lookback_us} AND epoch_us(c.ets)),
attributed AS MATERIALIZED (
  SELECT event_id, any_value(transaction_id) AS transaction_id, any_value(client_id) AS client_id, any_value(ets) AS ets,
    any_value(revenue) AS revenue,
    {', '.join(f"coalesce({f}({col}, session_start), '{default}') AS {name}_click_{part}"
               for f, name in (('arg_min', 'first'), ('arg_max', 'last'))
               for col, part, default in (('traffic_source', 'source', 'direct'), ('traffic_medium', 'medium', 'none'),
                                          ('traffic_campaign', 'campaign', ''), ('marketing_channel', 'channel', 'Direct')))},
    CAST(count(sid) AS INTEGER) AS touchpoint_count,
    CAST(coalesce(floor((epoch_us(any_value(ets)) - epoch_us(min(session_start))) / 86400000000.0), 0) AS INTEGER) AS days_to_convert,
    CAST(any_value(ets) AS DATE) AS conversion_date
  FROM touched GROUP BY event_id)"""


_SUMMARY = """summary AS MATERIALIZED (
  SELECT conversion_date AS date, channel, count(transaction_id) AS conversions,
    CAST(sum(CAST(revenue AS DECIMAL(28,6))) AS DOUBLE) AS revenue, attribution_model
  FROM (SELECT *, first_click_channel AS channel, 'first_click' AS attribution_model FROM attributed
        UNION ALL SELECT *, last_click_channel, 'last_click' FROM attributed)
  WHERE conversion_date IS NOT NULL GROUP BY conversion_date, channel, attribution_model)"""

_JOURNEYS = """journeys AS MATERIALIZED (
  SELECT s.client_id, count(*) AS total_sessions, CAST(sum(event_count) AS BIGINT) AS total_pageviews,
    CAST(floor((epoch_us(any_value(f.ets)) - epoch_us(min(session_start))) / 86400000000.0) AS BIGINT) AS days_from_first_visit,
    count(DISTINCT s.marketing_channel) AS channels_touched,
    array_to_string(list_slice(list(s.marketing_channel ORDER BY s.sno), -5, -1), ' > ') AS channel_path,
    count(DISTINCT device_type) AS devices_used, true AS converted, any_value(f.revenue) AS revenue
  FROM sess s JOIN (SELECT * FROM conv QUALIFY row_number() OVER
     (PARTITION BY client_id ORDER BY ets NULLS LAST, source_file, event_id) = 1) f ON f.client_id = s.client_id
  GROUP BY s.client_id)"""

_CLICKS = [_raw(), _TIMED, _PARTS, _TRAFFIC]
_SESSION_CHAIN = [*_CLICKS, _sessionized(CFG.gap_us), _SESSIONS]
_CONV_CHAIN = [*_SESSION_CHAIN, _payload("enriched"), _RECORD, _CONVERSIONS]
_ATTR_CHAIN = [*_CONV_CHAIN, _touches(CFG.lookback_us)]
_HALF_CHAIN = [*_CLICKS, _sessionized(HALF_HOUR.gap_us), _SESSIONS]

# --- data quality ---------------------------------------------------------------------

_Q = CFG.quality
_QUALITY = rf"""flags AS MATERIALIZED (
  SELECT *, client_id IS NULL OR client_id = '' AS null_client,
    coalesce(NOT regexp_matches(timestamp, '^\d{{4}}-\d{{2}}-\d{{2}}T\d{{2}}:\d{{2}}:\d{{2}}\.\d{{3}}Z$'), false) AS bad_time,
    coalesce(NOT starts_with(timestamp, substr(source_file,8,4) || '-' || substr(source_file,12,2) || '-' || substr(source_file,14,2)), false) AS wrong_date,
    coalesce(event_name NOT IN ('page_viewed','email_filled_on_popup','product_added_to_cart','checkout_started','checkout_completed','purchase'), true) AS bad_event,
    coalesce(NOT regexp_matches(page_url, '^https://(shop\.example|checkout\.shop\.example)'), false) AS bad_url,
    coalesce(event_data <> '' AND NOT json_valid(event_data), false) AS bad_json
  FROM raw),
counted AS (
  SELECT source_file, count(*) AS total_rows, count(*) FILTER (WHERE null_client) AS null_clients, count(*) FILTER (WHERE bad_time) AS bad_timestamps,
    count(*) FILTER (WHERE wrong_date) AS wrong_dates, count(*) FILTER (WHERE bad_event) AS bad_events, count(*) FILTER (WHERE bad_url) AS bad_urls,
    count(*) FILTER (WHERE bad_json) AS bad_json, count(*) FILTER (WHERE event_name = 'checkout_completed') AS completed_rows
  FROM flags GROUP BY source_file),
paid_counts AS (
  SELECT source_file, count(*) AS purchase_rows, count(*) FILTER (WHERE rev_given AND rev = 0) AS zero_revenue,
    count(*) FILTER (WHERE rev_given AND rev < 0) AS negative_revenue, count(*) FILTER (WHERE is_object AND NOT has_tid) AS missing_transaction_id,
    CAST(coalesce(sum(unpriced) FILTER (is_object AND (NOT rev_given OR rev IS NOT NULL)), 0) AS BIGINT) AS null_item_prices,
    count(*) FILTER (WHERE NOT is_object OR (rev_given AND rev IS NULL) OR icount IS NULL) AS unreadable_payloads,
    CAST(coalesce(sum(CAST(rev AS DECIMAL(28,6))) FILTER (event_name = 'checkout_completed'), 0) AS DOUBLE) AS revenue
  FROM paid GROUP BY source_file),
dup AS (
  SELECT source_file, tid AS transaction_id, count(*) AS occurrences FROM paid WHERE has_tid
  GROUP BY source_file, tid HAVING count(*) > 1),
funnel AS (
  SELECT source_file, count(*) AS purchasers, count(*) FILTER (WHERE NOT viewed) AS orphans FROM (
    SELECT source_file, client_id, coalesce(bool_or(event_name = 'page_viewed'), false) AS viewed,
      coalesce(bool_or(event_name = 'checkout_completed'), false) AS bought
    FROM raw WHERE client_id IS NOT NULL GROUP BY source_file, client_id) WHERE bought GROUP BY source_file),
profile AS MATERIALIZED (
  SELECT h.source_file, h.columns, substr(h.source_file, 8, 8) AS file_date, coalesce(total_rows, 0) AS total_rows,
    null_clients, bad_timestamps, wrong_dates, bad_events, bad_urls, bad_json, completed_rows,
    {', '.join(f"coalesce({c}, 0) AS {c}" for c in ('purchase_rows', 'zero_revenue', 'negative_revenue', 'missing_transaction_id', 'null_item_prices', 'unreadable_payloads', 'purchasers', 'orphans'))},
    coalesce(p.revenue, 0.0) AS revenue,
    CAST(coalesce((SELECT sum(occurrences) FROM dup d WHERE d.source_file = h.source_file), 0) AS BIGINT) AS duplicate_rows,
    list_filter({_EXPECTED}, lambda x: NOT list_contains(list_transform(h.columns, lambda c: replace(lower(c), 'clientid', 'client_id')), x)) AS missing
  FROM headers h LEFT JOIN counted USING (source_file) LEFT JOIN paid_counts p USING (source_file) LEFT JOIN funnel USING (source_file))"""

_ORPHAN_RATE = "CASE WHEN purchasers = 0 THEN 0.0 ELSE orphans / purchasers END"
_FAULTS = "(zero_revenue + negative_revenue + missing_transaction_id + null_item_prices)"
_CHECK_SQL = {
    "required_columns": ("len(missing) = 0", "'CRITICAL'", "0"),
    "client_id_completeness": (f"null_clients / total_rows <= {_Q.max_null_client_rate}", "'CRITICAL'", "null_clients"),
    "timestamp_format": ("bad_timestamps = 0", "'HIGH'", "bad_timestamps"),
    "timestamp_partition": ("wrong_dates = 0", "'HIGH'", "wrong_dates"),
    "event_names": ("bad_events = 0", "'CRITICAL'", "bad_events"),
    "url_domain": ("bad_urls = 0", "'MEDIUM'", "bad_urls"),
    "event_data_json": ("bad_json = 0", "'HIGH'", "bad_json"),
    "purchases": (f"{_FAULTS} = 0", "CASE WHEN purchase_rows = 0 THEN 'MEDIUM' ELSE 'HIGH' END",
                  f"CASE WHEN {_FAULTS} > 0 THEN purchase_rows ELSE 0 END"),
    "duplicates": ("duplicate_rows = 0", "'CRITICAL'", "duplicate_rows"),
    "volume": (f"total_rows BETWEEN {_Q.min_daily_events} AND {_Q.max_daily_events}",
               f"CASE WHEN total_rows > {_Q.max_daily_events} THEN 'MEDIUM' ELSE 'HIGH' END", "0"),
    "funnel": (f"{_ORPHAN_RATE} <= {_Q.max_orphan_rate}", "'MEDIUM'",
               f"CASE WHEN {_ORPHAN_RATE} > {_Q.max_orphan_rate} THEN orphans ELSE 0 END"),
    "referrer": ("list_contains(columns, 'referrer')", "'CRITICAL'", "0"),
}


def _results() -> str:
    rows = [
        f"""SELECT source_file, file_date, total_rows, {i} AS check_number, '{check}' AS check_name, {severity} AS severity,
  {ok} AS passed, CAST({affected} AS BIGINT) AS affected_rows FROM profile"""
        for i, (check, (ok, severity, affected)) in enumerate(_CHECK_SQL.items(), start=1)
    ]
    return f"results AS MATERIALIZED ({' UNION ALL '.join(rows)})"


_RESULT_COLUMNS = """SELECT *, check_name || CASE WHEN passed THEN ' ok' ELSE ' failed' END || ' (' || affected_rows || ' rows)' AS message,
  round(CASE WHEN total_rows = 0 THEN 0.0 ELSE affected_rows / total_rows END, 6) AS failure_rate FROM results"""
_DETAIL_SQL = {
    "required_columns": {
        "missing": "array_to_string(missing, ',')",
        "extra": f"array_to_string(list_filter(list_transform(columns, lambda c: replace(lower(c), 'clientid', 'client_id')), lambda x: NOT list_contains({_EXPECTED}, x)), ',')",
    },
    "client_id_completeness": {"null_rate": "null_clients / total_rows", "threshold": str(_Q.max_null_client_rate)},
    "timestamp_partition": {"expected_date": "file_date"},
    "purchases": {c: c for c in ("zero_revenue", "negative_revenue", "missing_transaction_id", "null_item_prices", "unreadable_payloads")},
    "volume": {"min": str(_Q.min_daily_events), "max": str(_Q.max_daily_events)},
    "funnel": {"orphans": "orphans", "purchasers": "purchasers"},
    "referrer": {"columns": "array_to_string(columns, ',')"},
}
_SAMPLED = {"timestamp_format": ("bad_time", "timestamp", 5), "timestamp_partition": ("wrong_date", "timestamp", 5),
            "url_domain": ("bad_url", "page_url", 5), "event_data_json": ("bad_json", "left(event_data, 100)", 3)}
_DETAILS = "detail AS (" + " UNION ALL ".join([
    *[f"SELECT source_file, '{check}' AS check_name, '{key}' AS key, CAST({value} AS VARCHAR) AS value FROM profile"
      for check, pairs in _DETAIL_SQL.items() for key, value in pairs.items()],
    *[f"""SELECT source_file, '{check}', 'samples', string_agg({value}, ' | ' ORDER BY event_id) FROM (
        SELECT * FROM flags WHERE {test} QUALIFY row_number() OVER (PARTITION BY source_file ORDER BY event_id) <= {size}) GROUP BY source_file"""
      for check, (test, value, size) in _SAMPLED.items()]]) + ")"
_VERDICTS = """verdicts AS (
  SELECT source_file, bool_and(passed OR severity <> 'CRITICAL') AS passed,
    coalesce(string_agg(check_name, ',' ORDER BY check_number) FILTER (NOT passed AND severity = 'CRITICAL'), '') AS critical_issues,
    coalesce(string_agg(check_name, ',' ORDER BY check_number) FILTER (NOT passed AND severity = 'HIGH'), '') AS high_issues
  FROM results GROUP BY source_file)"""
_DAILY = """daily AS MATERIALIZED (
  SELECT source_file, file_date AS date, total_rows AS total_events, completed_rows AS purchases, revenue,
    null_clients / total_rows AS null_client_rate, list_contains(columns, 'referrer') AS has_referrer FROM profile)"""

_DQ_CHAIN = [_raw(), _HEADERS, _payload("raw"), _QUALITY, _results(), _VERDICTS, _DAILY]
_PAID_CHAIN = [_raw(), _payload("raw")]

# --- monitoring -----------------------------------------------------------------------

_M = CFG.monitor
_DAYS = f"""visits AS MATERIALIZED (
  SELECT source_file, client_id, client_id || '_1' AS session_id,
    coalesce(bool_or(event_name = 'product_added_to_cart'), false) AS has_add_to_cart,
    coalesce(bool_or(event_name = 'checkout_started'), false) AS has_checkout_started,
    coalesce(bool_or(event_name = 'checkout_completed'), false) AS has_purchase,
    arg_min(monitor_channel, event_id) AS marketing_channel
  FROM monitor WHERE client_id IS NOT NULL AND client_id <> '' GROUP BY source_file, client_id),
bought AS MATERIALIZED (
  SELECT source_file, tid AS transaction_id, rev AS revenue FROM paid WHERE event_name = 'checkout_completed' AND rev IS NOT NULL),
shares AS MATERIALIZED (
  SELECT source_file, marketing_channel, count(*) AS sessions, count(*) / sum(count(*)) OVER (PARTITION BY source_file) AS share
  FROM visits GROUP BY source_file, marketing_channel),
history AS MATERIALIZED (
  SELECT r.source_file, count(*) AS events, count(*) FILTER (WHERE r.event_name = 'checkout_completed') AS conversions,
    CAST(coalesce(sum(CAST(p.rev AS DECIMAL(28,6))) FILTER (r.event_name = 'checkout_completed'), 0) AS DOUBLE) AS revenue
  FROM raw r LEFT JOIN paid p ON p.event_id = r.event_id GROUP BY r.source_file),
metrics AS MATERIALIZED (
  SELECT source_file, 'events' AS metric, events::DOUBLE AS value FROM history
  UNION ALL SELECT source_file, 'conversions', conversions FROM history
  UNION ALL SELECT source_file, 'revenue', revenue FROM history
  UNION ALL SELECT source_file, 'aov', CASE WHEN conversions = 0 THEN 0 ELSE revenue / conversions END FROM history),
baseline AS MATERIALIZED (
  SELECT metric, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max
  FROM metrics WHERE source_file IN (SELECT source_file FROM history ORDER BY source_file LIMIT {_M.baseline_days})
  GROUP BY metric HAVING count(*) >= {_M.baseline_days}),
days AS MATERIALIZED (
  SELECT e.*, coalesce(b.n, 0) AS conversions, coalesce(b.total, 0.0) AS revenue, coalesce(b.surplus, 0) AS duplicates,
    CASE WHEN b.n > 0 THEN b.total / b.n END AS aov, v.*EXCLUDE (source_file), x.* EXCLUDE (source_file),
    list_filter({_EXPECTED}, lambda c: c <> 'referrer' AND NOT list_contains(list_transform(h.columns, lambda n: CASE WHEN n = 'clientId' THEN 'client_id' ELSE n END), c)) AS absent,
    CASE WHEN list_contains(h.columns, 'debug') THEN 1 ELSE 0 END AS debug,
    (SELECT mean FROM baseline WHERE metric = 'revenue') AS revenue_mean, (SELECT std FROM baseline WHERE metric = 'revenue') AS revenue_std,
    (SELECT mean FROM baseline WHERE metric = 'aov') AS aov_mean, (SELECT std FROM baseline WHERE metric = 'aov') AS aov_std
  FROM (SELECT source_file, count(*) AS events, avg(CASE WHEN client_id IS NULL OR client_id = '' THEN 1.0 ELSE 0.0 END) AS null_client_rate,
          coalesce(bool_or(referrer <> ''), false) AS has_referrer_data FROM raw GROUP BY source_file) e
  LEFT JOIN (SELECT source_file, count(*) AS n, CAST(sum(CAST(revenue AS DECIMAL(28,6))) AS DOUBLE) AS total,
          count(*) - count(DISTINCT transaction_id) - max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END) AS surplus
        FROM bought GROUP BY source_file) b ON b.source_file = e.source_file
  LEFT JOIN (SELECT source_file, avg(has_add_to_cart::INT) AS cart, avg(has_checkout_started::INT) AS checkout,
          avg(has_purchase::INT) AS paid_rate FROM visits GROUP BY source_file) v ON v.source_file = e.source_file
  LEFT JOIN (SELECT source_file, max(share) AS top_share, count(*) AS n_channels,
          bool_or(marketing_channel = 'Direct') AND bool_or(marketing_channel = 'Paid Search') AS core_seen
        FROM shares GROUP BY source_file) x ON x.source_file = e.source_file
  JOIN headers h ON h.source_file = e.source_file),
scored AS MATERIALIZED (
  SELECT *, CASE WHEN revenue_std > 0 THEN (revenue - revenue_mean) / revenue_std ELSE 0 END AS revenue_z,
    CASE WHEN aov IS NULL THEN NULL WHEN aov_std > 0 THEN (aov - aov_mean) / aov_std ELSE 0 END AS aov_z FROM days)"""

_ALERT_SQL = [
    ("low_event_volume", "CRITICAL", "daily_event_count", f"events < {_M.min_daily_events}", "events", f"{_M.min_daily_events}"),
    ("high_event_volume", "WARNING", "daily_event_count", f"events > {_M.max_daily_events}", "events", f"{_M.max_daily_events}"),
    ("null_client_rate", "CRITICAL", "null_client_rate", f"null_client_rate > {_M.max_null_client_rate}", "null_client_rate", f"{_M.max_null_client_rate}"),
    ("schema_change", "CRITICAL", "schema_columns", "len(absent) > 0", "7 - len(absent) + debug", "7"),
    ("low_revenue", "CRITICAL", "daily_revenue", f"revenue < {_M.min_daily_revenue}", "revenue", f"{_M.min_daily_revenue}"),
    ("revenue_anomaly", "WARNING", "daily_revenue", f"abs(revenue_z) > {_M.revenue_z}", "revenue", "revenue_mean"),
    ("low_conversions", "CRITICAL", "daily_conversions", f"conversions < {_M.min_daily_conversions}", "conversions", f"{_M.min_daily_conversions}"),
    ("aov_anomaly", "WARNING", "aov", f"abs(aov_z) > {_M.aov_z}", "aov", "aov_mean"),
    ("duplicate_transactions", "CRITICAL", "duplicate_transactions", f"duplicates > {_M.max_duplicate_transactions}", "duplicates", f"{_M.max_duplicate_transactions}"),
    ("funnel_inverted", "WARNING", "funnel_integrity", "paid_rate > checkout", "paid_rate", "checkout"),
    ("zero_conversions", "CRITICAL", "purchase_rate", "cart > 0 AND paid_rate = 0", "0", f"{_M.zero_conversion_floor}"),
    ("traffic_concentration", "WARNING", "channel_concentration", f"top_share > {_M.max_channel_share}", "top_share", f"{_M.max_channel_share}"),
    ("missing_channel", "WARNING", "channel_coverage", "NOT core_seen", "n_channels", "CASE WHEN has_referrer_data THEN 3 ELSE 2 END"),
]
_ALERTS = "found AS MATERIALIZED (" + " UNION ALL ".join(
    f"""SELECT source_file, {i} AS alert_number, '{name}' AS name, '{severity}' AS severity, '{metric}' AS metric_name,
  round(CAST({value} AS DOUBLE), 4) AS current_value, round(CAST({limit} AS DOUBLE), 4) AS threshold FROM scored WHERE {rule}"""
    for i, (name, severity, metric, rule, value, limit) in enumerate(_ALERT_SQL, start=1)
) + ")"
_METRICS = " UNION ALL ".join(
    f"""SELECT source_file, '{name}' AS metric_name, round(CAST({value} AS DOUBLE), 4) AS current_value,
  {f"round({base}_mean, 4)" if base else "NULL::DOUBLE"} AS historical_avg, {f"round({base}_std, 4)" if base else "NULL::DOUBLE"} AS historical_std,
  {f"round({base}_z, 4)" if base else "NULL::DOUBLE"} AS z_score, {f"abs({base}_z) > {limit}" if base else "false"} AS is_anomaly
  FROM scored WHERE {value} IS NOT NULL"""
    for name, value, base, limit in (
        ("daily_event_count", "events", "", 0), ("null_client_rate", "null_client_rate", "", 0),
        ("daily_revenue", "revenue", "revenue", _M.revenue_z), ("daily_conversions", "conversions", "", 0),
        ("average_order_value", "aov", "aov", _M.aov_z), ("duplicate_transactions", "duplicates", "", 0),
    )
)
_MON_CHAIN = [_raw(), _HEADERS, _TIMED, _PARTS, _MONITOR, _payload("raw"), _DAYS, _ALERTS]


def _with(chain: list[str], select: str) -> str:
    return "WITH " + ",\n".join(chain) + "\n" + select


def _pct(part: str, whole: str) -> str:
    return f"round(CASE WHEN {whole} = 0 THEN 0.0 ELSE {part} / {whole} END * 100, 4)"


def oracle_sql() -> dict[str, str]:
    money = "CAST(sum(CAST(revenue AS DECIMAL(28,6))) AS DOUBLE)"
    sql = {
        "ingest_daily_files": _with([_raw()], f"""SELECT source_file,
  CASE WHEN CAST(substr(source_file, 14, 2) AS INT) >= 26 THEN '' WHEN referrer <> '' THEN referrer END AS referrer,
  {', '.join(f"nullif({c}, '') AS {c}" for c in ('client_id', 'page_url', 'timestamp', 'event_name', 'event_data', 'user_agent'))} FROM raw"""),
        "normalise_schema": _with([_raw()], f"""SELECT source_file, event_id, CASE WHEN client_id <> '' THEN client_id END AS client_id,
  CASE WHEN CAST(substr(source_file, 14, 2) AS INT) >= 26 THEN '' WHEN referrer <> '' THEN referrer END AS referrer,
  event_name, regexp_extract(source_file, '([0-9]{{8}})', 1) AS file_date FROM raw"""),
        "parse_event_time": _with([_raw(), _TIMED], f"""SELECT event_id, timestamp, {_show('ets')} AS event_timestamp,
  CAST(CAST(ets AS DATE) AS VARCHAR) AS event_date, timestamp IS NULL OR ets IS NOT NULL AS readable FROM timed"""),
        "drop_null_clients": _with([_raw()], "SELECT event_id, client_id FROM raw WHERE client_id <> ''"),
        "null_rate": _with(_DQ_CHAIN, """SELECT source_file, total_rows, null_clients,
  round(null_clients / total_rows, 6) AS null_rate FROM profile"""),
        "url_parts": r"""WITH q AS (SELECT page_id, url, regexp_extract(url, '^[^?#]*\?([^#]*)', 1) AS query FROM pages)
SELECT page_id, query, nullif(url_decode(replace(regexp_extract(query, '(?:^|&)utm_source=([^&]+)', 1), '+', ' ')), '') AS utm_source,
  nullif(url_decode(replace(regexp_extract(query, '(?:^|&)page=([^&]+)', 1), '+', ' ')), '') AS page,
  regexp_matches(query, '(^|&)ref=[^&]') AS has_ref,
  lower(regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)) AS authority,
  url_decode(replace(regexp_extract(url, '^[^?#]*'), '+', ' ')) AS path FROM q""",
        "traffic_source": _with(_CLICKS, "SELECT event_id, traffic_source, traffic_medium, traffic_campaign FROM traffic"),
        "marketing_channel": _with(_CLICKS, """SELECT marketing_channel, traffic_source, traffic_medium, count(*) AS events
  FROM traffic GROUP BY marketing_channel, traffic_source, traffic_medium"""),
        "monitor_channel": _with([_raw(), _TIMED, _PARTS, _MONITOR], "SELECT event_id, monitor_channel FROM monitor"),
        "device_type": _with([_raw()], f"SELECT event_id, {_device('user_agent')} AS device_type FROM raw"),
        "browser": _with([_raw()], f"SELECT event_id, {_browser('user_agent')} AS browser FROM raw"),
        "json_validity": _with([_raw()], "SELECT event_id, json_valid(event_data) AS valid FROM raw WHERE event_data <> ''"),
        "purchase_payload": _with([*_PAID_CHAIN, _RECORD], "SELECT event_id, transaction_id, revenue, item_count, user_email_hash FROM record"),
        "sessionize": _with(_HALF_CHAIN, "SELECT event_id, session_id FROM enriched"),
        "events_enriched": _with(_SESSION_CHAIN, f"""SELECT client_id, page_url, referrer, timestamp, event_name, event_data, user_agent,
  source_file, {_show('ets')} AS event_timestamp, CAST(event_date AS VARCHAR) AS event_date, traffic_source, traffic_medium,
  traffic_campaign, marketing_channel, session_id FROM enriched"""),
        "sessions": _with(_SESSION_CHAIN, f"SELECT {_SESSION_COLUMNS} FROM sess"),
        "sessions_half_hour": _with(_HALF_CHAIN, f"""SELECT session_id, {_show('session_start')} AS session_start,
  {_show('session_end')} AS session_end, event_count, landing_page FROM sess"""),
        "incremental_sessions": _with(_SESSION_CHAIN, f"""SELECT {_SESSION_COLUMNS} FROM sess WHERE client_id IN
  (SELECT client_id FROM enriched WHERE event_date >= DATE '2024-01-16')"""),
        "incremental_run": _with(_SESSION_CHAIN, f"SELECT {_SESSION_COLUMNS} FROM sess"),
        "incremental_history": _with(_SESSION_CHAIN, """SELECT 1::BIGINT AS version,
  (SELECT count(DISTINCT source_file) FROM raw WHERE source_file NOT IN ('events_20240127.csv', 'events_20240130.csv')
     AND (source_file <> 'events_20240112.csv' OR event_id % 2 = 0)) AS days,
  count(DISTINCT client_id) FILTER (source_file NOT IN ('events_20240127.csv', 'events_20240130.csv')
     AND (source_file <> 'events_20240112.csv' OR event_id % 2 = 0)) AS clients FROM enriched
  UNION ALL SELECT 2, (SELECT count(DISTINCT source_file) FROM raw WHERE source_file IN
     ('events_20240127.csv', 'events_20240130.csv', 'events_20240112.csv')),
  count(DISTINCT client_id) FILTER (source_file IN ('events_20240127.csv', 'events_20240130.csv', 'events_20240112.csv')) FROM enriched"""),
        "conversions": _with(_CONV_CHAIN, f"""SELECT transaction_id, client_id, session_id, {_show('ets')} AS conversion_timestamp,
  CAST(event_date AS VARCHAR) AS event_date, revenue, item_count, user_email_hash, traffic_source, traffic_medium, traffic_campaign,
  marketing_channel, page_url FROM conv"""),
        "lookback_touchpoints": _with(_ATTR_CHAIN, """SELECT any_value(transaction_id) AS transaction_id, CAST(count(sid) AS INTEGER) AS touches,
  coalesce(string_agg(marketing_channel, ',' ORDER BY session_start) FILTER (sid IS NOT NULL), '') AS channels,
  min(epoch_us(session_start)) AS first_start_us FROM touched GROUP BY event_id"""),
        "attribution": _with(_ATTR_CHAIN, f"""SELECT * EXCLUDE (event_id, ets, conversion_date), {_show('ets')} AS conversion_timestamp,
  CAST(conversion_date AS VARCHAR) AS conversion_date FROM attributed"""),
        "linear_attribution": _with(_ATTR_CHAIN, """SELECT CAST(CAST(ets AS DATE) AS VARCHAR) AS date, channel,
  round(sum(1::DOUBLE / n), 6) AS conversions, round(sum(revenue / n), 6) AS revenue
  FROM (SELECT ets, revenue, coalesce(marketing_channel, 'Direct') AS channel, count(*) OVER (PARTITION BY event_id) AS n FROM touched)
  WHERE ets IS NOT NULL GROUP BY CAST(ets AS DATE), channel"""),
        "channel_summary": _with([*_ATTR_CHAIN, _SUMMARY], """SELECT CAST(date AS VARCHAR) AS date, channel, conversions, revenue,
  attribution_model FROM summary"""),
        "journey_sessions": _with(_CONV_CHAIN, f"""SELECT client_id, session_id, {_show('session_start')} AS session_start, marketing_channel
  FROM sess WHERE client_id IN (SELECT client_id FROM conv)"""),
        "user_journeys": _with([*_CONV_CHAIN, _JOURNEYS], "SELECT * FROM journeys"),
        "repeat_journeys": _with(_CONV_CHAIN, f"""SELECT c.transaction_id, c.client_id, {_show('c.ets')} AS conversion_timestamp,
  row_number() OVER (PARTITION BY c.client_id ORDER BY c.ets, c.source_file, c.event_id) AS conversion_number, c.sno AS sessions_so_far,
  CAST(floor((epoch_us(c.ets) - epoch_us(f.start)) / 86400000000.0) AS BIGINT) AS days_from_first_visit, c.revenue
  FROM conv c JOIN (SELECT client_id, min(session_start) AS start FROM sess GROUP BY client_id) f ON f.client_id = c.client_id
  WHERE c.ets IS NOT NULL"""),
        "reconciliation": _with([*_CONV_CHAIN, f"""f AS (SELECT (SELECT count(*) FROM raw) AS raw_n,
  (SELECT count(*) FROM timed WHERE timestamp IS NOT NULL AND ets IS NULL) AS rejected,
  (SELECT count(*) FROM timed WHERE (timestamp IS NULL OR ets IS NOT NULL) AND coalesce(client_id, '') = '') AS nobody, (SELECT count(*) FROM enriched) AS n,
  (SELECT count(session_id) FROM enriched) AS placed, (SELECT count(DISTINCT client_id) FROM enriched) AS clients,
  (SELECT count(*) FROM raw WHERE event_name = 'checkout_completed') AS raw_bought, (SELECT count(*) FROM conv) AS orders,
  (SELECT {money} FROM conv) AS revenue, (SELECT count(*) FROM sess) AS visits,
  (SELECT CAST(sum(TRY_CAST(json_extract_string(j, '$.revenue') AS DECIMAL(28,6))) AS DOUBLE) FROM
     (SELECT CASE WHEN json_valid(event_data) THEN event_data::JSON END AS j FROM raw WHERE event_name = 'checkout_completed')
   WHERE json_type(j) = 'OBJECT') AS raw_revenue)"""],
  """SELECT check_number, check_name, round(original::DOUBLE, 4) AS original, round(transformed::DOUBLE, 4) AS transformed,
  round(note::DOUBLE, 4) AS note, passed FROM (
  SELECT 1 AS check_number, 'event_count' AS check_name, raw_n::DOUBLE AS original, n::DOUBLE AS transformed, (raw_n - n)::DOUBLE AS note, true AS passed FROM f
  UNION ALL SELECT 2, 'events_sessionized', n, placed, n - placed, n = placed FROM f
  UNION ALL SELECT 3, 'conversion_count', raw_bought, orders, raw_bought - orders, orders <= raw_bought FROM f
  UNION ALL SELECT 4, 'revenue_total', raw_revenue, revenue, round(raw_revenue - revenue, 2), true FROM f
  UNION ALL SELECT 5, 'attribution_coverage', orders, orders, 100.0, true FROM f
  UNION ALL SELECT 6, 'sessions_per_client', clients, visits, round(visits / clients, 4), visits >= clients FROM f
  UNION ALL SELECT 7, 'rows_accounted_for', raw_n, n + nobody + rejected, rejected, raw_n = n + nobody + rejected FROM f)"""),
        # data quality
        "daily_metrics": _with(_DQ_CHAIN, "SELECT * REPLACE (round(null_client_rate, 6) AS null_client_rate) FROM daily"),
        "duplicate_transactions": _with(_DQ_CHAIN, "SELECT * FROM dup"),
        "cross_file_duplicates": _with(_PAID_CHAIN, """SELECT tid AS transaction_id, count(*) AS occurrences FROM paid
  WHERE has_tid GROUP BY tid HAVING count(*) > 1"""),
        "duplicate_occurrences": _with(_PAID_CHAIN, """SELECT tid AS transaction_id, count(*) OVER (PARTITION BY tid) AS occurrences,
  source_file, TRY_CAST(rtext AS DOUBLE) AS revenue, timestamp FROM paid WHERE has_tid QUALIFY occurrences > 1"""),
        "transactions": _with(_PAID_CHAIN, """SELECT source_file, tid AS transaction_id, TRY_CAST(rtext AS DOUBLE) AS revenue, timestamp
  FROM paid WHERE is_object"""),
        "orphan_purchasers": _with([_raw()], """SELECT source_file, client_id FROM raw WHERE event_name = 'checkout_completed' AND client_id IS NOT NULL
  EXCEPT SELECT source_file, client_id FROM raw WHERE event_name = 'page_viewed'"""),
        "purchase_payload_counters": _with(_DQ_CHAIN, """SELECT source_file, purchase_rows, zero_revenue, negative_revenue,
  missing_transaction_id, null_item_prices, unreadable_payloads FROM profile"""),
        "invalid_event_names": _with(_DQ_CHAIN, "SELECT source_file, event_name, count(*) AS events FROM flags WHERE bad_event GROUP BY source_file, event_name"),
        "offending_samples": _with(_DQ_CHAIN, " UNION ALL ".join(
            f"""SELECT source_file, CAST(place AS INTEGER) AS place, left(v, {length}) AS value, '{check}' AS check_name FROM (
  SELECT source_file, {column} AS v, row_number() OVER (PARTITION BY source_file ORDER BY event_id) AS place FROM flags WHERE {test})
  WHERE place <= {size}""" for column, test, check, size, length in
            (("timestamp", "bad_time", "timestamp_format", _Q.sample_size, 9999), ("page_url", "bad_url", "url_domain", _Q.sample_size, 9999),
             ("timestamp", "wrong_date", "timestamp_partition", _Q.sample_size, 9999),
             ("event_data", "bad_json", "event_data_json", _Q.payload_sample_size, 100)))),
        "rejects": _with([_raw(), _TIMED], """SELECT event_id, source_file, timestamp, 'unreadable_time' AS reason FROM timed
  WHERE timestamp IS NOT NULL AND ets IS NULL"""),
        "file_headers": _with([_raw()], """SELECT source_file, CASE WHEN day < 10 THEN 'client_id,page_url,referrer' WHEN day < 26 THEN 'clientId,page_url,referrer'
  ELSE 'clientId,page_url' END || ',timestamp,event_name,event_data,user_agent' AS columns
  FROM (SELECT DISTINCT source_file, CAST(substr(source_file, 14, 2) AS INT) AS day FROM raw)"""),
        "dq_results": _with(_DQ_CHAIN, _RESULT_COLUMNS),
        "dq_details": _with([*_DQ_CHAIN, _DETAILS], """SELECT source_file, check_name, key, round(TRY_CAST(value AS DOUBLE), 6) AS number,
  CASE WHEN TRY_CAST(value AS DOUBLE) IS NULL THEN value END AS text FROM detail WHERE value IS NOT NULL"""),
        "dq_file_verdict": _with(_DQ_CHAIN, "SELECT * FROM verdicts"),
        "dq_batch_totals": _with(_DQ_CHAIN, """SELECT count(*) AS files, CAST(count(*) FILTER (WHERE passed) AS BIGINT) AS passed_files,
  CAST(count(*) FILTER (WHERE NOT passed) AS BIGINT) AS failed_files FROM verdicts"""),
        "trend_anomalies": _with([*_DQ_CHAIN, """moved AS (SELECT *, lag(null_client_rate) OVER w AS last_rate, lag(revenue) OVER w AS last_revenue,
  lag(has_referrer) OVER w AS last_referrer FROM daily WINDOW w AS (ORDER BY source_file))"""], f"""
  SELECT source_file, date, 'null_client_spike' AS anomaly, round(last_rate, 4) AS previous_value, round(null_client_rate, 4) AS current_value
  FROM moved WHERE null_client_rate > last_rate * {_Q.null_spike_factor} AND null_client_rate > {_Q.max_null_client_rate}
  UNION ALL SELECT source_file, date, 'revenue_drop', round(last_revenue, 4), round(revenue, 4) FROM moved
  WHERE last_revenue > 0 AND revenue < last_revenue * {_Q.revenue_drop_factor}
  UNION ALL SELECT source_file, date, 'referrer_missing', 1.0, 0.0 FROM moved WHERE last_referrer AND NOT has_referrer"""),
        "schema_changes": _with([_raw(), _HEADERS, "h2 AS (SELECT *, lag(columns) OVER (ORDER BY source_file) AS last_columns FROM headers)"],
  """SELECT source_file, added, removed FROM (SELECT source_file,
  array_to_string(list_sort(list_filter(columns, lambda x: NOT list_contains(last_columns, x))), ',') AS added,
  array_to_string(list_sort(list_filter(last_columns, lambda x: NOT list_contains(columns, x))), ',') AS removed
  FROM h2 WHERE last_columns IS NOT NULL) WHERE added <> '' OR removed <> ''"""),
        "purchase_rate_band": _with(_DQ_CHAIN, f"""SELECT source_file, round(purchases / total_events, 6) AS purchase_rate,
  purchases / total_events BETWEEN {_Q.min_purchase_rate} AND {_Q.max_purchase_rate} AS in_band FROM daily"""),
        "null_rate_vs_history": _with(_DQ_CHAIN, f"""SELECT source_file, round(null_client_rate, 6) AS null_client_rate,
  round(a, 6) AS past_average, coalesce(null_client_rate > a * {_Q.history_spike_factor}, false) AS spike FROM (SELECT *, avg(null_client_rate)
  OVER (ORDER BY source_file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS a FROM daily)"""),
        "quarantine_split": _with(_DQ_CHAIN, """SELECT r.source_file, CASE WHEN v.passed THEN 'kept' ELSE 'quarantined' END AS state, count(*) AS events
  FROM raw r JOIN verdicts v ON v.source_file = r.source_file GROUP BY r.source_file, v.passed"""),
        # monitoring
        "daily_conversions": _with(_MON_CHAIN, "SELECT * FROM bought"),
        "daily_client_sessions": _with(_MON_CHAIN, "SELECT * FROM visits"),
        "channel_share": _with(_MON_CHAIN, "SELECT source_file, marketing_channel, sessions, round(share, 6) AS share FROM shares"),
        "funnel_rates": _with(_MON_CHAIN, """SELECT source_file, count(*) AS sessions, round(avg(has_add_to_cart::INT), 6) AS add_to_cart_rate,
  round(avg(has_checkout_started::INT), 6) AS checkout_rate, round(avg(has_purchase::INT), 6) AS purchase_rate FROM visits GROUP BY source_file"""),
        "surplus_duplicates": _with(_MON_CHAIN, """SELECT source_file, CAST(count(*) - count(DISTINCT transaction_id)
  - max(CASE WHEN transaction_id IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS duplicates FROM bought GROUP BY source_file"""),
        "history_metrics": _with(_MON_CHAIN, """SELECT *, round(CASE WHEN conversions = 0 THEN 0.0 ELSE revenue / conversions END, 6) AS aov FROM history"""),
        "baseline_days": _with(_MON_CHAIN, f"SELECT source_file, events FROM history ORDER BY source_file LIMIT {_M.baseline_days}"),
        "baseline_stats": _with(_MON_CHAIN, """SELECT metric, round(mean, 4) AS mean, round(std, 4) AS std, round(min, 4) AS min,
  round(max, 4) AS max FROM baseline"""),
        "rolling_baseline": _with(_MON_CHAIN, f"""SELECT source_file, metric, round(value, 4) AS value, round(mean, 4) AS mean, round(std, 4) AS std
  FROM (SELECT *, avg(value) OVER w AS mean, stddev_samp(value) OVER w AS std, count(*) OVER w AS n FROM metrics
  WINDOW w AS (PARTITION BY metric ORDER BY source_file ROWS BETWEEN {_M.baseline_days} PRECEDING AND 1 PRECEDING)) WHERE n >= {_M.baseline_days}"""),
        "metric_zscores": _with(_MON_CHAIN, f"""SELECT source_file, metric, round(value, 4) AS value, round(mean, 4) AS mean, round(std, 4) AS std,
  round(z, 4) AS z_score, abs(z) > CASE metric WHEN 'events' THEN {_M.events_z} WHEN 'conversions' THEN {_M.conversions_z}
  WHEN 'revenue' THEN {_M.revenue_z} ELSE {_M.aov_z} END AS is_anomaly
  FROM (SELECT m.source_file, m.metric, value, mean, std, CASE WHEN std > 0 THEN (value - mean) / std ELSE 0 END AS z
        FROM metrics m JOIN baseline b ON b.metric = m.metric)"""),
        "revenue_zscore": _with(_MON_CHAIN, f"""SELECT source_file, round(revenue, 4) AS current_value, round(revenue_z, 4) AS z_score,
  abs(revenue_z) > {_M.revenue_z} AS is_anomaly FROM scored"""),
        "aov_zscore": _with(_MON_CHAIN, f"""SELECT source_file, round(aov, 4) AS current_value, round(aov_z, 4) AS z_score,
  abs(aov_z) > {_M.aov_z} AS is_anomaly FROM scored WHERE aov IS NOT NULL"""),
        "metric_results": _with(_MON_CHAIN, _METRICS),
        "alerts": _with(_MON_CHAIN, "SELECT * FROM found"),
        "alert_counts": _with(_MON_CHAIN, "SELECT source_file, severity, count(*) AS alerts FROM found GROUP BY source_file, severity"),
        "critical_verdict": _with(_MON_CHAIN, """SELECT source_file, source_file IN
  (SELECT source_file FROM found WHERE severity = 'CRITICAL') AS critical FROM days"""),
        "incremental_moments": _with(_MON_CHAIN, """SELECT metric, count(*) AS days, round(avg(value), 4) AS mean,
  round(stddev_samp(value), 4) AS std FROM metrics GROUP BY metric"""),
        "counts_in_flight": _with([*_ATTR_CHAIN, _SUMMARY, _JOURNEYS], " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS observed, count(*) AS in_footers FROM {source}" for name, source in (
                ("events_enriched", "enriched"), ("sessions", "sess"), ("conversions", "conv"), ("attribution", "attributed"),
                ("channel_summary", "summary"), ("user_journeys", "journeys")))),
        "ordered_export": _with(_SESSION_CHAIN, """SELECT CAST(session_date AS VARCHAR) AS session_date, count(*) AS sessions,
  true AS in_order FROM sess GROUP BY session_date"""),
        "written_alerts": _with(_MON_CHAIN, """SELECT source_file, count(*) FILTER (name IS NOT NULL) AS alerts,
  1::BIGINT AS runs FROM days LEFT JOIN found USING (source_file) GROUP BY source_file"""),
        # reports
        "kpi_summary": _with(_CONV_CHAIN, f"""SELECT {money} AS revenue, count(*) AS orders, round({money} / count(*), 4) AS aov,
  (SELECT round(count(*) FILTER (WHERE has_purchase) / count(*) * 100, 4) FROM sess) AS session_conversion_pct FROM conv"""),
        "channel_efficiency": _with(_ATTR_CHAIN, f"""SELECT last_click_channel AS channel, count(*) AS conversions, {money} AS revenue,
  round({money} / count(*), 4) AS aov FROM attributed GROUP BY last_click_channel"""),
        "revenue_share": _with(_ATTR_CHAIN, f"""SELECT last_click_channel AS channel, {money} AS revenue,
  round({money} / (SELECT {money} FROM attributed) * 100, 4) AS revenue_pct FROM attributed GROUP BY last_click_channel"""),
        "attribution_shift": _with([*_ATTR_CHAIN, _SUMMARY], """SELECT channel, f AS first_click_revenue, l AS last_click_revenue,
  CASE WHEN f <> 0 THEN round((l / f - 1) * 100, 4) END AS change_pct FROM (SELECT channel,
  CAST(coalesce(sum(CAST(revenue AS DECIMAL(28,6))) FILTER (attribution_model = 'first_click'), 0) AS DOUBLE) AS f,
  CAST(coalesce(sum(CAST(revenue AS DECIMAL(28,6))) FILTER (attribution_model = 'last_click'), 0) AS DOUBLE) AS l FROM summary GROUP BY channel)"""),
        "funnel_report": _with([*_SESSION_CHAIN, """steps AS (
  SELECT 1 AS step_number, 'sessions' AS step, count(*) AS sessions FROM sess
  UNION ALL SELECT 2, 'add_to_cart', count(*) FILTER (WHERE has_add_to_cart) FROM sess
  UNION ALL SELECT 3, 'checkout_started', count(*) FILTER (WHERE has_checkout_started) FROM sess
  UNION ALL SELECT 4, 'purchase', count(*) FILTER (WHERE has_purchase) FROM sess)"""], """SELECT step_number, step, CAST(sessions AS BIGINT) AS sessions,
  round(sessions / first_value(sessions) OVER (ORDER BY step_number) * 100, 4) AS pct_of_sessions,
  round(100 - sessions / lag(sessions) OVER (ORDER BY step_number) * 100, 4) AS drop_off_pct FROM steps"""),
        "journey_averages": _with([*_CONV_CHAIN, _JOURNEYS], """SELECT round(avg(total_sessions), 4) AS avg_sessions,
  round(avg(days_from_first_visit), 4) AS avg_days, round(avg(channels_touched), 4) AS avg_channels FROM journeys"""),
        "device_conversion": _with(_SESSION_CHAIN, f"""SELECT device_type, count(*) AS sessions, CAST(count(*) FILTER (WHERE has_purchase) AS BIGINT) AS conversions,
  {_pct('count(*) FILTER (WHERE has_purchase)', 'count(*)')} AS conversion_rate_pct,
  round(count(*) FILTER (WHERE has_purchase) / (SELECT count(*) FILTER (WHERE has_purchase) FROM sess) * 100, 4) AS conversion_share_pct FROM sess GROUP BY device_type"""),
        "weekend_conversion": _with(_SESSION_CHAIN, f"""SELECT CASE WHEN isodow(session_date) >= 6 THEN 'weekend' ELSE 'weekday' END AS day_kind,
  count(*) AS sessions, CAST(count(*) FILTER (WHERE has_purchase) AS BIGINT) AS conversions, {_pct('count(*) FILTER (WHERE has_purchase)', 'count(*)')} AS conversion_rate_pct
  FROM sess WHERE session_date IS NOT NULL GROUP BY 1"""),
        "duplicate_revenue": _with([*_CONV_CHAIN, """every AS (SELECT CAST(sum(TRY_CAST(json_extract_string(j, '$.revenue') AS DECIMAL(28,6))) AS DOUBLE) AS r
  FROM (SELECT CASE WHEN json_valid(event_data) THEN event_data::JSON END AS j FROM raw WHERE event_name = 'checkout_completed')
  WHERE json_type(j) = 'OBJECT')"""], f"""SELECT r AS raw_revenue, k AS deduplicated_revenue, round(r - k, 2) AS overstated
  FROM every, (SELECT {money} AS k FROM conv)"""),
        "daily_trend": _with(_CONV_CHAIN, f"""SELECT CAST(event_date AS VARCHAR) AS date, count(*) AS conversions, {money} AS revenue
  FROM conv WHERE event_date IS NOT NULL GROUP BY event_date"""),
    }
    # Stored day by day or computed at once: the answers are the same.
    sql |= {f"incremental_{new}": sql[old] for new, old in (("validation", "dq_results"), ("duplicates", "cross_file_duplicates"), ("alerts", "alerts"),
                                                      ("rolling_baseline", "rolling_baseline"), ("null_rates", "null_rate_vs_history"))}
    for check in CHECKS:
        sql[f"dq_{check}"] = _with(_DQ_CHAIN, f"{_RESULT_COLUMNS} WHERE check_name = '{check}'")
    for name, alerts in ALERT_QUERIES.items():
        listed = ", ".join(f"'{a}'" for a in alerts)
        sql[name] = _with(_MON_CHAIN, f"SELECT * FROM found WHERE name IN ({listed})")
    return sql
