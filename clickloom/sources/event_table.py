"""A plain event table (id, time, user, type, value, props) seen as raw clickstream files.

The seven text columns are derived from the row's own values, one branch per form a real file
shows: tagged and untagged URLs, referrers of every kind, missing and malformed cells, repeated
transaction ids, and headers that change from some day on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# Plain SQL over `event_id`, `user_id`, `event_type`, `value`, `props`. {iso}, {plain} and {day}
# stand for the time as ISO text, as text without zone, and for the day of the month.
CLIENT_ID = """
CASE WHEN event_id % 37 = 0 THEN NULL
     WHEN event_id % 53 = 0 THEN ''
     WHEN {day} BETWEEN 20 AND 22 AND event_id % 4 = 0 THEN NULL
     ELSE 'c' || CAST(user_id AS {text}) END"""

PAGE_URL = """
CASE event_id % 16
 WHEN 0 THEN 'https://shop.example/p/' || CAST(event_id % 7 AS {text}) || '?gclid=g1&utm_campaign=brand+spring'
 WHEN 1 THEN 'https://shop.example/?utm_source=klaviyo&utm_medium=email&utm_campaign=news%20week'
 WHEN 2 THEN 'https://shop.example/?fbclid=f1'
 WHEN 3 THEN 'https://shop.example/?utm_source=Facebook&utm_medium=cpc&utm_campaign=a%2Bb#top'
 WHEN 4 THEN 'https://checkout.shop.example/step?gclid='
 WHEN 5 THEN 'http://other.example/x?utm_source=&utm_medium=cpc'
 WHEN 6 THEN 'https://shop.example/?utm_source=partner&utm_medium=affiliate'
 WHEN 7 THEN NULL
 WHEN 8 THEN 'https://shop.example/?utm_source=google&fbclid=z'
 WHEN 9 THEN 'https://shop.example/?utm_source=bing&utm_medium=Organic'
 WHEN 10 THEN 'https://shop.example/?gclid=a'
 ELSE 'https://shop.example/c/' || CAST(event_id % 5 AS {text}) END"""

REFERRER = """
CASE WHEN {day} >= 26 THEN NULL
     WHEN event_id % 11 = 0 THEN 'https://www.google.com/search?q=x'
     WHEN event_id % 11 = 1 THEN 'https://www.bing.com/'
     WHEN event_id % 11 = 2 THEN 'https://m.facebook.com/'
     WHEN event_id % 11 = 3 THEN 'https://shop.example/home'
     WHEN event_id % 11 = 4 THEN 'https://source-77.partner.example/'
     WHEN event_id % 11 = 5 THEN 'https://user@News.Example:8080/a?b'
     WHEN event_id % 11 = 6 THEN ''
     WHEN event_id % 11 = 7 THEN 'no-scheme.example/x'
     WHEN event_id % 11 = 8 THEN 'https://l.instagram.com/'
     ELSE NULL END"""

TIMESTAMP = """
CASE WHEN event_id % 997 = 0 THEN 'not-a-time'
     WHEN event_id % 499 = 0 THEN NULL
     WHEN event_id % 101 = 0 THEN {plain}
     ELSE {iso} END"""

EVENT_NAME = """
CASE WHEN {day} >= 18 AND event_id % 301 = 0 THEN 'bogus'
     WHEN {day} >= 18 AND event_id % 401 = 0 THEN NULL
     WHEN {day} = 24 AND event_id % 5 <> 0 THEN 'page_viewed'
     WHEN event_type = 'view' THEN 'page_viewed'
     WHEN event_type = 'click' THEN 'product_added_to_cart'
     WHEN event_type = 'signup' THEN 'email_filled_on_popup'
     WHEN event_type = 'error' THEN 'checkout_started'
     WHEN event_id % 9 = 0 THEN 'purchase'
     ELSE 'checkout_completed' END"""

TRANSACTION_ID = """
'T' || CAST(CASE WHEN {day} % 2 = 0 AND event_id % 20 < 8 THEN event_id - event_id % 40
                 WHEN event_id % 20 = 9 THEN event_id % 2000
                 ELSE event_id END AS {text})"""

EVENT_DATA = """
CASE WHEN event_type <> 'purchase' THEN
  CASE WHEN event_id % 83 = 0 THEN '{{"k": '
       WHEN event_id % 89 = 0 THEN ''
       WHEN event_id % 97 = 0 THEN props || ' x'
       WHEN event_id % 103 = 0 THEN NULL
       ELSE props END
 WHEN event_id % 23 = 6 THEN '[1, 2]'
 WHEN event_id % 23 = 7 THEN '{{"transaction_id": '
 ELSE '{{' ||
  CASE event_id % 23 WHEN 5 THEN '' WHEN 12 THEN '"transaction_id": "", '
       ELSE '"transaction_id": "' || {transaction_id} || '", ' END ||
  CASE event_id % 23 WHEN 0 THEN '"revenue": null, '
       WHEN 1 THEN '"revenue": "' || CAST(value AS {text}) || '", '
       WHEN 2 THEN '"revenue": "free", '
       WHEN 8 THEN '"revenue": 0, '
       WHEN 9 THEN '"revenue": -' || CAST(value AS {text}) || ', '
       WHEN 10 THEN ''
       ELSE '"revenue": ' || CAST(value AS {text}) || ', ' END ||
  CASE event_id % 23 WHEN 3 THEN '"items": null, '
       WHEN 11 THEN ''
       ELSE '"items": [{{"item_price": 1.5}}, ' ||
            CASE event_id % 5 WHEN 0 THEN '{{"item_price": null}}, {{"sku": "s"}}' ELSE '{{"item_price": 2}}' END || '], ' END ||
  CASE event_id % 23 WHEN 4 THEN '"user_email": null'
       ELSE '"user_email": "buyer' || CAST(user_id AS {text}) || '@mail.example"' END || '}}' END"""

USER_AGENT = """
CASE WHEN {day} = 17 THEN NULL ELSE CASE event_id % 13
 WHEN 0 THEN 'Mozilla/5.0 (iPad; CPU OS 16_0) Version/16.0 Safari/604.1'
 WHEN 1 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 16_0) Mobile Safari/604.1'
 WHEN 2 THEN 'Mozilla/5.0 (Linux; Android 13) Chrome/120.0 Mobile Safari/537.36'
 WHEN 3 THEN 'Mozilla/5.0 (Linux; Android 13; Tablet) Firefox/120.0'
 WHEN 4 THEN 'Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36 Edg/120.0'
 WHEN 5 THEN 'Mozilla/5.0 (Windows NT 10.0; rv:120.0) Gecko Firefox/120.0'
 WHEN 6 THEN NULL
 WHEN 7 THEN ''
 WHEN 8 THEN 'curl/8.0'
 WHEN 9 THEN 'Mozilla/5.0 (Macintosh) Version/16.0 Safari/605.1'
 ELSE 'Mozilla/5.0 (Windows NT 10.0) Chrome/120.0 Safari/537.36' END END"""

# The file of a row: its day, now and then the day before.
FILE_DAY = "CASE WHEN event_id % 211 = 0 THEN {day_before} ELSE {day_text} END"

# Header of a file by day of the month in its name.
HEADER = """
CASE WHEN {file_day} >= 26 THEN 'clientId,page_url,timestamp,event_name,event_data,user_agent'
     WHEN {file_day} = 17 THEN 'clientId,page_url,referrer,timestamp,event_name,event_data'
     WHEN {file_day} = 15 THEN 'clientId,page_url,referrer,timestamp,event_name,event_data,user_agent,debug'
     WHEN {file_day} >= 10 THEN 'clientId,page_url,referrer,timestamp,event_name,event_data,user_agent'
     ELSE 'client_id,page_url,referrer,timestamp,event_name,event_data,user_agent' END"""

RAW_TEXT = {
    "client_id": CLIENT_ID,
    "page_url": PAGE_URL,
    "referrer": REFERRER,
    "timestamp": TIMESTAMP,
    "event_name": EVENT_NAME,
    "event_data": EVENT_DATA,
    "user_agent": USER_AGENT,
}

_SPARK = {
    "text": "STRING",
    "day": "day(ts)",
    "iso": "date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss.SSS'Z'\")",
    "plain": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "day_text": "date_format(ts, 'yyyyMMdd')",
    "day_before": "date_format(ts - INTERVAL 1 DAY, 'yyyyMMdd')",
}
# Rows that share one value of `ingest_order.block`.
_BLOCK = 1 << 20


def raw_clickstream(spark: SparkSession, folder: str) -> DataFrame:
    """The `events` table as raw text events with `source_file` and `ingest_order`."""
    events = spark.read.parquet(f"{folder}/events.parquet")
    words = {**_SPARK, "transaction_id": TRANSACTION_ID.format(**_SPARK)}
    columns = [
        F.expr(sql.format(**words)).alias(name) for name, sql in RAW_TEXT.items()
    ]
    source = F.concat(F.lit("events_"), F.expr(FILE_DAY.format(**_SPARK)), F.lit(".csv"))
    return events.select(*columns, source.alias("source_file"), "event_id").select(
        "*",
        F.struct(
            F.col("source_file").alias("file"),
            F.expr(f"event_id div {_BLOCK}").alias("block"),
            F.col("event_id").alias("seq"),
        ).alias("ingest_order"),
    )


def raw_headers(raw: DataFrame) -> DataFrame:
    """The header of each file: the column names as its day spells them."""
    header = F.expr(HEADER.format(file_day="CAST(substr(source_file, 14, 2) AS INT)"))
    return raw.select("source_file").distinct().withColumn("columns", F.split(header, ","))
