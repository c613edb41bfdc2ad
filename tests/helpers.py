from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession

COLUMNS = (
    "client_id string, page_url string, referrer string, timestamp string, event_name string, "
    "event_data string, user_agent string, source_file string, "
    "ingest_order struct<file:string,block:bigint,seq:bigint>"
)
DEFAULTS = {
    "client_id": "a",
    "page_url": "https://shop.example/",
    "referrer": None,
    "timestamp": "2025-03-01T10:00:00.000Z",
    "event_name": "page_viewed",
    "event_data": None,
    "user_agent": None,
    "source_file": "events_20250301.csv",
}


def raw(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Raw events from partial rows; the list order is the input order."""
    full = []
    for i, row in enumerate(rows):
        cells = {**DEFAULTS, **row}
        full.append((*[cells[c] for c in DEFAULTS], (cells["source_file"], 0, i)))
    return spark.createDataFrame(full, COLUMNS)


def purchase(transaction_id="t", revenue=10, **row) -> dict:
    data = {"transaction_id": transaction_id, "revenue": revenue, "items": [{"item_price": 1}], "user_email": "x@mail.example"}
    return {"event_name": "checkout_completed", "event_data": json.dumps(data), **row}


def rows(frame: DataFrame, *columns: str) -> list[tuple]:
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)
