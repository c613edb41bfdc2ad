"""The JSON payload of an event: validity and the fields of a purchase.

Each field is read as VARIANT, which keeps "absent", "null" and the JSON type apart, so one
parse answers every question the checks and tables ask of a purchase.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from clickloom.config import Config

_STRICT = {"allowSingleQuotes": "false"}
_FIELDS = "transaction_id variant, revenue variant, items variant, user_email variant"
# Decimal text as a number parser reads it: digits may be grouped by single underscores.
_NUMBER = r"^\s*[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?\s*$"
_SPECIAL = r"(?i)^\s*[+-]?(nan|inf|infinity)\s*$"


_PARTS = {
    "_id_type": "schema_of_variant(_json.transaction_id)",
    "_id_text": "try_variant_get(_json.transaction_id, '$', 'string')",
    "_revenue_type": "schema_of_variant(_json.revenue)",
    "_revenue_text": "try_variant_get(_json.revenue, '$', 'string')",
    "_items_type": "schema_of_variant(_json.items)",
    "_items": "try_variant_get(_json.items, '$', 'array<variant>')",
    "_email_type": "schema_of_variant(_json.user_email)",
}
_PAYLOAD = """
named_struct(
  'is_object', _object IS NOT NULL,
  'transaction_id', _id_text,
  'has_transaction', coalesce(CASE _id_type WHEN 'STRING' THEN _id_text <> ''
      ELSE _id_text NOT IN ('0', '0.0', 'false', '[]', '{}') END, false),
  'revenue_given', coalesce(_revenue_type <> 'VOID', false),
  'revenue', CASE WHEN _object IS NULL THEN NULL
      WHEN _revenue_type IS NULL THEN 0D
      WHEN _revenue_type = 'STRING' THEN _revenue_number
      WHEN _revenue_type = 'BOOLEAN' THEN if(_revenue_text = 'true', 1D, 0D)
      ELSE try_cast(_revenue_text AS DOUBLE) END,
  'revenue_text', _revenue_text,
  'item_count', CASE WHEN _object IS NULL THEN NULL
      WHEN _items_type IS NULL THEN 0
      WHEN _items IS NOT NULL THEN size(_items)
      WHEN _items_type = 'STRING' THEN length(try_variant_get(_json.items, '$', 'string'))
      WHEN startswith(_items_type, 'OBJECT')
        THEN size(try_variant_get(_json.items, '$', 'map<string,variant>')) END,
  'null_item_prices', coalesce(array_size(filter(_items, item ->
      startswith(schema_of_variant(item), 'OBJECT')
      AND (try_variant_get(item, '$.item_price', 'variant') IS NULL
           OR is_variant_null(try_variant_get(item, '$.item_price', 'variant'))))), 0),
  'user_email', CASE WHEN _object IS NULL THEN NULL
      WHEN _email_type IS NULL THEN ''
      WHEN _email_type = 'STRING' THEN try_variant_get(_json.user_email, '$', 'string') END)"""


def is_json(text: Column) -> Column:
    """Whether `text` is exactly one JSON value; null stays null.

    The text is parsed as the only element of an array, which rejects trailing text. Text
    that could close that array by itself must also parse as the only member of an object.
    """
    as_item = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>", _STRICT)
    as_member = F.from_json(F.concat(F.lit('{"v":'), text, F.lit("}")), "struct<v:variant>", _STRICT)
    one_item = F.coalesce(F.size(as_item) == 1, F.lit(False))
    one_member = F.coalesce(as_member["v"].isNotNull(), F.lit(False))
    return F.when(text.isNotNull(), one_item & (~text.contains("]") | one_member))


def to_number(text: Column) -> Column:
    """Double from decimal text, null when it is not a number."""
    plain = F.replace(F.trim(text), F.lit("_"), F.lit(""))
    special = F.lower(F.trim(text))
    return F.when(text.rlike(_NUMBER), plain.try_cast("double")).when(
        text.rlike(_SPECIAL),
        F.when(special.contains("nan"), F.lit(float("nan")))
        .when(special.startswith("-"), F.lit(float("-inf")))
        .otherwise(F.lit(float("inf"))),
    )


def with_payload(events: DataFrame, cfg: Config) -> DataFrame:
    """Add `payload`, the fields of a purchase event; null for all other events.

    is_object          the text is a JSON object
    transaction_id     as text, null when absent or null
    has_transaction    the id is present and not empty, zero or false
    revenue_given      a revenue other than null is present
    revenue            the number, 0 when the key is absent, null when it is no number
    revenue_text       the value as text
    item_count         length of `items`, 0 when the key is absent, null when it has none
    null_item_prices   items that are objects without a price
    user_email         '' when the key is absent, null when it is no string
    """
    purchase = F.col("event_name").isin(*cfg.purchase_events)
    text = F.col("_text")
    staged = events.withColumn("_text", F.when(purchase, F.col("event_data"))).withColumn(
        "_object", F.when(is_json(text) & text.rlike(r"^\s*\{"), text)
    )
    staged = staged.withColumn("_json", F.from_json("_object", _FIELDS, _STRICT)).withColumns(
        {name: F.expr(sql) for name, sql in _PARTS.items()}
    )
    staged = staged.withColumn("_revenue_number", to_number(F.col("_revenue_text")))
    # Exploding one element keeps a row a row, but stops filters on the payload from being
    # pushed below it, where the parsing would be repeated for every use of a field.
    one = F.array(F.when(purchase, F.expr(_PAYLOAD)))
    return staged.select(*events.columns, F.explode(one).alias("payload"))


def email_output(email: Column, cfg: Config) -> Column:
    """What the tables show of an address: a digest, or the raw prefix where configured."""
    if cfg.email_output == "prefix":
        return F.left(email, F.lit(16))
    return F.when(email == "", "").otherwise(F.left(F.sha2(email, 256), F.lit(16)))
