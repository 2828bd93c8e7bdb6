"""Schemas of the record, the envelope and the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the upstream record layout) -------------------
# The 13 positional fields of a sale record, in order, separated by "^":
RECORD_FIELDS = (
    "time",
    "url",
    "product_id",
    "name",
    "keyword",
    "rank",
    "current_price",
    "original_price",
    "sales_count",
    "shipping_address",
    "shop_id",
    "comments_count",
    "shop_name",
)
FIELD_SEPARATOR = "^"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
COMPACT_TIME_FORMAT = "yyyyMMdd-HH:mm:ss"
# --- end of fixed values ----------------------------------------------------

N_FIELDS = len(RECORD_FIELDS)

#: What a topic source yields (the Kafka source's columns, key dropped).
ENVELOPE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("value", T.StringType()),
])

#: Amounts are exact decimals; they are cast to double only when served.
PRICE_TYPE = "decimal(18,2)"
DELTA_TYPE = "decimal(28,2)"

#: Parsed, validated sale (the "slim" record plus carried extras).
VALID_SALE_COLUMNS = ("time", "product_id", "name", "price", "shop_id", "shop_name")

#: Quarantine reasons.
BAD_ARITY = "bad_arity"
BAD_PRICE = "bad_price"

#: Measure names used as keys in the delta log.
M_TOTAL = "total"
M_SHOP = "shop"
M_TREND = "trend"
TOTAL_KEY = "*"

DELTA_LOG = T.StructType([
    T.StructField("measure", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("delta", T.DecimalType(28, 2)),
    T.StructField("stream_id", T.StringType()),
    T.StructField("batch_id", T.LongType()),
])
