"""Fixed schemas and constants of the customer-history feed.

Everything here is a value the results depend on; operators take these as
defaults only, every one of them can be overridden by parameter.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# --- fixed values (must equal the upstream feed's conventions) -------------
# Business key and attribute names of the embedded customer profile.
CUSTOMER_KEY = "customer_id"
PROFILE_FIELDS = [
    "customer_id",
    "customer_name",
    "customer_address",
    "customer_city",
    "customer_state",
    "customer_zip",
    "customer_tier",
    "customer_email",
]
# Tracked attributes: a change in any of these opens a new version.
# customer_name is deliberately not tracked.
TRACKED_ATTRIBUTES = [
    "customer_address",
    "customer_city",
    "customer_state",
    "customer_zip",
    "customer_tier",
    "customer_email",
]
# Open end of a current version.
OPEN_END = _dt.date(3000, 12, 31)
OPEN_END_SQL = "3000-12-31"
# Daily file name: the date is captured from an unanchored search.
FILE_NAME_PATTERN = r"transactions_(\d{4}-\d{2}-\d{2})\.json"
# Raw timestamp text layout, e.g. 2025-01-01T13:45:10Z.
RAW_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
RAW_TS_REGEX = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$"
# Layout of zone-less timestamps in JSON files this library writes (keeps microseconds).
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
# Fact columns in load order.
FACT_COLUMNS = [
    "transaction_id",
    "transaction_timestamp",
    "transaction_date",
    "amount",
    "currency",
    "merchant_id",
    "merchant_category",
    "card_type",
    "transaction_status",
    "customer_id",
]
# Version bookkeeping columns appended to every dimension row.
START_COL = "effective_start_date"
END_COL = "effective_end_date"
CURRENT_COL = "is_current"
# ---------------------------------------------------------------------------

CUSTOMER_INFO_SCHEMA = T.StructType([T.StructField(f, T.StringType(), True) for f in PROFILE_FIELDS])

# Raw daily transaction line. `amount` arrives as number, quoted number or
# null, so it is declared as text and normalised afterwards; declaring the
# schema avoids the inference scan and per-file schema drift.
RAW_TRANSACTION_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType(), True),
        T.StructField("transaction_timestamp", T.StringType(), True),
        T.StructField("amount", T.StringType(), True),
        T.StructField("currency", T.StringType(), True),
        T.StructField("merchant_id", T.StringType(), True),
        T.StructField("merchant_category", T.StringType(), True),
        T.StructField("card_type", T.StringType(), True),
        T.StructField("transaction_status", T.StringType(), True),
        T.StructField("customer_info", CUSTOMER_INFO_SCHEMA, True),
    ]
)

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("file_name", T.StringType(), True),
        T.StructField("file_date", T.DateType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("rows", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("token", T.StringType(), True),
        T.StructField("number", T.LongType(), True),
        T.StructField("length", T.LongType(), True),
        T.StructField("modified", T.TimestampType(), True),
    ]
)

def with_corrupt_column(schema: T.StructType, name: str = "_corrupt") -> T.StructType:
    """Schema plus a text column that receives unparsable lines."""
    return T.StructType(list(schema.fields) + [T.StructField(name, T.StringType(), True)])
