"""The data contract: canonical schema, source layouts, fixed values and thresholds."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: the canonical transaction, in contract order -------------
CANONICAL_SCHEMA = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("channel", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("currency", T.StringType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("location", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("terminal_id", T.StringType()),
        T.StructField("card_last4", T.StringType()),
        T.StructField("card_type", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("authorization_code", T.StringType()),
        T.StructField("response_code", T.StringType()),
        T.StructField("response_time_seconds", T.DoubleType()),
        T.StructField("is_fraud", T.BooleanType()),
        T.StructField("raw_source_data", T.MapType(T.StringType(), T.StringType())),
    ]
)
CANONICAL_FIELDS = tuple(CANONICAL_SCHEMA.names)
REQUIRED_FIELDS = ("transaction_id", "customer_id", "channel", "amount", "currency", "timestamp")
CHANNELS = ("POS", "ATM", "ONLINE_BANKING")

# --- fixed values: columns each source file must bring ----------------------
POS_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "timestamp", "location",
    "merchant_id", "card_last4", "card_type", "payment_method", "authorization_code",
    "response_code",
)
ATM_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "timestamp", "terminal_id",
    "card_last4", "card_type", "transaction_type", "response_code",
)
ONLINE_COLUMNS = (
    "transaction_id", "customer_id", "amount", "currency", "timestamp", "merchant_id",
    "card_last4", "card_type", "merchant_category", "channel", "transaction_status",
)

# --- fixed values: cell texts -----------------------------------------------
# Empty-cell markers, compared after stripping and lower-casing.
MISSING_TEXT = ("", "nan", "nat", "none", "null", "na", "n/a", "-")
# Cells a CSV reader turns into nulls, compared as they stand.
READER_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TRUE_TEXT = ("1", "true", "t", "yes", "y")
FALSE_TEXT = ("0", "false", "f", "no", "n")
CSV_BOOLEANS = ("True", "TRUE", "true", "False", "FALSE", "false")
CURRENCY_SIGNS = "$€£¥"
# Every character Unicode treats as white space when stripping text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# --- fixed values: analysis thresholds ---------------------------------------
TARGET = "fraud_bool"
MAX_CATEGORIES = 20
MAX_PERIODS = 60
TYPING_ROWS = 5000
PERIOD_WORDS = (
    "month", "months", "date", "dates", "day", "days", "year", "years", "period", "periods",
    "time", "times", "timestamp",
)
NOT_PERIOD_WORDS = ("count", "counts", "amount", "amounts")
HIGH_CORRELATION = 0.9
LEAKY_MIN_ROWS = 30
LEAKY_MIN_RATE = 0.3
LEAKY_MIN_LIFT = 5.0
PERIOD_JUMP = 4.0
