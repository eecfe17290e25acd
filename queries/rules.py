"""Cell rules, mappings and validation over raw transactions printed from ``orders``.

The raw texts are made from known values, so the SQL states the expected outcome from the
values themselves and never parses a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import riskframe as R
from queries import query
from riskframe import functions as fn
from riskframe.operators.mappings import ATM, ONLINE, POS, SourceMapping
from riskframe.sources.sinks import canonical_frame

def order_key():
    return F.col("o_orderkey")



def pick(column, choices: dict[int, object], default):
    """One of several spellings by a small code."""
    chosen = None
    for code, value in choices.items():
        value = value if hasattr(value, "alias") else F.lit(value)
        chosen = F.when(column == code, value) if chosen is None else chosen.when(column == code, value)
    return chosen.otherwise(default if hasattr(default, "alias") else F.lit(default))


def raw(spark: SparkSession, sf: str) -> DataFrame:
    """Orders printed as raw transactions with every kind of defect."""
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    key, price, customer = order_key(), F.col("o_totalprice"), F.col("o_custkey")
    clock = F.col("o_orderdate") + F.make_dt_interval(secs=key % 86400)
    money = F.format_number(price, 2)
    plain = price.cast("decimal(18,2)").cast("string")
    code = key % 40
    amount = (
        F.when(code == 0, F.concat(F.lit("- $"), money))
        .when(code == 1, "7x7")
        .when(code == 2, "4,5,6")
        .when(code == 3, "  ")
        .when(code <= 10, F.concat(F.lit("$"), money))
        .when(code <= 20, F.concat(F.lit("€ "), money))
        .otherwise(plain)
    )

    def form(layout: str):
        return F.date_format(clock, layout)

    iso = form("yyyy-MM-dd'T'HH:mm:ss")
    times = pick(
        key % 31,
        {
            0: "not-a-date",
            1: form("yyyy-MM-dd"),
            2: form("dd/MM/yyyy HH:mm:ss"),
            3: form("MM/dd/yyyy HH:mm:ss"),
            4: F.concat(iso, F.lit("Z")),
            5: F.concat(iso, F.lit("+0530")),
            6: F.concat(form("yyyy-MM-dd HH:mm:ss"), F.lit(".25")),
            7: form("yyyy/MM/dd HH:mm:ss"),
            8: form("yyyyMMdd'T'HHmmss"),
            9: form("yyyy-MM-dd'T'HH:mm"),
            10: F.concat(iso, F.lit("-08:00")),
        },
        iso,
    )
    tx = key - F.when(key % 10 == 9, 3).when(key % 10 == 8, 1).otherwise(0)
    return orders.select(
        "o_orderkey",
        F.concat(F.lit(" tx-"), tx).alias("transaction_id"),
        F.when(key % 101 == 0, "n/a").otherwise(customer.cast("string")).alias("customer_id"),
        amount.alias("amount"),
        F.when(key % 37 == 0, "kroner").when(key % 37 <= 10, " eur ").otherwise("usd").alias("currency"),
        times.alias("timestamp"),
        F.when(key % 17 == 0, "-").otherwise(F.concat(F.lit("\tstore-"), customer % 50, F.lit(" "))).alias("location"),
        F.concat(F.lit("m"), customer % 90).alias("merchant_id"),
        F.concat(F.lit("t"), customer % 30).alias("terminal_id"),
        pick(key % 29, {0: "12", 1: " NONE "}, F.lpad((customer % 10000).cast("string"), 4, "0")).alias("card_last4"),
        F.col("o_orderstatus").alias("card_type"),
        F.col("o_orderpriority").alias("payment_method"),
        F.when(key % 19 == 0, " Null").otherwise(F.concat(F.lit("A"), key)).alias("authorization_code"),
        F.lpad((key % 3).cast("string"), 2, "0").alias("response_code"),
        F.lit("electronics").alias("merchant_category"),
        F.lit("CASH").alias("transaction_type"),
        pick(key % 5, {0: "online banking", 1: " pos", 2: "Atm!", 3: "pigeon"}, "ONLINE_BANKING").alias("channel"),
        F.lit("APPROVED").alias("transaction_status"),
        pick(key % 23, {0: "-1", 1: "soon", 2: "1.5", 3: "0"}, F.lit(None).cast("string")).alias("response_time_seconds"),
        pick(key % 11, {0: "1", 1: "No", 2: " TRUE ", 3: "maybe", 4: "f"}, F.lit(None).cast("string")).alias("is_fraud"),
        F.create_map(F.lit("order"), key).alias("raw_source_data"),
    )


# What the texts above stand for.
TRUTH = """truth AS (SELECT o_orderkey,
  'tx-' || (o_orderkey - CASE o_orderkey % 10 WHEN 9 THEN 3 WHEN 8 THEN 1 ELSE 0 END)
    AS transaction_id,
  CASE WHEN o_orderkey % 101 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
  CASE WHEN o_orderkey % 40 = 0 THEN -o_totalprice WHEN o_orderkey % 40 > 3 THEN o_totalprice END
    AS amount,
  o_orderkey % 40 = 3 AS no_amount,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 37 <= 10 THEN 'EUR' ELSE 'USD' END
    AS currency,
  o_orderdate + to_seconds(o_orderkey % 86400) AS clock,
  CASE o_orderkey % 31 WHEN 0 THEN NULL
    WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%dT00:00:00')
    WHEN 3 THEN CASE WHEN day(o_orderdate) <= 12
      THEN strftime(clock, '%Y-%d-%mT%H:%M:%S') ELSE strftime(clock, '%Y-%m-%dT%H:%M:%S') END
    WHEN 4 THEN strftime(clock, '%Y-%m-%dT%H:%M:%S+00:00')
    WHEN 5 THEN strftime(clock, '%Y-%m-%dT%H:%M:%S+05:30')
    WHEN 6 THEN strftime(clock, '%Y-%m-%dT%H:%M:%S.250000')
    WHEN 9 THEN strftime(clock, '%Y-%m-%dT%H:%M:00')
    WHEN 10 THEN strftime(clock, '%Y-%m-%dT%H:%M:%S-08:00')
    ELSE strftime(clock, '%Y-%m-%dT%H:%M:%S') END AS "timestamp",
  CASE WHEN o_orderkey % 17 <> 0 THEN 'store-' || (o_custkey % 50) END AS location,
  'm' || (o_custkey % 90) AS merchant_id, 't' || (o_custkey % 30) AS terminal_id,
  CASE WHEN o_orderkey % 29 > 1 THEN lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END
    AS card_last4,
  CASE WHEN o_orderkey % 29 = 0 THEN '12' WHEN o_orderkey % 29 > 1
    THEN lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0') END AS card_text,
  o_orderstatus AS card_type, o_orderpriority AS payment_method,
  CASE WHEN o_orderkey % 19 <> 0 THEN 'A' || o_orderkey END AS authorization_code,
  lpad(CAST(o_orderkey % 3 AS VARCHAR), 2, '0') AS response_code,
  CASE o_orderkey % 5 WHEN 0 THEN 'ONLINE_BANKING' WHEN 1 THEN 'POS' WHEN 2 THEN 'ATM'
    WHEN 4 THEN 'ONLINE_BANKING' END AS channel,
  CASE o_orderkey % 23 WHEN 2 THEN 1.5 WHEN 3 THEN 0 END AS response_time_seconds,
  CASE o_orderkey % 11 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 4 THEN false END
    AS is_fraud,
  o_orderkey % 23 = 1 AS bad_seconds, o_orderkey % 23 = 0 AS negative_seconds,
  o_orderkey % 11 = 3 AS bad_fraud
  FROM orders)"""


def expected(columns: str, where: str = "true", ctes: str = TRUTH) -> str:
    return f"WITH {ctes} SELECT {columns} FROM truth WHERE {where}"


# --- cell rules -------------------------------------------------------------------------------


@query(
    "c01_clean_text",
    expected(
        "o_orderkey, transaction_id, customer_id, location, authorization_code, "
        "CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) "
        "ELSE o_orderkey || '.5' END AS number_text"
    ),
)
def clean_text(spark, sf):
    df = raw(spark, sf)
    half = F.when(order_key() % 3 == 0, order_key().cast("double")).otherwise(order_key() + 0.5)
    texts = ("transaction_id", "customer_id", "location", "authorization_code")
    df = df.withColumn("half", half.cast("double"))
    return df.select(
        "o_orderkey",
        *[fn.clean_text(F.col(c)).alias(c) for c in texts],
        fn.clean_text(F.col("half"), df.schema["half"].dataType).alias("number_text"),
    )


@query("c02_parse_number", expected("o_orderkey, amount"))
def parse_number(spark, sf):
    return raw(spark, sf).select("o_orderkey", fn.parse_number(F.col("amount")).alias("amount"))


@query("c03_parse_bool", expected("o_orderkey, is_fraud"))
def parse_bool(spark, sf):
    return raw(spark, sf).select("o_orderkey", fn.parse_bool(F.col("is_fraud")).alias("is_fraud"))


@query("c04_normalize_channel", expected("o_orderkey, channel"))
def normalize_channel(spark, sf):
    return raw(spark, sf).select(
        "o_orderkey", fn.normalize_channel(F.col("channel")).alias("channel")
    )


@query(
    "c05_parse_timestamp",
    expected(
        'o_orderkey, CAST(left("timestamp", 19) AS TIMESTAMP) + CASE WHEN o_orderkey % 31 = 6 '
        "THEN INTERVAL 250 MILLISECONDS ELSE INTERVAL 0 SECONDS END AS wall_clock, "
        "CASE o_orderkey % 31 WHEN 4 THEN '+00:00' WHEN 5 THEN '+05:30' WHEN 10 THEN '-08:00' END "
        "AS utc_offset"
    ),
)
def parse_timestamp(spark, sf):
    return raw(spark, sf).select(
        "o_orderkey",
        fn.parse_timestamp(F.col("timestamp")).alias("wall_clock"),
        fn.timestamp_offset(F.col("timestamp")).alias("utc_offset"),
    )


@query("c06_timestamp_text", expected('o_orderkey, "timestamp"'))
def timestamp_text(spark, sf):
    return raw(spark, sf).select(
        "o_orderkey", fn.timestamp_text(F.col("timestamp")).alias("timestamp")
    )


@query("c07_normalize_currency", expected("o_orderkey, currency"))
def normalize_currency(spark, sf):
    return raw(spark, sf).select(
        "o_orderkey", fn.normalize_currency(F.col("currency")).alias("currency")
    )


@query("c08_card_suffix", expected("o_orderkey, card_last4"))
def card_suffix(spark, sf):
    return raw(spark, sf).select(
        "o_orderkey", fn.card_suffix(F.col("card_last4")).alias("card_last4")
    )


@query(
    "c10_percentage",
    """SELECT l_orderkey, round(CASE WHEN sum(l_quantity) FILTER (l_linenumber > 3) > 0
    THEN 100.0 * coalesce(sum(l_quantity) FILTER (l_linenumber > 5), 0)
      / sum(l_quantity) FILTER (l_linenumber > 3) ELSE 0 END, 6) AS percent
    FROM lineitem GROUP BY l_orderkey""",
)
def percentage(spark, sf):
    part = F.coalesce(F.sum(F.when(F.col("l_linenumber") > 5, F.col("l_quantity"))), F.lit(0.0))
    whole = F.coalesce(F.sum(F.when(F.col("l_linenumber") > 3, F.col("l_quantity"))), F.lit(0.0))
    return (
        spark.read.parquet(f"{sf}/lineitem.parquet")
        .groupBy("l_orderkey")
        .agg(F.round(fn.percentage(part, whole), 6).alias("percent"))
    )


# --- mappings -----------------------------------------------------------------------------------

_MAPPED_TEXT = (
    "transaction_id", "customer_id", "channel", "location", "merchant_id", "terminal_id",
    "card_last4", "card_type", "payment_method", "authorization_code", "response_code",
)


def _mapped(mapping: SourceMapping, spark, sf) -> DataFrame:
    df = raw(spark, sf).drop("raw_source_data").withColumn("__key", order_key())
    mapped = mapping.apply(df.select("__key", *mapping.required))
    return mapped.select(
        F.col("__key").alias("o_orderkey"),
        *_MAPPED_TEXT,
        fn.parse_number(F.col("amount")).alias("amount"),
    )


@query(
    "p01_pos_mapping",
    expected(
        "o_orderkey, transaction_id, customer_id, 'POS' AS channel, location, merchant_id, "
        "NULL AS terminal_id, card_text AS card_last4, card_type, payment_method, "
        "authorization_code, response_code, amount"
    ),
)
def pos_mapping(spark, sf):
    return _mapped(POS, spark, sf)


@query(
    "p02_atm_mapping",
    expected(
        "o_orderkey, transaction_id, customer_id, 'ATM' AS channel, NULL AS location, "
        "NULL AS merchant_id, terminal_id, card_text AS card_last4, card_type, "
        "'CASH' AS payment_method, NULL AS authorization_code, response_code, amount"
    ),
)
def atm_mapping(spark, sf):
    return _mapped(ATM, spark, sf)


@query(
    "p03_online_mapping",
    expected(
        "o_orderkey, transaction_id, customer_id, 'ONLINE_BANKING' AS channel, NULL AS location, "
        "merchant_id, NULL AS terminal_id, card_text AS card_last4, card_type, "
        "CASE o_orderkey % 5 WHEN 0 THEN 'online banking' WHEN 1 THEN 'pos' WHEN 2 THEN 'Atm!' "
        "WHEN 3 THEN 'pigeon' ELSE 'ONLINE_BANKING' END AS payment_method, "
        "NULL AS authorization_code, 'APPROVED' AS response_code, amount"
    ),
)
def online_mapping(spark, sf):
    return _mapped(ONLINE, spark, sf)


@query(
    "p04_raw_row_capture",
    expected(
        "transaction_id, o_orderkey AS order_key, CAST(10 AS INTEGER) AS cells, "
        "customer_id AS raw_customer, terminal_id AS raw_terminal, 'CASH' AS raw_type"
    ),
)
def raw_row_capture(spark, sf):
    df = raw(spark, sf).select(*ATM.required, order_key().alias("__key"))
    cells = F.col("raw_source_data")
    return ATM.apply(df, include_raw=True).select(
        "transaction_id",
        F.col("__key").alias("order_key"),
        F.size(cells).alias("cells"),
        cells["customer_id"].alias("raw_customer"),
        cells["terminal_id"].alias("raw_terminal"),
        cells["transaction_type"].alias("raw_type"),
    )


@query(
    "p05_unknown_field_drop",
    """SELECT CAST(o_orderkey AS VARCHAR) AS transaction_id, o_totalprice AS amount,
    o_orderpriority AS payment_method FROM orders""",
)
def unknown_field_drop(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumnsRenamed(
        {"o_orderkey": "transaction_id", "o_totalprice": "amount", "o_orderpriority": "payment_method"}
    )
    frame = canonical_frame(orders)
    filled = ("transaction_id", "amount", "payment_method")
    if [c for c in frame.columns if c in orders.columns] != list(filled):
        raise AssertionError(frame.columns)
    return frame.select(*filled)


def wire(df: DataFrame) -> DataFrame:
    """A user's own mapping: a wire transfer layout."""
    return df.select(
        F.concat(F.lit("w-"), "o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.lit("WIRE").alias("channel"),
        F.col("o_totalprice").alias("amount"),
        F.lit("chf").alias("currency"),
        F.col("o_orderdate").alias("timestamp"),
        *[c for c in df.columns if c.startswith("__")],
    )


WIRE = SourceMapping("WIRE", ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), wire)


@query(
    "p07_registered_mapping",
    """SELECT 'w-' || o_orderkey AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    'WIRE' AS channel, o_totalprice AS amount, 'CHF' AS currency,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS "timestamp" FROM orders""",
)
def registered_mapping(spark, sf):
    registry = R.register(R.DEFAULT_MAPPINGS, "Wire", WIRE)
    orders = spark.read.parquet(f"{sf}/orders.parquet")
    checked = R.validate(registry["wire"].apply(orders), allowed_channels=("WIRE",))
    return R.valid_records(checked).select(
        "transaction_id", "customer_id", "channel", "amount", "currency", "timestamp"
    )


# --- validation -----------------------------------------------------------------------------------

# The first failing rule, in rule order.
FIRST = """CASE WHEN customer_id IS NULL OR no_amount THEN '<record>'
  WHEN currency IS NULL THEN 'currency' WHEN amount IS NULL OR amount < 0 THEN 'amount'
  WHEN channel IS NULL THEN 'channel' WHEN "timestamp" IS NULL THEN 'timestamp'
  WHEN card_last4 IS DISTINCT FROM card_text THEN 'card_last4'
  WHEN bad_seconds OR negative_seconds THEN 'response_time_seconds'
  WHEN bad_fraud THEN 'is_fraud' END"""
JUDGED = f"{TRUTH}, judged AS (SELECT *, {FIRST} AS field FROM truth)"

_RECORD = (
    "transaction_id", "customer_id", "channel", "amount", "currency", "timestamp", "location",
    "merchant_id", "terminal_id", "card_last4", "card_type", "payment_method",
    "authorization_code", "response_code", "response_time_seconds", "is_fraud", "raw_source_data",
)


def annotated(spark, sf, **options) -> DataFrame:
    df = raw(spark, sf).select(order_key().alias("__key"), *_RECORD)
    return R.validate(df, **options)


def judged(columns: str, where: str) -> str:
    return f"WITH {JUDGED} SELECT {columns} FROM judged WHERE {where}"


def rejects(spark, sf, field: str, **options) -> DataFrame:
    found = R.rejected_records(annotated(spark, sf, **options))
    field_name = F.coalesce("field", F.lit("<record>"))
    return found.filter(field_name == field).select(F.col("__key").alias("o_orderkey"), "value")


_THIN = ("transaction_id", "amount", " currency")


@query(
    "v01_missing_columns",
    """SELECT 'POS' AS mapping, m AS missing, n FROM (SELECT count(*) AS n FROM orders),
    (SELECT unnest(['customer_id', 'timestamp', 'location', 'merchant_id', 'card_last4',
      'card_type', 'payment_method', 'authorization_code', 'response_code']) AS m)""",
)
def missing_columns(spark, sf):
    thin = raw(spark, sf).select(*[F.col(c.strip()).alias(c) for c in _THIN])
    absent = POS.missing_columns(thin.columns)
    return thin.agg(F.count(F.lit(1)).alias("n")).select(
        F.lit("POS").alias("mapping"),
        F.explode(F.array(*map(F.lit, absent))).alias("missing"),
        "n",
    )


@query(
    "v04_required_fields",
    judged(
        "o_orderkey, concat_ws(', ', CASE WHEN customer_id IS NULL THEN 'customer_id' END, "
        "CASE WHEN no_amount THEN 'amount' END) AS missing",
        "field = '<record>'",
    ),
)
def required_fields(spark, sf):
    found = R.rejected_records(annotated(spark, sf)).filter("error_class = 'SCHEMA'")
    names = F.element_at(F.split("message", ": "), -1).alias("missing")
    return found.select(F.col("__key").alias("o_orderkey"), names)


@query(
    "v05_strict_fields",
    judged(
        "count(*) AS n, count(*) FILTER (field = '<record>') AS incomplete", "true"
    ),
)
def strict_fields(spark, sf):
    df = raw(spark, sf).withColumn("surplus", F.lit(1)).drop("o_orderkey")
    found = R.rejected_records(R.validate(df, strict=True))
    return found.filter("field IS NULL").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("error_class") == "SCHEMA").alias("incomplete")
    )


@query("v06_currency", judged("o_orderkey, 'kroner' AS value", "field = 'currency'"))
def bad_currency(spark, sf):
    return rejects(spark, sf, "currency")


@query(
    "v07_amount_number",
    judged(
        "o_orderkey, CASE o_orderkey % 40 WHEN 1 THEN '7x7' ELSE '4,5,6' END AS value",
        "field = 'amount' AND amount IS NULL",
    ),
)
def bad_amount(spark, sf):
    return rejects(spark, sf, "amount", allow_negative_amount=True)


@query("v08_negative_amount", judged("o_orderkey, amount", "field = 'amount' AND amount < 0"))
def negative_amount(spark, sf):
    found = rejects(spark, sf, "amount").select("o_orderkey", F.expr("try_cast(value AS double)").alias("amount"))
    return found.filter("amount < 0")


@query("v09_channel", judged("o_orderkey, 'pigeon' AS value", "field = 'channel'"))
def bad_channel(spark, sf):
    return rejects(spark, sf, "channel")


@query("v10_timestamp", judged("o_orderkey, 'not-a-date' AS value", "field = 'timestamp'"))
def bad_timestamp(spark, sf):
    return rejects(spark, sf, "timestamp")


@query("v11_card_suffix", judged("o_orderkey, '12' AS value", "field = 'card_last4'"))
def bad_card(spark, sf):
    return rejects(spark, sf, "card_last4")


@query(
    "v12_response_time",
    judged(
        "o_orderkey, CASE WHEN bad_seconds THEN 'soon' ELSE '-1' END AS value",
        "field = 'response_time_seconds'",
    ),
)
def bad_response_time(spark, sf):
    return rejects(spark, sf, "response_time_seconds")


@query("v13_fraud_flag", judged("o_orderkey, 'maybe' AS value", "field = 'is_fraud'"))
def bad_fraud_flag(spark, sf):
    return rejects(spark, sf, "is_fraud")


@query(
    "v14_raw_data",
    judged("o_orderkey, CAST(o_orderkey AS VARCHAR) AS raw_order", "field IS NULL"),
)
def raw_data(spark, sf):
    valid = R.valid_records(annotated(spark, sf))
    return valid.select(
        F.col("__key").alias("o_orderkey"), F.col("raw_source_data")["order"].alias("raw_order")
    )


_OPTIONAL = (
    "location, merchant_id, terminal_id, card_type, payment_method, authorization_code, "
    "response_code"
)


@query("v15_optional_text", judged(f"o_orderkey, {_OPTIONAL}", "field IS NULL"))
def optional_text(spark, sf):
    valid = R.valid_records(annotated(spark, sf))
    return valid.select(F.col("__key").alias("o_orderkey"), *_OPTIONAL.split(", "))


_VALUES = (
    "transaction_id", "customer_id", "channel", "amount", "currency", "timestamp", "card_last4",
    "response_time_seconds", "is_fraud",
)


@query(
    "v16_validate",
    judged(
        ", ".join(
            [
                "o_orderkey",
                "field IS NULL AS is_valid",
                "field",
                *[f'CASE WHEN field IS NULL THEN "{c}" END AS "{c}"' for c in _VALUES],
            ]
        ),
        "true",
    ),
)
def validate(spark, sf):
    bad = F.col("reject").isNotNull()
    return annotated(spark, sf).select(
        F.col("__key").alias("o_orderkey"),
        (~bad).alias("is_valid"),
        F.when(bad, F.coalesce("reject.field", F.lit("<record>"))).alias("field"),
        *[F.when(~bad, F.col(c)).alias(c) for c in _VALUES],
    )


@query(
    "i07_reject_metrics",
    judged(
        "count(*) AS total, count(*) FILTER (field IS NULL) AS valid, "
        "count(*) FILTER (field IS NOT NULL) AS invalid, "
        "count(*) FILTER (field IS NOT NULL) = 0 AS is_valid, "
        "round(count(*) FILTER (field IS NOT NULL) / count(*), 6) AS failure_rate",
        "true",
    ),
)
def reject_metrics(spark, sf):
    m = R.reject_metrics(annotated(spark, sf))
    return m.withColumn("failure_rate", F.round("failure_rate", 6))


@query(
    "i08_rejects_per_field",
    f"WITH {JUDGED} SELECT field, count(*) AS n FROM judged WHERE field IS NOT NULL GROUP BY field",
)
def rejects_per_field(spark, sf):
    return R.reject_field_counts(annotated(spark, sf))
