"""Record validation: one annotated frame, split by filters, measured by aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.contract import CANONICAL_FIELDS, CANONICAL_SCHEMA, CHANNELS, REQUIRED_FIELDS
from riskframe.functions import clean_text, iso_text, parse_bool, parse_number, share
from riskframe.functions.text import channel_form, currency_form, four_digits
from riskframe.functions.times import offset_text, parse_timestamp, timestamp_offset, wall_clock

RECORD = "<record>"
REJECT_TYPE = "struct<error_class:string,field:string,value:string,message:string>"
# Fields with a rule of their own are cleaned by it; other texts are only cleaned.
_CLEANED = (*REQUIRED_FIELDS, "card_last4")
_TEXT_FIELDS = tuple(
    f.name for f in CANONICAL_SCHEMA if isinstance(f.dataType, T.StringType) and f.name not in _CLEANED
)


def reject_reason(
    error_class: str, field: str | None, value: Column | None, message: Column | str
) -> Column:
    """Why a record is rejected; no field stands for the record as a whole."""
    none = F.lit(None).cast("string")
    return F.struct(
        F.lit(error_class).alias("error_class"),
        (F.lit(field) if field else none).alias("field"),
        (none if value is None else value.cast("string")).alias("value"),
        (F.lit(message) if isinstance(message, str) else message).alias("message"),
    )


def _settled(c: Column) -> Column:
    """The same value, in a projection that the optimizer leaves where it is.

    The condition always holds but is no constant. Without it a filter on ``reject`` would
    be pushed below the passes and work out every rule twice, and the passes themselves
    would be copied into every source of a union.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def validate(
    df: DataFrame,
    allowed_channels: Sequence[str] = CHANNELS,
    allow_negative_amount: bool = False,
    strict: bool = False,
) -> DataFrame:
    """Canonical columns with their checked values, plus ``reject`` and ``record``.

    ``reject`` is the first failing rule of a row, or null; ``record`` is the record as it
    came in. Rows are neither dropped nor moved: a narrow projection. Columns starting with
    two underscores pass through; unknown ones reject every row when ``strict``.
    """
    types = {f.name: f.dataType for f in df.schema}
    extra = [c for c in df.columns if c not in CANONICAL_FIELDS and not c.startswith("__")]
    origin = [c for c in df.columns if c.startswith("__")]

    def given(field: str) -> Column:
        return F.col(field) if field in types else F.lit(None).cast("string")

    def text(field: str) -> Column:
        return clean_text(given(field), types.get(field))

    raw_type = types.get("raw_source_data")
    raw = given("raw_source_data") if isinstance(raw_type, T.MapType) else F.lit(None)
    record = F.struct(*[given(f).alias(f) for f in CANONICAL_FIELDS if f != "raw_source_data"])

    # Three narrow passes, each over the columns of the one before, so that no expression
    # is spelled out twice: clean text, then parsed values, then rules. The optional texts,
    # which no rule looks at, are cleaned in the second.
    clock_type = types.get("timestamp")
    is_clock = isinstance(clock_type, (T.TimestampType, T.TimestampNTZType, T.DateType))
    cleaned = df.select(
        *origin,
        *[(_settled(text(f)) if f == "transaction_id" else text(f)).alias(f) for f in _CLEANED],
        *[given(f).alias(f) for f in _TEXT_FIELDS],
        given("amount").alias("amount_given"),
        given("timestamp").alias("timestamp_given"),
        given("response_time_seconds").alias("seconds_given"),
        given("is_fraud").alias("fraud_given"),
        raw.cast("map<string,string>").alias("raw_source_data"),
        record.alias("record"),
    )
    clock = F.col("timestamp_given").cast("timestamp_ntz") if is_clock else wall_clock(F.col("timestamp"))
    offset = F.lit(None).cast("string") if is_clock else offset_text(F.col("timestamp"))
    parsed = cleaned.select(
        *origin,
        "transaction_id",
        "customer_id",
        *[text(f).alias(f) for f in _TEXT_FIELDS],
        F.col("channel").alias("channel_text"),
        channel_form(F.col("channel")).alias("channel"),
        F.col("amount").alias("amount_text"),
        parse_number(F.col("amount_given"), types.get("amount")).alias("amount"),
        F.col("currency").alias("currency_text"),
        currency_form(F.col("currency")).alias("currency"),
        F.col("timestamp").alias("timestamp_text"),
        clock.alias("clock"),
        offset.alias("offset"),
        F.col("card_last4").alias("card_text"),
        four_digits(F.col("card_last4")).alias("card_last4"),
        F.col("seconds_given").cast("string").alias("seconds_text"),
        parse_number(F.col("seconds_given"), types.get("response_time_seconds")).alias(
            "response_time_seconds"
        ),
        F.col("fraud_given").cast("string").alias("fraud_text"),
        parse_bool(F.col("fraud_given"), types.get("is_fraud")).alias("is_fraud"),
        # A filter over an array also keeps this pass out of the generated code of the other
        # two: all three in one method would be too long for the JVM to compile.
        F.filter(
            F.array(*[F.when(F.col(f).isNull(), f) for f in REQUIRED_FIELDS]),
            lambda name: name.isNotNull(),
        ).alias("missing"),
        "raw_source_data",
        "record",
    )

    c = F.col
    rules: list[Column] = [
        F.when(
            F.size("missing") > 0,
            reject_reason(
                "SCHEMA", None, None,
                F.concat(
                    F.lit("required field(s) without a value: "), F.array_join("missing", ", ")
                ),
            ),
        )
    ]
    if strict and extra:
        listed = ", ".join(sorted(extra))
        rules.append(
            reject_reason("VALIDATION", None, None, f"field(s) outside the contract: {listed}")
        )
    rules += [
        F.when(
            c("currency").isNull(),
            reject_reason(
                "VALIDATION", "currency", c("currency_text"), "not a three-letter currency code"
            ),
        ),
        F.when(
            c("amount").isNull(),
            reject_reason("VALIDATION", "amount", c("amount_text"), "not a number"),
        ),
    ]
    if not allow_negative_amount:
        rules.append(
            F.when(
                c("amount") < 0,
                reject_reason("VALIDATION", "amount", c("amount"), "negative amount"),
            )
        )
    rules += [
        F.when(
            ~c("channel").isin(*allowed_channels),
            reject_reason(
                "VALIDATION", "channel", c("channel_text"),
                f"channel is none of {', '.join(sorted(allowed_channels))}",
            ),
        ),
        F.when(
            c("clock").isNull(),
            reject_reason(
                "VALIDATION", "timestamp", c("timestamp_text"), "unknown timestamp layout"
            ),
        ),
        F.when(
            c("card_text").isNotNull() & c("card_last4").isNull(),
            reject_reason("VALIDATION", "card_last4", c("card_text"), "not four digits"),
        ),
        F.when(
            c("seconds_text").isNotNull() & c("response_time_seconds").isNull(),
            reject_reason(
                "VALIDATION", "response_time_seconds", c("seconds_text"), "not a number"
            ),
        ),
        F.when(
            c("response_time_seconds") < 0,
            reject_reason(
                "VALIDATION", "response_time_seconds", c("seconds_text"), "negative duration"
            ),
        ),
        F.when(
            c("fraud_text").isNotNull() & c("is_fraud").isNull(),
            reject_reason("VALIDATION", "is_fraud", c("fraud_text"), "not a boolean"),
        ),
    ]
    reject = _settled(F.coalesce(*rules, F.lit(None).cast(REJECT_TYPE)))
    stamp = F.concat(iso_text(c("clock")), F.coalesce(c("offset"), F.lit("")))
    return parsed.select(
        *origin,
        *[stamp.alias(f) if f == "timestamp" else c(f) for f in CANONICAL_FIELDS],
        reject.alias("reject"),
        "record",
    )


def valid_records(annotated: DataFrame) -> DataFrame:
    """Accepted records: the canonical columns (origin columns stay in front)."""
    origin = [c for c in annotated.columns if c.startswith("__")]
    return annotated.filter(F.col("reject").isNull()).select(*origin, *CANONICAL_FIELDS)


def rejected_records(annotated: DataFrame) -> DataFrame:
    """Rejected records with error class, field, value, message and the record itself."""
    origin = [c for c in annotated.columns if c.startswith("__")]
    return annotated.filter(F.col("reject").isNotNull()).select(*origin, "reject.*", "record")


def raise_first_reject(annotated: DataFrame, order_by: Sequence[str] = ()) -> None:
    """Raise ``ValueError`` for the first rejected record, if there is one."""
    rejects = annotated.filter(F.col("reject").isNotNull())
    if order_by:
        rejects = rejects.orderBy(*order_by)
    first = rejects.select("reject").limit(1).collect()
    if first:
        reason = first[0].reject
        raise ValueError(f"{reason.field or RECORD}: {reason.message} ({reason.value!r})")


def reject_metrics(annotated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Total, valid and invalid records, whether all are valid, and the failure rate."""
    total, bad = F.count(F.lit(1)), F.count_if(F.col("reject").isNotNull())
    return annotated.groupBy(*by).agg(
        total.alias("total"),
        (total - bad).alias("valid"),
        bad.alias("invalid"),
        (bad == 0).alias("is_valid"),
        share(bad, total).alias("failure_rate"),
    )


def reject_field_counts(annotated: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rejected records per failing field."""
    return (
        annotated.filter(F.col("reject").isNotNull())
        .groupBy(*by, F.coalesce("reject.field", F.lit(RECORD)).alias("field"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def event_time(df: DataFrame) -> DataFrame:
    """Add ``event_ts`` (wall clock) and ``event_offset`` derived from canonical text."""
    return df.withColumns(
        {
            "event_ts": parse_timestamp(F.col("timestamp")),
            "event_offset": timestamp_offset(F.col("timestamp")),
        }
    )
