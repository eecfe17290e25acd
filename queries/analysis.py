"""Analysis operators over ``lineitem``, ``orders``, ``events`` and ``customer``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import riskframe as R
from queries import ORACLES, query

TARGET = "fraud_bool"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with a label, gaps, a sentinel, negatives and period columns."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        c("l_orderkey").alias("order_key"),
        c("l_partkey").alias("part_key"),
        c("l_linenumber").alias("line_number"),
        F.when(c("l_quantity") == 50, -1.0).otherwise(c("l_quantity")).alias("quantity"),
        c("l_extendedprice").alias("price"),
        (c("l_extendedprice") - 20000).alias("margin"),
        c("l_discount").alias("discount"),
        F.when(c("l_partkey") % 11 != 0, c("l_tax")).alias("tax"),
        F.when(c("l_suppkey") % 7 != 0, c("l_returnflag")).alias("flag"),
        c("l_linestatus").alias("status"),
        F.month("l_shipdate").alias("ship_month"),
        F.year("l_shipdate").alias("ship_year"),
        F.lit(7).alias("constant"),
        F.when(c("l_linenumber") != 7, (c("l_returnflag") == "R").cast("int")).alias(TARGET),
    )


LINES = """lines AS (SELECT
  l_orderkey AS order_key, l_partkey AS part_key, l_linenumber AS line_number,
  CASE WHEN l_quantity = 50 THEN -1.0 ELSE l_quantity END AS quantity,
  l_extendedprice AS price, l_extendedprice - 20000 AS margin, l_discount AS discount,
  CASE WHEN l_partkey % 11 <> 0 THEN l_tax END AS tax,
  CASE WHEN l_suppkey % 7 <> 0 THEN l_returnflag END AS flag, l_linestatus AS status,
  CAST(month(l_shipdate) AS INTEGER) AS ship_month,
  CAST(year(l_shipdate) AS INTEGER) AS ship_year, 7 AS constant,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_returnflag = 'R' AS INTEGER) END AS fraud_bool
  FROM lineitem)"""
COLUMNS = (
    "order_key", "part_key", "line_number", "quantity", "price", "margin", "discount", "tax",
    "flag", "status", "ship_month", "ship_year", "constant", TARGET,
)
TEXT = ("flag", "status")
NUMBERS = tuple(c for c in COLUMNS if c not in TEXT)
CATEGORICAL = (
    "line_number", "discount", "tax", "flag", "status", "ship_month", "ship_year", "constant",
)
CONTINUOUS = ("order_key", "part_key", "quantity", "price", "margin")


def each(columns, template: str, ctes: str = LINES, tail: str = "") -> str:
    """One branch of ``template`` per column, in one statement."""
    return f"WITH {ctes} " + " UNION ALL ".join(template.format(c=c) for c in columns) + tail


def rounded(df: DataFrame, digits: int = 6, *names: str) -> DataFrame:
    """Doubles rounded for comparison; adding zero drops a negative zero."""
    doubles = names or [f.name for f in df.schema if f.dataType.typeName() == "double"]
    return df.withColumns({n: F.round(n, digits) + F.lit(0.0) for n in doubles})


def labelled(columns) -> str:
    """All categories of the given columns with their counts, as SQL."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"count(*) FILTER (fraud_bool = 1) AS positives FROM lines GROUP BY {c}"
        for c in columns
    )


# --- overview -----------------------------------------------------------------------------


@query(
    "a01_dataset_size",
    'SELECT count(*) AS n, CAST(11 AS INTEGER) AS "columns" FROM lineitem',
)
def dataset_size(spark, sf):
    return R.dataset_size(table(spark, sf, "lineitem"))


_TYPES = {
    "l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
    "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
    "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz",
}


@query(
    "a02_column_types",
    " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS ordinal, '{c}' AS \"column\", '{t}' AS type, "
        f"count({c}) AS present FROM lineitem"
        for i, (c, t) in enumerate(_TYPES.items())
    ),
)
def column_types(spark, sf):
    stats = R.column_scan(table(spark, sf, "lineitem").select(*_TYPES))
    return stats.select("ordinal", "column", "type", (F.col("n") - F.col("missing")).alias("present"))


# --- data quality ---------------------------------------------------------------------------


@query(
    "a03_missing_values",
    f"""WITH {LINES}, m AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS c, count(*) - count({c}) AS k, count(*) AS n FROM lines"
        for c in COLUMNS)})
    SELECT c AS "column", k AS missing, round(k / n, 6) AS missing_share FROM m WHERE k > 0""",
)
def missing_values(spark, sf):
    return rounded(R.missing_values(lines(spark, sf)))


_FEW = ("l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus")
_COPIES = f"""SELECT CAST(sum(k) AS BIGINT) AS n, CAST(sum(k - 1) AS BIGINT) AS duplicates,
    round(sum(k - 1) / sum(k), 6) AS share
    FROM (SELECT count(*) AS k FROM lineitem GROUP BY {", ".join(_FEW)})"""


@query("a04_duplicate_rows", _COPIES)
def duplicate_rows(spark, sf):
    return rounded(R.duplicate_rows(table(spark, sf, "lineitem"), _FEW))


@query("a04_duplicate_rows_by_digest", _COPIES)
def duplicate_rows_by_digest(spark, sf):
    return rounded(R.duplicate_rows(table(spark, sf, "lineitem"), _FEW, digest=True))


@query(
    "a05_constant_columns",
    each(
        COLUMNS,
        "SELECT '{c}' AS \"column\" FROM lines HAVING count(DISTINCT {c}) + "
        "max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1",
    ),
)
def constant_columns(spark, sf):
    return R.constant_columns(lines(spark, sf)).select("column")


_NEGATIVE = each(
    NUMBERS,
    "SELECT '{c}' AS \"column\", count(*) FILTER ({c} = -1) AS neg_one, "
    "round(count(*) FILTER ({c} = -1) / count(*), 6) AS neg_one_share, "
    "count(*) FILTER ({c} < 0 AND {c} <> -1) AS other_negative, "
    "round(count(*) FILTER ({c} < 0 AND {c} <> -1) / count(*), 6) AS other_negative_share "
    "FROM lines",
)


@query(
    "a06_sentinel_values",
    f'SELECT "column", neg_one, neg_one_share FROM ({_NEGATIVE}) WHERE neg_one > 0',
)
def sentinel_values(spark, sf):
    found = rounded(R.negative_values(lines(spark, sf)))
    return found.filter("neg_one > 0").select("column", "neg_one", "neg_one_share")


@query(
    "a07_other_negatives",
    f"""SELECT "column", other_negative, other_negative_share FROM ({_NEGATIVE})
    WHERE other_negative > 0""",
)
def other_negatives(spark, sf):
    found = rounded(R.negative_values(lines(spark, sf)))
    return found.filter("other_negative > 0").select(
        "column", "other_negative", "other_negative_share"
    )


@query(
    "a08_quality_warnings",
    """WITH f AS (SELECT l_linenumber, CASE WHEN l_suppkey % 3 = 0 THEN l_tax END AS gaps,
    l_returnflag, 7 AS constant FROM lineitem),
    g AS (SELECT count(*) AS k FROM f GROUP BY l_linenumber, gaps, l_returnflag, constant)
    SELECT 'columns_over_half_missing' AS warning, CAST(1 AS BIGINT) AS n FROM f
    HAVING count(gaps) < 0.5 * count(*)
    UNION ALL SELECT 'constant_columns', CAST(1 AS BIGINT)
    UNION ALL SELECT 'duplicate_rows', CAST(sum(k - 1) AS BIGINT) FROM g""",
)
def quality_warnings(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_linenumber",
        F.when(F.col("l_suppkey") % 3 == 0, F.col("l_tax")).alias("gaps"),
        "l_returnflag",
        F.lit(7).alias("constant"),
    )
    return R.quality_warnings(df)


# --- feature profile --------------------------------------------------------------------------


@query(
    "a09_distinct_and_missing",
    each(
        COLUMNS,
        "SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\", "
        "count(*) - count({c}) AS missing, round(1 - count({c}) / count(*), 6) AS missing_share "
        "FROM lines",
    ),
)
def distinct_and_missing(spark, sf):
    stats = R.column_stats(lines(spark, sf))
    return rounded(stats.select("column", "distinct", "missing", "missing_share"))


@query(
    "a10_numeric_profile",
    each(
        NUMBERS,
        "SELECT '{c}' AS \"column\", round(avg({c}), 4) AS mean, "
        "round(stddev_samp({c}), 4) AS std, CAST(min({c}) AS DOUBLE) AS min, "
        "CAST(max({c}) AS DOUBLE) AS max FROM lines",
    ),
)
def numeric_profile(spark, sf):
    stats = R.column_scan(lines(spark, sf)).filter(F.col("mean").isNotNull())
    return rounded(stats.select("column", "mean", "std", "min", "max"), 4, "mean", "std")


_FIRST = "ORDER BY n DESC, value ASC NULLS LAST"


@query(
    "a11_most_common",
    f"""WITH {LINES}, counts AS ({labelled(TEXT)}),
    r AS (SELECT *, row_number() OVER (PARTITION BY "column" {_FIRST}) AS k,
      count(*) OVER (PARTITION BY "column") AS categories FROM counts WHERE value IS NOT NULL)
    SELECT "column", categories, value, n FROM r WHERE k = 1""",
)
def most_common(spark, sf):
    return R.most_common(lines(spark, sf))


# --- class balance ----------------------------------------------------------------------------


@query(
    "a12_class_counts",
    f"""WITH {LINES} SELECT fraud_bool AS value, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM lines), 6) AS share FROM lines GROUP BY fraud_bool""",
)
def class_counts(spark, sf):
    return rounded(R.class_counts(lines(spark, sf), TARGET))


@query(
    "a13_class_balance",
    f"""WITH {LINES}, t AS (SELECT count(*) AS n, count(*) FILTER (fraud_bool = 1) AS p FROM lines)
    SELECT n, p AS positives, n - p AS negatives, round(p / n, 6) AS positive_rate,
    round((n - p) / n, 6) AS negative_rate, round((n - p) / p, 6) AS imbalance_ratio FROM t""",
)
def class_balance(spark, sf):
    return rounded(R.class_balance(lines(spark, sf), TARGET))


# --- categories -------------------------------------------------------------------------------


def _roles_sql(table_sql: str, columns: dict[str, bool]) -> str:
    parts = []
    for i, (name, is_text) in enumerate(columns.items()):
        role = (
            f"CASE WHEN count({name}) >= 0 THEN 'categorical' END"
            if is_text
            else f"CASE WHEN count(DISTINCT {name}) <= 20 THEN 'categorical' ELSE 'continuous' END"
        )
        parts.append(
            f"SELECT CAST({i} AS INTEGER) AS ordinal, '{name}' AS \"column\", {role} AS role "
            f"FROM lines"
        )
    return f"WITH {table_sql} " + " UNION ALL ".join(parts)


@query("a14_column_roles", _roles_sql(LINES, {c: c in TEXT for c in COLUMNS if c != TARGET}))
def column_roles(spark, sf):
    return R.classify_columns(lines(spark, sf), [TARGET])


_RANKED = f"""WITH {LINES}, counts AS ({labelled(CATEGORICAL)}),
    r AS (SELECT *, CAST(row_number() OVER (PARTITION BY "column" {_FIRST}) AS INTEGER) AS rank,
      count(*) OVER (PARTITION BY "column") AS categories FROM counts)"""


@query(
    "a15_category_counts",
    f"""WITH {LINES}, counts AS ({labelled(CATEGORICAL)})
    SELECT "column", value, n, positives, round(positives / n, 6) AS positive_rate FROM counts""",
)
def all_categories(spark, sf):
    counts = R.value_counts(lines(spark, sf), CATEGORICAL, TARGET)
    rate = F.round(F.col("positives") / F.col("n"), 6).alias("positive_rate")
    return counts.select("column", "value", "n", "positives", rate)


@query(
    "a16_top_categories",
    f"""{_RANKED} SELECT "column", value, n, round(n / (SELECT count(*) FROM lines), 6) AS share,
    round(positives / n, 6) AS positive_rate, rank, categories,
    greatest(categories - 6, 0) AS hidden FROM r WHERE rank <= 6""",
)
def top_categories(spark, sf):
    return rounded(R.category_counts(lines(spark, sf), CATEGORICAL, TARGET, top=6))


@query(
    "a16_top_categories_first_seen",
    """WITH c AS (SELECT o_clerk AS value, count(*) AS n, min(o_orderkey) AS first FROM
      (SELECT concat('clerk', o_custkey % 400) AS o_clerk, o_orderkey FROM orders) GROUP BY ALL),
    r AS (SELECT *, CAST(row_number() OVER (ORDER BY n DESC, first) AS INTEGER) AS rank,
      count(*) OVER () AS categories FROM c)
    SELECT 'clerk' AS "column", value, n, round(n / (SELECT count(*) FROM orders), 6) AS share,
    CAST(NULL AS DOUBLE) AS positive_rate, rank, categories,
    greatest(categories - 15, 0) AS hidden FROM r WHERE rank <= 15""",
)
def top_categories_first_seen(spark, sf):
    clerks = table(spark, sf, "orders").select(
        "o_orderkey", F.concat(F.lit("clerk"), F.col("o_custkey") % 400).alias("clerk")
    )
    return rounded(R.category_counts(clerks, ["clerk"], order_by=["o_orderkey"]))


# --- numbers ----------------------------------------------------------------------------------

_SUMMARY = each(
    CONTINUOUS,
    "SELECT '{c}' AS \"column\", count({c}) AS n, round(avg({c}), 4) AS mean, "
    "round(median({c}), 4) AS median, round(stddev_samp({c}), 4) AS std, "
    "CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
    "round(quantile_cont({c}, 0.05), 4) AS p5, round(quantile_cont({c}, 0.25), 4) AS p25, "
    "round(quantile_cont({c}, 0.75), 4) AS p75, round(quantile_cont({c}, 0.95), 4) AS p95, "
    "count(*) FILTER ({c} = 0) AS zeros, "
    "round(count(*) FILTER ({c} = 0) / count({c}), 6) AS zero_share, "
    "count(*) FILTER ({c} = -1) AS neg_ones, "
    "round(count(*) FILTER ({c} = -1) / count({c}), 6) AS neg_one_share FROM lines",
)


def _summary(df: DataFrame) -> DataFrame:
    df = rounded(df, 4, "mean", "median", "std", "p5", "p25", "p75", "p95")
    return rounded(df, 6, "zero_share", "neg_one_share")


@query(
    "a17_numeric_summary",
    f"""SELECT "column", n, mean, median, std, min, max FROM ({_SUMMARY})""",
)
def numeric_moments(spark, sf):
    summary = _summary(R.numeric_summary(lines(spark, sf), CONTINUOUS))
    return summary.select("column", "n", "mean", "median", "std", "min", "max")


@query("a18_percentiles", f"""SELECT "column", p5, p25, p75, p95 FROM ({_SUMMARY})""")
def percentiles(spark, sf):
    summary = _summary(R.numeric_summary(lines(spark, sf), CONTINUOUS))
    return summary.select("column", "p5", "p25", "p75", "p95")


@query("a18_percentiles_by_counting", f"""SELECT "column", p5, p25, p75, p95 FROM ({_SUMMARY})""")
def percentiles_by_counting(spark, sf):
    summary = _summary(R.numeric_summary(lines(spark, sf), CONTINUOUS))
    return summary.select("column", "p5", "p25", "p75", "p95")


@query(
    "a19_zeros_and_sentinels",
    f"""SELECT "column", zeros, zero_share, neg_ones, neg_one_share FROM ({_SUMMARY})""",
)
def zeros_and_sentinels(spark, sf):
    summary = _summary(R.numeric_summary(lines(spark, sf), CONTINUOUS))
    return summary.select("column", "zeros", "zero_share", "neg_ones", "neg_one_share")


# --- time -------------------------------------------------------------------------------------


def dated(spark, sf):
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.month(day).alias("order_month"),
        F.year(day).alias("order_year"),
        (F.year(day) * 100 + F.month(day)).alias("period_code"),
        F.col("o_totalprice").alias("amount_date"),
        (F.col("o_custkey") % 5).alias("days_count"),
    )


@query(
    "a20_temporal_columns",
    """WITH d AS (SELECT month(o_orderdate) AS order_month, year(o_orderdate) AS order_year,
      year(o_orderdate) * 100 + month(o_orderdate) AS period_code FROM orders)
    SELECT CAST(1 AS INTEGER) AS ordinal, 'order_month' AS "column", 'temporal' AS role FROM d
      HAVING count(DISTINCT order_month) <= 60
    UNION ALL SELECT 2, 'order_year', 'temporal' FROM d HAVING count(DISTINCT order_year) <= 60
    UNION ALL SELECT 3, 'period_code', 'temporal' FROM d HAVING count(DISTINCT period_code) <= 60""",
)
def temporal_columns(spark, sf):
    return R.temporal_columns(dated(spark, sf))


@query(
    "a21_period_counts",
    f"""WITH {LINES}, p AS (SELECT CASE WHEN part_key % 11 <> 0 THEN ship_month END AS period,
      fraud_bool FROM lines)
    SELECT 'ship_month' AS "column", period, count(*) AS n,
    round(count(*) / (SELECT count(*) FROM p), 6) AS share,
    round(count(*) FILTER (fraud_bool = 1) / count(*), 6) AS positive_rate FROM p GROUP BY period""",
)
def period_counts(spark, sf):
    known = F.when(F.col("part_key") % 11 != 0, F.col("ship_month"))
    df = lines(spark, sf).withColumn("ship_month", known)
    return rounded(R.period_counts(df, "ship_month", TARGET))


_ORDER = """SELECT '{name}' AS "column", CASE WHEN bool_or(v IS NULL) THEN 'none'
    WHEN bool_and(coalesce(p <= v, true)) THEN 'increasing'
    WHEN bool_and(coalesce(p >= v, true)) THEN 'decreasing' ELSE 'none' END AS direction
    FROM (SELECT {value} AS v, lag({value}) OVER (ORDER BY {by}) AS p FROM {table})"""


@query(
    "a22_row_order",
    " UNION ALL ".join(
        _ORDER.format(name=n, value=v, by=b, table=t)
        for n, v, b, t in (
            ("event_date", "CAST(ts AS DATE)", "event_id", "events"),
            ("time_left", "-(event_id // 100)", "event_id", "events"),
            ("ts", "ts", "event_id", "events"),
            ("order_month", "month(o_orderdate)", "o_orderkey", "orders"),
        )
    ),
)
def row_order(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", "ts", F.to_date("ts").alias("event_date"),
        (-F.floor(F.col("event_id") / 100)).alias("time_left"),
    )
    found = [R.row_order(events, c, ["event_id"]) for c in ("event_date", "time_left", "ts")]
    found.append(R.row_order(dated(spark, sf), "order_month", ["o_orderkey"]))
    union = found[0]
    for more in found[1:]:
        union = union.unionByName(more)
    return union


# --- label relationships ------------------------------------------------------------------------


@query(
    "a23_label_by_category",
    f"""{_RANKED} SELECT "column", value, n, round(positives / n, 6) AS positive_rate, rank
    FROM r WHERE rank <= 8""",
)
def label_by_category(spark, sf):
    return rounded(R.label_by_category(lines(spark, sf), CATEGORICAL, TARGET))


@query(
    "a24_label_by_numeric",
    each(
        CONTINUOUS,
        "SELECT '{c}' AS \"column\", count({c}) FILTER (pos) AS pos_n, "
        "round(avg({c}) FILTER (pos), 4) AS pos_mean, "
        "round(median({c}) FILTER (pos), 4) AS pos_median, "
        "count({c}) FILTER (NOT pos) AS neg_n, round(avg({c}) FILTER (NOT pos), 4) AS neg_mean, "
        "round(median({c}) FILTER (NOT pos), 4) AS neg_median, "
        "count({c}) FILTER (pos) > 0 AND count({c}) FILTER (NOT pos) > 0 AS comparable "
        "FROM (SELECT *, coalesce(fraud_bool = 1, false) AS pos FROM lines)",
    ),
)
def label_by_numeric(spark, sf):
    return rounded(R.label_by_numeric(lines(spark, sf), CONTINUOUS, TARGET), 4)


# --- outliers -----------------------------------------------------------------------------------


def spread(spark, sf):
    """Amounts with a long tail, so that there are outliers."""
    c = F.col
    return table(spark, sf, "lineitem").select(
        (c("l_quantity") * c("l_quantity") * c("l_quantity")).alias("cubed"),
        c("l_extendedprice").alias("price"),
        F.when(c("l_partkey") % 50 == 0, c("l_extendedprice") * 100)
        .otherwise(c("l_extendedprice"))
        .alias("mixed"),
        F.when(c("l_linenumber") == 7, c("l_quantity") + 1000)
        .when(c("l_linenumber") != 6, c("l_quantity"))
        .alias("stepped"),
    )


_SPREAD = """spread AS (SELECT l_quantity * l_quantity * l_quantity AS cubed,
  l_extendedprice AS price,
  CASE WHEN l_partkey % 50 = 0 THEN l_extendedprice * 100 ELSE l_extendedprice END AS mixed,
  CASE WHEN l_linenumber = 7 THEN l_quantity + 1000 WHEN l_linenumber <> 6 THEN l_quantity END
    AS stepped FROM lineitem)"""
_TAILED = ("cubed", "price", "mixed", "stepped")
_FENCED = ", ".join(
    f"f_{c} AS (SELECT q1, q3, m, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
    f"(SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, "
    f"median({c}) AS m FROM spread))"
    for c in _TAILED
)


@query(
    "a25_iqr_outliers",
    each(
        _TAILED,
        "SELECT '{c}' AS \"column\", round(any_value(q1), 4) AS q1, round(any_value(q3), 4) AS q3, "
        "round(any_value(lo), 4) AS lower, round(any_value(hi), 4) AS upper, count({c}) AS n, "
        "count(*) FILTER ({c} < lo OR {c} > hi) AS outliers, "
        "round(count(*) FILTER ({c} < lo OR {c} > hi) / count({c}), 6) AS share "
        "FROM spread, f_{c}",
        f"{_SPREAD}, {_FENCED}",
    ),
)
def iqr_outliers(spark, sf):
    found = R.iqr_outliers(spread(spark, sf), _TAILED)
    return rounded(rounded(found, 4, "q1", "q3", "lower", "upper"), 6, "share")


@query(
    "a26_extreme_values",
    each(
        _TAILED,
        "(SELECT '{c}' AS \"column\", round({c}, 4) AS value, round(abs({c} - m), 4) AS distance, "
        "CAST(row_number() OVER (ORDER BY abs({c} - m) DESC, {c} DESC) AS INTEGER) AS rank "
        "FROM spread, f_{c} WHERE {c} < lo OR {c} > hi ORDER BY rank LIMIT 5)",
        f"{_SPREAD}, {_FENCED}",
    ),
)
def extreme_values(spark, sf):
    return rounded(R.extreme_values(spread(spark, sf), _TAILED), 4)


# --- leakage ------------------------------------------------------------------------------------


def leaky(spark, sf):
    """A rare label that several columns give away."""
    c = F.col
    rare = c("l_quantity") == 50
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        F.when(rare, c("l_discount") + 1000).otherwise(c("l_discount")).alias("score"),
        c("l_extendedprice").alias("price"),
        (c("l_extendedprice") + 0).alias("price_copy"),
        F.when(c("l_orderkey") % 1000 != 0, c("l_extendedprice")).alias("price_gaps"),
        c("l_partkey").alias("part"),
        c("l_partkey").cast("double").alias("part_copy"),
        F.lit(3).alias("constant"),
        F.when(rare & (c("l_suppkey") % 2 == 0), "chargeback")
        .when(rare, None)
        .otherwise(c("l_returnflag"))
        .alias("reason"),
        F.year("l_shipdate").alias("ship_year"),
        F.when(F.year("l_shipdate") == 1998, c("l_quantity") >= 40)
        .otherwise(rare)
        .cast("int")
        .alias("odd_label"),
        F.when(c("l_linenumber") != 7, rare.cast("int")).alias("rare_label"),
    )


_LEAKY = """leaky AS (SELECT l_orderkey, l_linenumber, l_suppkey,
  CASE WHEN l_quantity = 50 THEN l_discount + 1000 ELSE l_discount END AS score,
  l_extendedprice AS price, l_extendedprice + 0 AS price_copy,
  CASE WHEN l_orderkey % 1000 <> 0 THEN l_extendedprice END AS price_gaps,
  l_partkey AS part, CAST(l_partkey AS DOUBLE) AS part_copy, 3 AS constant,
  CASE WHEN l_quantity = 50 AND l_suppkey % 2 = 0 THEN 'chargeback'
    WHEN l_quantity = 50 THEN NULL ELSE l_returnflag END AS reason,
  CAST(year(l_shipdate) AS INTEGER) AS ship_year,
  CAST(CASE WHEN year(l_shipdate) = 1998 THEN l_quantity >= 40 ELSE l_quantity = 50 END
    AS INTEGER) AS odd_label,
  CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity = 50 AS INTEGER) END AS rare_label
  FROM lineitem)"""
_FEATURES = ("score", "price", "price_copy", "price_gaps", "part", "part_copy", "constant")
_RARE = "rare_label"


@query(
    "a27_constant_features",
    each(
        (*_FEATURES, "reason"),
        "SELECT '{c}' AS \"column\", count(*) AS n FROM leaky HAVING count(DISTINCT {c}) + "
        "max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1",
        _LEAKY,
    ),
)
def constant_features(spark, sf):
    return R.constant_features(leaky(spark, sf), [*_FEATURES, "reason"])


_R = each(
    _FEATURES[:-1],
    "SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NOT NULL AND rare_label IS NOT NULL) "
    "AS n, corr({c}, rare_label) AS r FROM leaky",
    _LEAKY,
)


@query("a28_label_correlations", f'SELECT "column", n, round(r, 6) + 0.0 AS r FROM ({_R})')
def label_correlations(spark, sf):
    r = R.label_correlations(leaky(spark, sf), _FEATURES, _RARE)
    # A constant has no correlation here; the SQL leaves that column out.
    return rounded(r.filter(F.col("r").isNotNull()))


@query(
    "a28_high_correlations",
    f'SELECT "column", n, round(r, 6) AS r FROM ({_R}) WHERE abs(r) > 0.9',
)
def high_correlations(spark, sf):
    return rounded(R.high_correlations(leaky(spark, sf), _FEATURES, _RARE))


_CATEGORY = f"""WITH {_LEAKY}, b AS (SELECT avg(rare_label) AS base FROM leaky),
    g AS ({" UNION ALL ".join(
        f"SELECT '{c}' AS c, CAST({c} AS VARCHAR) AS value, count(*) AS n, "
        f"count(*) FILTER (rare_label = 1) / count(*) AS rate FROM leaky GROUP BY {c}"
        for c in ("reason", "ship_year", "l_linenumber"))})
    SELECT c AS "column", value, n, round(rate, 6) AS positive_rate, round(base, 6) AS baseline,
    round(rate / base, 4) AS lift FROM g, b WHERE n >= 30 AND rate >= 0.3 AND rate / base >= 5"""


@query("a29_majority_positive_categories", _CATEGORY)
def majority_positive_categories(spark, sf):
    found = R.majority_positive_categories(
        leaky(spark, sf), ["reason", "ship_year", "l_linenumber"], _RARE
    )
    return rounded(rounded(found, 6, "positive_rate", "baseline"), 4, "lift")


def _pairs(source: str, cells: str) -> str:
    pairs = [(a, b) for j, b in enumerate(_FEATURES) for a in _FEATURES[:j]]
    return " UNION ALL ".join(
        f"SELECT '{b}' AS \"column\", '{a}' AS duplicate_of FROM {source} "
        f"HAVING bool_and({cells.format(a=a, b=b)})"
        for a, b in pairs
    )


@query(
    "a30_near_duplicates",
    f"WITH {_LEAKY} " + _pairs("leaky", "{a} IS NOT DISTINCT FROM {b}"),
)
def near_duplicates(spark, sf):
    return R.near_duplicates(leaky(spark, sf), _FEATURES)


_SHIFTS = f"""WITH {_LEAKY}, r AS (SELECT ship_year, avg(odd_label) AS rate,
      count(odd_label) AS n FROM leaky GROUP BY ship_year),
    p AS (SELECT *, lag(rate) OVER (ORDER BY ship_year) AS before FROM r)
    SELECT 'ship_year' AS "column", CAST(ship_year AS VARCHAR) AS period, n,
    round(rate, 6) AS rate, round(before, 6) AS previous_rate,
    round(rate / before - 1, 4) AS change FROM p WHERE abs(rate / before - 1) > 4"""


@query("a31_period_shifts", _SHIFTS)
def period_shifts(spark, sf):
    found = R.period_shifts(leaky(spark, sf), "ship_year", "odd_label")
    return rounded(rounded(found, 6, "rate", "previous_rate"), 4, "change")


@query(
    "a32_leakage_findings",
    f"""WITH {_LEAKY}, b AS (SELECT avg(odd_label) AS base FROM leaky),
    g AS (SELECT reason, count(*) AS n, count(*) FILTER (odd_label = 1) / count(*) AS rate
      FROM leaky GROUP BY reason),
    r AS (SELECT ship_year, avg(odd_label) AS rate, count(odd_label) AS n FROM leaky GROUP BY ALL),
    p AS (SELECT *, lag(rate) OVER (ORDER BY ship_year) AS before FROM r)
    SELECT 'constant' AS "check", 'constant' AS "column", NULL AS value, count(*) AS n,
      CAST(NULL AS DOUBLE) AS statistic FROM leaky
    UNION ALL SELECT 'category', 'reason', reason, n, round(rate, 6) FROM g, b
      WHERE n >= 30 AND rate >= 0.3 AND rate / base >= 5
    UNION ALL SELECT 'correlation', 'score', NULL, count(score), round(abs(corr(score, odd_label)), 6)
      FROM leaky HAVING abs(corr(score, odd_label)) > 0.9
    UNION ALL SELECT 'duplicate', 'price_copy', 'price', NULL, NULL
    UNION ALL SELECT 'duplicate', 'part_copy', 'part', NULL, NULL
    UNION ALL SELECT 'period_shift', 'ship_year', CAST(ship_year AS VARCHAR), n,
      round(rate / before - 1, 6) FROM p WHERE abs(rate / before - 1) > 4""",
)
def leakage_findings(spark, sf):
    df = leaky(spark, sf).drop(_RARE)
    found = R.leakage_findings(df, "odd_label")
    return rounded(found.select("check", "column", "value", "n", "statistic"))


# --- everything ---------------------------------------------------------------------------------

_KINDS = dict(zip(COLUMNS, ("bigint", "bigint", "int", *["double"] * 5, "string", "string", *["int"] * 4)))


def _number(c: str, sql: str) -> str:
    return sql.format(c=c) if c in NUMBERS else "NULL"


def _of_lines(columns, template: str) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


_POSITION = "min({{'a': order_key, 'b': line_number, 'c': part_key, 'd': price}})"
_SEEN = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS n, "
    f"count(*) FILTER (fraud_bool = 1) AS positives, {_POSITION.format()} AS first FROM lines GROUP BY {c}"
    for c in CATEGORICAL
)
_BEST = f"""(SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, first) AS rank,
    count(*) OVER (PARTITION BY "column") AS categories, sum(n) OVER (PARTITION BY "column") AS total FROM ({_SEEN}))"""
_LINE_FENCES = _of_lines(
    CONTINUOUS,
    "SELECT *, q1 - 1.5 * (q3 - q1) AS lower, q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT '{c}' AS \"column\", "
    "quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3, median({c}) AS m, count({c}) AS n FROM lines)",
)
_LINE_CELLS = _of_lines(CONTINUOUS, "SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM lines WHERE {c} IS NOT NULL")
#: Every table of the report as SQL over ``lines``: the column that names an item, numbers, texts, rows.
_REPORT = {
    "overview.size": (None, "n columns", "", 'SELECT NULL AS "column", count(*) AS n, 14 AS "columns" FROM lines'),
    "overview.columns": (None, "ordinal", "type", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {i} AS ordinal, '{t}' AS type" for i, (c, t) in enumerate(_KINDS.items()))),
    "data_quality.columns": (None, "missing missing_share neg_one other_negative", "is_constant", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing, 1 - count({c}) / count(*) AS missing_share, "
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) <= 1 AS is_constant, "
        f"{_number(c, 'count(*) FILTER ({c} = -1)')} AS neg_one, "
        f"{_number(c, 'count(*) FILTER ({c} < 0 AND {c} <> -1)')} AS other_negative FROM lines" for c in COLUMNS)),
    "data_quality.duplicates": (None, "n duplicates share", "",
        "SELECT NULL AS \"column\", sum(k) AS n, sum(k - 1) AS duplicates, sum(k - 1) / sum(k) AS share "
        "FROM (SELECT count(*) AS k FROM lines GROUP BY " + ", ".join(COLUMNS) + ")"),
    "feature_profile.columns": (None, "distinct missing missing_share mean std min max", "type", " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS type, count(DISTINCT {c}) AS \"distinct\", count(*) - count({c}) AS missing, "
        f"1 - count({c}) / count(*) AS missing_share, {_number(c, 'avg({c})')} AS mean, {_number(c, 'stddev_samp({c})')} AS std, "
        f"{_number(c, 'min({c})')} AS min, {_number(c, 'max({c})')} AS max FROM lines" for c, t in _KINDS.items())),
    "feature_profile.most_common": ("value", "categories n", "", f"""SELECT * FROM (SELECT "column", value, n,
        row_number() OVER (PARTITION BY "column" ORDER BY n DESC, first) AS k, count(*) OVER (PARTITION BY "column") AS categories
        FROM ({_SEEN}) WHERE value IS NOT NULL AND "column" IN ('flag', 'status')) WHERE k = 1"""),
    "target.counts": ("value", "n share", "", """SELECT NULL AS "column", fraud_bool AS value, count(*) AS n,
        count(*) / (SELECT count(*) FROM lines) AS share FROM lines GROUP BY fraud_bool"""),
    "target.balance": (None, "n positives negatives positive_rate negative_rate imbalance_ratio", "", """SELECT NULL AS "column",
        n, p AS positives, n - p AS negatives, p / n AS positive_rate, (n - p) / n AS negative_rate, (n - p) / p AS imbalance_ratio
        FROM (SELECT count(*) AS n, count(*) FILTER (fraud_bool = 1) AS p FROM lines)"""),
    "categorical.counts": ("value", "n share positive_rate rank categories hidden", "", f"""SELECT "column", value, n, n / total AS share,
        positives / n AS positive_rate, rank, categories, greatest(categories - 15, 0) AS hidden FROM {_BEST} WHERE rank <= 15"""),
    "numeric.summary": (None, "n mean median std min max p5 p25 p75 p95 zeros zero_share neg_ones neg_one_share", "", f"SELECT * FROM ({_SUMMARY})"),
    "temporal.periods": ("period", "n share positive_rate", "", _of_lines(
        ("ship_month", "ship_year"),
        "SELECT '{c}' AS \"column\", {c} AS period, count(*) AS n, count(*) / (SELECT count(*) FROM lines) AS share, "
        "count(*) FILTER (fraud_bool = 1) / count(*) AS positive_rate FROM lines GROUP BY {c}")),
    "temporal.row_order": (None, "", "direction", " UNION ALL ".join(
        _ORDER.format(name=c, value=c, by="order_key, line_number, part_key, price", table="lines") for c in ("ship_month", "ship_year"))),
    "relationships.categories": ("value", "n positive_rate rank", "",
        f'SELECT "column", value, n, positives / n AS positive_rate, rank FROM {_BEST} WHERE rank <= 8'),
    "relationships.numbers": (None, "pos_n pos_mean pos_median neg_n neg_mean neg_median", "comparable", f"SELECT * FROM ({ORACLES['a24_label_by_numeric']})"),
    "outliers.fences": (None, "q1 q3 lower upper n outliers share", "", f"""SELECT *, outliers / n AS share FROM (
        SELECT f."column", q1, q3, lower, upper, n, sum(CAST(v < lower OR v > upper AS INTEGER)) AS outliers
        FROM ({_LINE_FENCES}) f JOIN ({_LINE_CELLS}) x ON f."column" = x."column" GROUP BY ALL)"""),
    "outliers.extremes": ("value", "distance rank", "", f"""SELECT * FROM (SELECT f."column", v AS value, abs(v - m) AS distance,
        row_number() OVER (PARTITION BY f."column" ORDER BY abs(v - m) DESC, v DESC) AS rank
        FROM ({_LINE_FENCES}) f JOIN ({_LINE_CELLS}) x ON f."column" = x."column" WHERE v < lower OR v > upper) WHERE rank <= 5"""),
    "leakage.findings": ("check", "n statistic", "detail", """SELECT 'constant' AS "check", 'constant' AS "column", count(*) AS n,
        NULL AS statistic, 'one value only, no signal' AS detail FROM lines"""),
}


def _report_sql() -> str:
    parts = []
    for name, (item, numbers, texts, sql) in _REPORT.items():
        analysis, part = name.split(".")
        for metric in (*numbers.split(), *texts.split()):
            number = f'round(CAST("{metric}" AS DOUBLE), 4) + 0.0' if metric in numbers.split() else "CAST(NULL AS DOUBLE)"
            text = f'CAST("{metric}" AS VARCHAR)' if metric in texts.split() else "CAST(NULL AS VARCHAR)"
            named = f'CAST("{item}" AS VARCHAR)' if item else "CAST(NULL AS VARCHAR)"
            parts.append(f"""SELECT '{analysis}' AS analysis, '{part}' AS part, CAST("column" AS VARCHAR) AS "column", {named} AS item,
                '{metric}' AS metric, {number} AS number, {text} AS text, 'ok' AS status FROM {name.replace('.', '_')}""")
    tables = ", ".join(f"{name.replace('.', '_')} AS MATERIALIZED ({sql})" for name, (*_, sql) in _REPORT.items())
    return f"WITH {LINES}, {tables} " + " UNION ALL ".join(parts)


@query("a33_run_all", _report_sql())
def run_everything(spark, sf):
    """All tables of the report with every metric, numbers rounded."""
    every = R.run_all(lines(spark, sf), TARGET, order_by=["order_key", "line_number", "part_key", "price"], materialize_input=True)
    texts = F.concat(F.col("analysis"), F.lit("."), F.col("part"), F.lit(" "), F.col("metric")).isin(
        [f"{name} {metric}" for name, (_, _, words, _) in _REPORT.items() for metric in words.split()]
    )
    number = F.round(F.when(~texts, F.col("value")).cast("double"), 4) + F.lit(0.0)
    return every.long.select(
        "analysis", "part", "column", "item", "metric", number.alias("number"), F.when(texts, F.col("value")).alias("text"), "status"
    )


@query(
    "a24_boolean_label_odd_names",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count({c}) FILTER (hit) AS pos_n, count({c}) FILTER (NOT hit) AS neg_n,
        round(avg({c}) FILTER (hit), 4) + 0.0 AS pos_mean, round(avg({c}) FILTER (NOT hit), 4) + 0.0 AS neg_mean
        FROM (SELECT *, coalesce(l_returnflag = 'R' AND l_linenumber <> 7, false) AS hit FROM lineitem)"""
        for name, c in {"y": "l_quantity", "pos": "l_discount", "a.b": "l_tax", "x": "l_extendedprice"}.items()
    ),
)
def odd_names(spark, sf):
    """A true/false label, and columns named like what the operators keep inside."""
    c = F.col
    df = table(spark, sf, "lineitem").select(
        c("l_quantity").alias("y"), c("l_discount").alias("pos"), c("l_tax").alias("a.b"), c("l_extendedprice").alias("x"),
        F.when(c("l_linenumber") != 7, c("l_returnflag") == "R").alias(TARGET),
    )
    sides = R.label_by_numeric(df, ["y", "pos", "a.b", "x"], TARGET)
    means = [(F.round(m, 4) + 0.0).alias(m) for m in ("pos_mean", "neg_mean")]
    return sides.select("column", "pos_n", "neg_n", *means)
