import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import riskframe as R
from riskframe.operators import quantiles as Q


def frame(spark, schema, rows):
    return spark.createDataFrame(rows, schema)


def by_column(df, key="column"):
    return {r[key]: r for r in df.collect()}


def numbers(spark, values, name="value"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


def test_overview(spark):
    df = frame(spark, "age int, city string", [(1, "a"), (2, "b"), (3, "c")])
    assert [(r.column, r.type) for r in R.overview(df).orderBy("ordinal").collect()] == [
        ("age", "int"), ("city", "string"),
    ]
    assert tuple(R.dataset_size(df).first()) == (3, 2)


def test_quality(spark):
    df = frame(spark, "a int, b string, c int", [(1, None, 5), (1, None, 5), (-2, "x", 5), (3, "y", 5)])
    missing = R.missing_values(df).collect()
    assert [tuple(r) for r in missing] == [("b", 2, 0.5)]
    for digest in (False, True):
        assert tuple(R.duplicate_rows(df, digest=digest).first()) == (4, 1, 0.25)
    assert [r.column for r in R.constant_columns(df).collect()] == ["c"]
    neg = by_column(R.negative_values(df))
    assert neg["a"].other_negative == 1 and neg["a"].other_negative_share == 0.25
    assert neg["a"].neg_one == 0 and "b" not in neg
    warnings = {r.warning: r.n for r in R.quality_warnings(df).collect()}
    assert warnings == {"constant_columns": 1, "duplicate_rows": 1}


def test_constant_and_null_columns(spark):
    df = frame(spark, "a int, b int, c double, d string", [(1, None, float("nan"), "x"), (1, 1, None, "y")])
    assert {r.column for r in R.constant_columns(df).collect()} == {"a", "c"}
    assert {r.column for r in R.constant_columns(df.limit(0)).collect()} == {"a", "b", "c", "d"}
    assert tuple(R.duplicate_rows(df.limit(0)).first()) == (0, 0, 0.0)


def test_duplicate_rows_keep_null_places_apart(spark):
    df = frame(spark, "a int, b int", [(None, 1), (1, None), (None, 1), (1, 1)])
    for digest in (False, True):
        assert R.duplicate_rows(df, digest=digest).first().duplicates == 1


def test_profile(spark):
    df = frame(spark, "age int, city string, num double, flag boolean",
               [(10, "Delhi", None, True), (20, "Delhi", None, False), (30, "Mumbai", None, True)])
    for mode in ("exact", "approximate"):
        stats = by_column(R.column_stats(df, mode))
        assert (stats["age"].mean, stats["age"].min, stats["age"].max) == (20.0, 10.0, 30.0)
        assert stats["age"].std == 10.0 and stats["age"].distinct == 3
        assert stats["num"].mean is None and stats["num"].distinct == 0 and stats["num"].missing == 3
        assert stats["flag"].mean is None and stats["flag"].distinct == 2
    one = R.column_stats(df.filter("age = 10")).filter("column = 'age'").first()
    assert one.std is None
    top = by_column(R.most_common(df))
    assert (top["city"].value, top["city"].n, top["city"].categories) == ("Delhi", 2, 2)
    assert top["flag"].value == "true"


def test_target(spark):
    df = frame(spark, "fraud_bool int", [(0,), (None,), (1,)])
    assert [(r.value, r.n) for r in R.class_counts(df, "fraud_bool").collect()] == [(0, 1), (1, 1), (None, 1)]
    b = R.class_balance(df, "fraud_bool").first()
    assert b.positive_rate == pytest.approx(1 / 3) and b.negative_rate == pytest.approx(2 / 3)
    assert b.imbalance_ratio == 2.0
    assert R.class_balance(df.filter("fraud_bool = 0"), "fraud_bool").first().imbalance_ratio is None
    with pytest.raises(ValueError):
        R.class_counts(df, "absent")


def test_categories(spark):
    df = frame(spark, "i int, category string, fraud_bool int", [(i, f"c{i}", i % 2) for i in range(20)])
    rows = R.category_counts(df, ["category"], "fraud_bool", order_by=["i"]).orderBy("rank").collect()
    assert [r.value for r in rows] == [f"c{i}" for i in range(15)]
    assert rows[0].categories == 20 and rows[0].hidden == 5 and rows[0].share == 0.05
    assert [r.positive_rate for r in rows[:2]] == [0.0, 1.0]
    named = R.category_counts(df, ["category"]).orderBy("rank").collect()
    assert [r.value for r in named[:3]] == ["c0", "c1", "c10"] and named[0].positive_rate is None
    df = frame(spark, "city string, x double, fraud_bool int",
               [("a", 1.0, 1), ("a", -0.0, None), (None, 0.0, 1), ("b", float("nan"), 0)])
    got = {(r.column, r.value): (r.n, r.positive_rate) for r in
           R.category_counts(df, ["city", "x"], "fraud_bool").collect()}
    assert got[("city", None)] == (1, 1.0) and got[("city", "a")] == (2, 0.5)
    assert got[("x", "0.0")] == (2, 0.5) and got[("x", None)] == (1, 0.0)


def test_roles(spark):
    df = spark.range(30).select(
        (F.col("id") % 2 == 0).alias("bool"), F.concat(F.lit("c"), "id").alias("cat"),
        (F.col("id") % 20).alias("low"), F.col("id").alias("num"), (F.col("id") % 2).alias("fraud_bool"),
        F.current_date().alias("day_seen"), F.lit(None).cast("double").alias("empty"),
    )
    roles = {r.column: r.role for r in R.classify_columns(df, ["fraud_bool"]).collect()}
    assert roles == {"bool": "categorical", "cat": "categorical", "low": "categorical",
                     "num": "continuous", "empty": "categorical"}
    names = ["month", "event_date", "report_time", "year", "prev_address_months_count", "amount"]
    df = spark.range(100).select(*[
        (F.col("id") if n == "event_date" else F.col("id") % 5).alias(n) for n in names])
    assert [r.column for r in R.temporal_columns(df).orderBy("ordinal").collect()] == ["month", "report_time", "year"]
    few = df.filter("id < 60") if "id" in df.columns else df.limit(60)
    assert [r.column for r in R.temporal_columns(few).orderBy("ordinal").collect()] == names[:4]


def test_numeric_summary(spark):
    df = numbers(spark, range(-1, 30))
    s = R.numeric_summary(df, ["value"]).first()
    assert (s.n, s.mean, s.median, s.zeros, s.neg_ones) == (31, 14.0, 14.0, 1, 1)
    assert s.zero_share == pytest.approx(1 / 31)
    want = np.quantile(np.arange(-1, 30), [0.05, 0.25, 0.75, 0.95])
    assert [s.p5, s.p25, s.p75, s.p95] == pytest.approx(list(want))
    none = R.numeric_summary(df.filter("value > 99"), ["value"]).first()
    assert (none.n, none.mean, none.p5, none.zero_share) == (0, None, None, 0.0)
    assert R.numeric_summary(df, []).count() == 0


@pytest.mark.parametrize("gather", [3, 50])
def test_narrowed_quantiles(spark, gather):
    rng = np.random.default_rng(7)
    third = np.where(rng.random(3000) < 0.34, 5.0, rng.normal(size=3000) * 100)
    shapes = {
        "skewed": np.exp(rng.normal(size=3000) * 5),
        "third": third,
        "two": rng.integers(0, 2, 3000).astype(float),
        "same": np.full(3000, 7.0),
        "ints": rng.integers(-10, 1000, 3000).astype(float),
    }
    rows = list(zip(*[[float(x) for x in v] for v in shapes.values()]))
    df = spark.createDataFrame(rows, ", ".join(f"{k} double" for k in shapes))
    df = df.withColumn("gaps", F.when(F.col("ints") % 2 == 0, F.col("ints"))).withColumn("none", F.lit(None).cast("double"))
    ps = [0.0, 0.05, 0.25, 0.5, 0.75, 0.951, 1.0]
    got = Q.narrowed_quantiles(df, {c: F.col(c) for c in df.columns}, ps, gather_rows=gather)
    for name, values in shapes.items():
        assert got[name] == pytest.approx(list(np.quantile(values, ps))), name
    even = shapes["ints"][shapes["ints"] % 2 == 0]
    assert got["gaps"] == pytest.approx(list(np.quantile(even, ps)))
    assert got["none"] == [None] * len(ps)


def test_narrowing_shrinks_wide_brackets(spark):
    df = spark.range(60000).select(((F.col("id") * 7919) % 60013).cast("double").alias("x"))
    values = np.array([r.x for r in df.collect()])
    got = Q.narrowed_quantiles(df, {"x": F.col("x")}, [0.1, 0.5, 0.9], gather_rows=8)
    assert got["x"] == pytest.approx(list(np.quantile(values, [0.1, 0.5, 0.9])))


def test_label_by_numeric(spark):
    df = spark.range(30).select(F.col("id").cast("int").alias("age"), (F.col("id") % 2).alias("fraud_bool"))
    r = R.label_by_numeric(df, ["age"], "fraud_bool").first()
    assert (r.pos_mean, r.neg_mean, r.pos_median, r.neg_median) == (15.0, 14.0, 15.0, 14.0)
    assert r.comparable is True
    lonely = R.label_by_numeric(df, ["age"], "fraud_bool", positive=9).first()
    assert lonely.comparable is False and lonely.pos_mean is None


def test_label_by_category(spark):
    df = frame(spark, "city string, fraud_bool int", [(f"c{i // 2}", i % 2) for i in range(30)])
    rows = R.label_by_category(df, ["city"], "fraud_bool").collect()
    assert len(rows) == 8 and all(r.positive_rate == 0.5 and r.n == 2 for r in rows)


def test_outliers(spark):
    df = numbers(spark, [*range(1, 31), 100])
    o = R.iqr_outliers(df, ["value"]).first()
    q1, q3 = np.quantile([*range(1, 31), 100], [0.25, 0.75])
    assert (o.outliers, o.n) == (1, 31) and o.lower == q1 - 1.5 * (q3 - q1)
    assert [r.value for r in R.extreme_values(df, ["value"]).collect()] == [100.0]
    many = numbers(spark, [*range(50), *[1000] * 4, -900, 700, 701])
    assert [r.value for r in R.extreme_values(many, ["value"]).orderBy("rank").collect()] == [1000.0] * 4 + [-900.0]
    empty = R.iqr_outliers(df.filter("value > 1000"), ["value"]).first()
    assert (empty.n, empty.outliers, empty.lower, empty.share) == (0, 0, None, 0.0)
    assert R.extreme_values(df.filter("value > 1000"), ["value"]).count() == 0


def test_period_counts(spark):
    df = frame(spark, "month int, fraud_bool int", [(1, 0), (1, 0), (2, 1), (None, 1)])
    got = [(r.period, r.n, r.share, r.positive_rate) for r in R.period_counts(df, "month", "fraud_bool").collect()]
    assert got == [(1, 2, 0.5, 0.0), (2, 1, 0.25, 1.0), (None, 1, 0.25, 1.0)]


@pytest.mark.parametrize(
    "values,direction",
    [
        ([1, 1, 2], "increasing"), ([3, 2, 1], "decreasing"), ([2, 1, 3], "none"), ([4, 4, 4], "increasing"),
        ([1, None, 2], "none"), (list(range(200)), "increasing"), (list(range(200, 0, -1)), "decreasing"),
        ([*range(99), 100, 99, *range(101, 200)], "none"), ([], "increasing"), ([5, 5, 3, 3], "decreasing"),
        ([1, 1, 2, 1, 2], "none"),
    ],
)
def test_row_order(spark, values, direction):
    df = spark.createDataFrame([(i // 7, i % 7, v) for i, v in enumerate(values)], "a int, b int, v int")
    assert R.row_order(df, "v", ["a", "b"]).first().direction == direction


def test_leakage(spark):
    df = spark.range(30).select(
        F.lit(1).alias("constant"), F.col("id").alias("feature"), F.col("id").cast("double").alias("duplicate"),
        (F.col("id") % 2).alias("fraud_bool"))
    found = {(r.check, r.column, r.value) for r in R.leakage_findings(df, "fraud_bool").collect()}
    assert found == {("constant", "constant", None), ("duplicate", "duplicate", "feature")}
    df = spark.range(100).select(
        F.when(F.col("id") < 50, F.col("id")).otherwise(F.col("id") + 1000).alias("feature"),
        (F.col("id") >= 50).cast("int").alias("fraud_bool"))
    rows = R.leakage_findings(df, "fraud_bool").collect()
    assert [r.check for r in rows] == ["correlation"] and rows[0].statistic > 0.9
    df = spark.range(200).select(
        F.when(F.col("id") < 100, 1).otherwise(2).alias("month"),
        ((F.col("id") >= 100) | (F.col("id") == 0)).cast("int").alias("fraud_bool"), F.col("id").alias("x"))
    shifts = R.leakage_findings(df, "fraud_bool").filter("check = 'period_shift'").collect()
    assert [(r.column, r.value, round(r.statistic)) for r in shifts] == [("month", "2", 99)]
    calm = spark.range(100).select((F.col("id") * 31 % 97).alias("x"), (F.col("id") % 2).alias("fraud_bool"))
    assert [r.check for r in R.leakage_findings(calm, "fraud_bool").collect()] == ["none"]


def test_correlation_edge_cases(spark):
    df = frame(spark, "x double, c double, y int", [(1.0, 3.0, 0), (2.0, 3.0, 1), (None, 3.0, 1), (9.0, 3.0, None), (3.0, 3.0, 1)])
    r = by_column(R.label_correlations(df, ["x", "c"], "y"))
    assert r["x"].r == pytest.approx(np.corrcoef([1, 2, 3], [0, 1, 1])[0, 1]) and r["x"].n == 3
    assert r["c"].r is None
    assert [q.column for q in R.high_correlations(df, ["x", "c"], "y", threshold=0.5).collect()] == ["x"]


def test_majority_positive_category(spark):
    df = spark.range(1000).select(
        F.when(F.col("id") < 40, "back").when(F.col("id") < 60, None).otherwise("ok").alias("reason"),
        (F.col("id") < 50).cast("int").alias("y"))
    rows = R.majority_positive_categories(df, ["reason"], "y").collect()
    assert [(r.value, r.n, r.positive_rate, r.baseline, r.lift) for r in rows] == [("back", 40, 1.0, 0.05, 20.0)]
    small = R.majority_positive_categories(df, ["reason"], "y", min_rows=20).collect()
    assert {r.value for r in small} == {"back", None}
    no_label = df.withColumn("y", F.lit(0))
    assert R.majority_positive_categories(no_label, ["reason"], "y").count() == 0


def test_near_duplicates(spark):
    df = spark.range(300).select(
        F.col("id").alias("i"), F.col("id").cast("int").alias("a"), F.col("id").cast("double").alias("b"),
        F.when(F.col("id") == 250, -1).otherwise(F.col("id")).alias("c"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("d"),
        F.when(F.col("id") % 3 > 0, F.col("id")).otherwise(-999999).alias("e"))
    cols = list("abcde")
    assert {tuple(r) for r in R.near_duplicates(df, cols).collect()} == {("b", "a")}
    assert R.near_duplicates(df, []).count() == 0


def test_period_shifts(spark):
    rates = {1: [0, 0], 2: [1, 0], 3: [None], 4: [1, 1], 5: [1] + [0] * 9, 6: [1] * 6}
    rows = [(m, y) for m, ys in rates.items() for y in ys] + [(None, 1)]
    df = frame(spark, "month int, y int", rows)
    got = {r.period: r.change for r in R.period_shifts(df, "month", "y").collect()}
    assert got == {"2": math.inf, "6": pytest.approx(9.0)}
    drops = R.period_shifts(df, "month", "y", min_drop=0.8).collect()
    assert {r.period for r in drops} == {"2", "5", "6"}


def test_run_all(spark):
    df = spark.range(300).select(
        F.col("id").alias("seq"), (F.col("id") % 12 + 1).cast("int").alias("month"),
        F.concat(F.lit("g"), F.col("id") % 3).alias("grp"), (F.col("id") * 1.5).alias("size"),
        (F.col("id") % 5 == 0).cast("int").alias("fraud_bool"))
    result = R.run_all(df, order_by=["seq"], materialize_input=True)
    assert {r.status for r in result.status.collect()} == {"ok"}
    assert {r.analysis for r in result.long.select("analysis").distinct().collect()} == {
        "overview", "data_quality", "feature_profile", "target", "categorical", "numeric",
        "temporal", "relationships", "outliers", "leakage"}
    n = result.long.filter("analysis = 'overview' and metric = 'n'").first()
    assert n.value == "300"
    broken = F.when(F.col("seq") >= 0, F.raise_error(F.lit("bad cell"))).cast("string")
    bare = R.run_all(df.drop("fraud_bool").withColumn("odd", broken))
    states = {(r.analysis, r.part): r.status for r in bare.status.collect()}
    assert states["target", "balance"].startswith("skipped")
    assert states["data_quality", "duplicates"].startswith("failed")
    assert states["overview", "size"] == "ok"
    assert states["numeric", "summary"] == "ok"
    assert bare.long.filter("status like 'failed%'").count() >= 1


def test_quantiles_of_extremes(spark):
    inf = float("inf")
    cases = {
        (1.0, 2.0, inf, inf, inf): [1.0, 2.0, inf, inf, inf],
        (-inf, -inf, 1.0, 2.0, 3.0): [-inf, -inf, 1.0, 2.0, 3.0],
        (1e308, -1e308, 1e308, 1e308, 1e308): [-1e308, 1e308, 1e308, 1e308, 1e308],
    }
    for values, want in cases.items():
        df = numbers(spark, values)
        got = Q.quantiles(df, {"value": F.col("value")}, [0.0, 0.25, 0.5, 0.75, 1.0])
        assert got["value"] == want


@pytest.mark.parametrize("kind,positive", [("boolean", 1), ("boolean", True), ("int", 1), ("double", 1), ("string", "yes")])
def test_every_kind_of_label(spark, kind, positive):
    hit = F.col("id") % 3 == 0
    label = {"boolean": hit, "string": F.when(hit, "yes").otherwise("no")}.get(kind, hit.cast(kind if kind in ("int", "double") else "int"))
    df = spark.range(300).select(
        F.when(hit, "a").otherwise("b").alias("city"), (F.col("id") % 12).cast("int").alias("month"),
        F.col("id").alias("y"), (F.col("id") * 2).alias("pos"), (F.col("id") * 3).cast("double").alias("a.b"),
        F.col("id").cast("double").alias("x"), label.alias("fraud_bool"),
    )
    assert R.class_balance(df, "fraud_bool", positive).first().positives == 100
    rates = {r.value: r.positive_rate for r in R.category_counts(df, ["city"], "fraud_bool", positive).collect()}
    assert rates == {"a": 1.0, "b": 0.0}
    assert R.period_counts(df, "month", "fraud_bool", positive).count() == 12
    assert R.label_by_category(df, ["city"], "fraud_bool", positive).count() == 2
    names = ["y", "pos", "a.b", "x"]
    sides = {r.column: (r.pos_n, r.neg_n) for r in R.label_by_numeric(df, names, "fraud_bool", positive).collect()}
    assert sides == dict.fromkeys(names, (100, 200))
    assert {r.column for r in R.label_correlations(df, names, "fraud_bool", positive).collect()} == set(names)
    assert [tuple(r) for r in R.near_duplicates(df, names).collect()] == [("x", "y")]
    assert R.leakage_findings(df, "fraud_bool", positive).filter("check = 'duplicate'").count() == 1


def test_period_shifts_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(4000).select((F.col("id") / 4).cast("int").alias("period"), F.when(F.col("id") % 40 >= 8, None).otherwise(
            F.when(F.col("id") >= 2000, 1).otherwise(0)).alias("fraud_bool"))
        got = R.period_shifts(df, "period", "fraud_bool").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [(r.period, r.rate, r.previous_rate) for r in got] == [("500", 1.0, 0.0)]


def test_row_order_with_tied_positions(spark):
    df = frame(spark, "at int, month int", [(1, 1), (1, 2), (2, 2), (2, 3)])
    assert R.row_order(df, "month", ["at"]).first().direction == "increasing"
