"""One state per column against the separate operators, and what it is built from."""

import math
import random

import pytest
from pyspark.sql import functions as F

import riskframe as R
from riskframe.operators import categories as C
from riskframe.operators import quantiles as Q
from riskframe.operators import temporal
from riskframe.operators.state import TableState


def odd_table(spark, rows=700, seed=4):
    """Gaps, a constant, a copy, large whole numbers, an id-like text, ties, infinities and clashing names."""
    rng = random.Random(seed)
    data = []
    for i in range(rows):
        data.append((
            i, (1 << 60) + i % 2, rng.choice([None, 1.5, -1.0, 0.0, -2.0]), rng.gauss(0, 1) if rng.random() < 0.9 else rng.choice([math.inf, -math.inf, math.nan]),
            f"id{i}", rng.choice(["a", "b", None]), rng.randrange(12) + 1, 7, None, rng.random() < 0.5, float(i), rng.choice([0, 1, None]),
        ))
    schema = "seq long, big long, few double, wide double, name string, rows string, month int, constant int, hollow int, flag boolean, copy double, fraud_bool int"
    return spark.createDataFrame(data, schema).repartition(3)


@pytest.fixture(scope="module")
def table(spark):
    return odd_table(spark).cache()


def rows(df, *columns):
    near = lambda v: round(v, 9) if isinstance(v, float) and math.isfinite(v) else str(v) if isinstance(v, float) else v
    return sorted((tuple(near(r[c]) for c in columns) for r in df.collect()), key=str)


def test_states_give_what_the_operators_give(spark, table):
    state = TableState(table, "fraud_bool", 1, ["seq"])
    assert state.rows == 700 and state.class_balance()[:3] == tuple(R.class_balance(table, "fraud_bool").first())[:3]
    names = ("column", "type", "missing", "missing_share", "is_constant", "neg_one", "other_negative", "mean", "std", "min", "max")
    got = spark.createDataFrame(state.column_rows(), R.column_scan(table).select(*names).schema)
    # The moments of a column with infinities are not numbers on either side.
    assert rows(got.filter("column <> 'wide'"), *names) == rows(R.column_scan(table).filter("column <> 'wide'"), *names)
    assert state.distinct == dict.fromkeys(table.columns, 0) | {r["column"]: r["distinct"] for r in C.distinct_counts(table).collect()}
    found = {r["column"]: r["role"] for r in R.classify_columns(table, ["fraud_bool"]).collect()}
    assert {c: "categorical" for c in state.roles[0]} | {c: "continuous" for c in state.roles[1]} == found
    assert state.periods == ["month"] and not state.constants["big"] and state.constants["constant"] and state.constants["hollow"]
    assert rows(R.label_by_numeric(table, ["seq", "copy"], "fraud_bool"), "column", "pos_n", "pos_median", "neg_n", "neg_median") == [
        (c, *(v for side in ("pos", "neg") for v in (state.states[c][f"{side}_rows"], state.spread[f"{side} {c}"][2]))) for c in ("copy", "seq")
    ]
    want = {r["column"]: (r["n"], round(r["r"], 9)) for r in R.label_correlations(table, ["seq", "copy"], "fraud_bool").collect()}
    assert {c: (n, round(r, 9)) for c, n, r in state.correlations() if c != "wide"} == want
    assert state.near_duplicates() == [tuple(r) for r in R.near_duplicates(table, state.roles[1]).collect()] == [("copy", "seq")]
    assert rows(state.period_counts().withColumn("period", F.col("period").cast("int")), "period", "n", "share", "positive_rate") == rows(
        R.period_counts(table, "month", "fraud_bool"), "period", "n", "share", "positive_rate")
    assert rows(state.class_counts(), "value", "n", "share") == rows(R.class_counts(table, "fraud_bool"), "value", "n", "share")


@pytest.mark.parametrize("order_by", [(), ("seq",), ("month", "seq")])
def test_top_categories(table, order_by):
    state = TableState(table, "fraud_bool", 1, order_by)
    columns = ["few", "rows", "month", "name", "flag", "hollow"]
    names = ("column", "value", "n", "share", "positive_rate", "rank", "categories", "hidden")
    want = R.category_counts(table, columns, "fraud_bool", top=4, order_by=list(order_by))
    assert rows(state.top_categories(columns, 4), *names) == rows(want, *names)


@pytest.mark.parametrize("order_by", [(), ("seq",), ("month", "seq")])
def test_counts_are_shuffled_once(spark, table, tmp_path, order_by):
    table.write.parquet(str(tmp_path / "t"))
    plan = R.category_counts(spark.read.parquet(str(tmp_path / "t")), ["name", "rows"], "fraud_bool", top=3, order_by=list(order_by))
    plan.collect()
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text


def test_no_rows_and_no_label(spark):
    empty = odd_table(spark).limit(0)
    state = TableState(empty, "fraud_bool")
    assert state.rows == 0 and state.class_balance() == (0, 0, 0, 0.0, 0.0, None) and set(state.distinct.values()) == {0}
    report = R.run_all(empty, order_by=["seq"])
    assert {r.status for r in report.status.collect()} == {"ok"}
    assert report.tables["leakage.findings"].filter("check = 'constant'").count() == 11
    bare = R.run_all(odd_table(spark).drop("fraud_bool"))
    assert {r.status for r in bare.status.collect()} == {"ok", "skipped: no column fraud_bool"}


def test_distinct_by_bitmaps(spark):
    df = spark.range(200_000).select(
        (F.col("id") % 150_000 - 70_000).alias("dense"), (F.col("id") * 1_000_003).alias("sparse"),
        F.when(F.col("id") % 3 == 0, F.col("id").cast("int")).alias("gaps"), (F.col("id") % 5).cast("double").alias("real"), F.col("id").cast("string").alias("text"))
    ranges = {"dense": (-70_000.0, 79_999.0, 200_000), "sparse": (0.0, 2e11, 200_000), "gaps": (0.0, 199_998.0, 66_667)}
    found = C.distinct_counts(df, ranges=ranges)
    assert "bitmap_construct_agg" in found._jdf.queryExecution().toString()
    want = {"dense": 150_000, "sparse": 200_000, "gaps": 66_667, "real": 5, "text": 200_000}
    assert {r["column"]: r["distinct"] for r in found.collect()} == want
    assert {r["column"]: r["distinct"] for r in C.distinct_counts(df).collect()} == want
    assert not C._is_dense(0, 2**60, 10**9) and not C._is_dense(0, 10**9, 100) and C._is_dense(0, 10**6, 10**6)


def test_quantiles_over_rounds(spark, monkeypatch):
    """Sketches at work: ties, gaps and infinities, few values gathered at once, then none."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 7 != 0, F.hash("id").cast("double")).alias("a"), (F.col("id") % 3).cast("double").alias("ties"),
        F.when(F.col("id") % 10 == 0, math.inf).when(F.col("id") % 11 == 0, -math.inf).otherwise(F.col("id") / 7).alias("far"))
    cells, wanted = {c: F.col(c) for c in df.columns}, [0.0, 0.01, 0.25, 0.5, 0.95, 1.0]
    plain = {c: sorted(r[0] for r in df.select(c).dropna().collect()) for c in df.columns}
    want = {}
    for c, values in plain.items():
        at = [p * (len(values) - 1) for p in wanted]
        want[c] = [Q.between(values[math.floor(x)], values[math.ceil(x)], x - math.floor(x)) for x in at]
    for gather, at_once, straight in ((200_000, 20_000, 32), (200_000, 200, 32), (50, 20_000, 32), (50, 10, 4)):
        monkeypatch.setattr(Q, "GATHER_AT_ONCE", at_once)
        monkeypatch.setattr(Q, "_STRAIGHT", straight)
        assert Q.narrowed_quantiles(df, cells, wanted, gather) == want


def test_duplicates_by_digest(spark):
    df = odd_table(spark, 300).drop("seq", "name", "copy", "wide")
    for frame in (df, df.unionAll(df), df.limit(0), odd_table(spark, 50)):
        want = tuple(R.duplicate_rows(frame).first())
        assert tuple(R.duplicate_rows(frame, digest=True).first()) == want
        assert tuple(R.duplicate_rows(frame, digest=True, n=frame.count()).first()) == want


def test_orders_of_several_columns(spark):
    df = spark.createDataFrame([(i, i // 10, -(i // 10), None if i == 5 else 1, i % 3) for i in range(50)], "seq int, up int, down int, gap int, no int")
    got = {r["column"]: r["direction"] for r in temporal.row_orders(df, ["up", "down", "gap", "no"], ["seq"]).collect()}
    assert got == {"up": "increasing", "down": "decreasing", "gap": "none", "no": "none"}
    assert got == {c: R.row_order(df, c, ["seq"]).first()["direction"] for c in got}


def test_one_round_of_sketches_then_a_gather(spark, monkeypatch):
    """What is too much for the counting scan to bring along is gathered, not sketched again."""
    df = spark.range(60_000).select(F.hash("id").cast("double").alias("x"))
    asked = []
    monkeypatch.setattr(Q, "GATHER_AT_ONCE", 10)
    whole = Q._round
    monkeypatch.setattr(Q, "_round", lambda *args: asked.append(whole(*args)) or asked[-1])
    got = Q.narrowed_quantiles(df, {"x": F.col("x")}, [0.25, 0.5])["x"]
    assert asked == [True, False]
    values = sorted(r.x for r in df.collect())
    assert got == [Q.between(values[14_999], values[15_000], 0.75), Q.between(values[29_999], values[30_000], 0.5)]


def test_orders_look_at_the_ends_only(spark):
    """Whole positions are compared for the first and last rows of a value; leads may repeat, be null or no number."""
    odd = {3: None, 7: math.nan, 8: 0.0, 9: -0.0}
    rows = [(odd.get(i, float(i // 3)), i % 5, i // 50, None if i == 5 else 1) for i in range(200)]
    df = spark.createDataFrame(rows, "lead double, seq int, up int, gap int")
    for order_by in (["lead", "seq"], ["seq", "lead"], ["up", "seq"]):
        got = {r["column"]: r["direction"] for r in temporal.row_orders(df, ["up", "gap"], order_by).collect()}
        assert got == {c: R.row_order(df, c, order_by).first()["direction"] for c in got}
    long = df.filter("lead is not null").select(F.struct("lead", "seq").alias("__at"), F.col("lead").alias("__lead"), F.lit("up").alias("column"), F.col("up").cast("string").alias("value"))
    assert temporal._at_ends(long).count() < 30 < long.count()


def test_few_values_told_from_many(spark):
    """An estimate that never takes a column of few values for one of many, and has no sketch per column."""
    df = spark.range(5_000).select(
        (F.col("id") % 240).alias("most"), (F.col("id") % 400).alias("more"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("one"),
        F.lit(None).cast("int").alias("none"), F.when(F.col("id") < 9, math.nan).otherwise(F.col("id") / 3).alias("many"))
    state = TableState(df)
    assert state.few == ["most", "one", "none"]
    assert state._guess["one"] == 1 and state._guess["none"] == 0 and 200 < state._guess["most"] <= 240 < state._guess["more"] <= 400
