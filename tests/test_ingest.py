import csv

import random
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskframe.contract import CANONICAL_FIELDS, CHANNELS, REQUIRED_FIELDS
from riskframe.operators import mappings as M
from riskframe.operators import validation as V
from riskframe.operators.dedupe import duplicate_counts, first_per_key
from riskframe.plans.ingest import Source, ingest, ingest_folder
from riskframe.sources import files, routing, sinks

POS_ROW = {
    "transaction_id": "S-501", "customer_id": "K-88", "amount": "18.25", "currency": "gbp",
    "timestamp": "2025-11-30T23:59:01", "location": "kiosk-4", "merchant_id": "m-310",
    "card_last4": "0077", "card_type": "MC", "payment_method": "TAP", "authorization_code": "Q9Z",
    "response_code": "05",
}
ATM_ROW = {
    "transaction_id": "W-77", "customer_id": "K-89", "amount": "60.00", "currency": "CHF",
    "timestamp": "15/06/2025 08:30:00", "terminal_id": "t-12", "card_last4": "4411",
    "card_type": "VISA", "transaction_type": "BALANCE", "response_code": "00",
}
ONLINE_ROW = {
    "transaction_id": "N-3", "customer_id": "K-90", "amount": "2,480.10", "currency": "sek",
    "timestamp": "2025-12-24 18:05:00", "merchant_id": "m-7", "card_last4": "8080",
    "card_type": "AMEX", "merchant_category": "travel", "channel": "WEB",
    "transaction_status": "SETTLED",
}
RECORD = {
    "transaction_id": "R-9", "customer_id": "K-91", "channel": "POS", "amount": "7.75",
    "currency": "USD", "timestamp": "2025-10-01T12:00:00", "merchant_id": "m-1", "card_last4": "9090",
}


def src(*paths, mapping=None):
    return [Source(str(p), mapping=mapping) for p in paths]


def put(path, *rows, header=None):
    with open(path, "w", newline="") as out:
        writer = csv.DictWriter(out, header or list(rows[0]))
        writer.writeheader()
        writer.writerows(rows)
    return str(path)


@pytest.fixture()
def folder(tmp_path):
    put(tmp_path / "pos_transactions.csv", POS_ROW)
    put(tmp_path / "atm_transactions.csv", ATM_ROW)
    put(tmp_path / "online_transactions.csv", ONLINE_ROW)
    return tmp_path


def records(spark, *changes):
    names = sorted({k for c in changes for k in c} | set(RECORD))
    rows = [[i] + [({**RECORD, **c}).get(n) for n in names] for i, c in enumerate(changes)]
    return spark.createDataFrame(rows, ", ".join(["__i int"] + [f"{n} string" for n in names]))


def outcome(spark, *changes, **options):
    rows = V.validate(records(spark, *changes), **options).orderBy("__i").collect()
    return [r.reject.field or "<record>" if r.reject else None for r in rows]


def test_merges_sources(spark, folder):
    names = ["pos", "atm", "online"]
    result = ingest(spark, {n: folder / f"{n}_transactions.csv" for n in names})
    rows = {r.transaction_id: r for r in result.records.collect()}
    assert result.records.columns == list(CANONICAL_FIELDS)
    assert {r.channel for r in rows.values()} == set(CHANNELS)
    assert rows["S-501"].amount == 18.25 and rows["S-501"].currency == "GBP"
    assert rows["S-501"].card_last4 == "0077" and rows["S-501"].response_code == "05"
    assert rows["S-501"].terminal_id is None and rows["S-501"].raw_source_data is None
    assert rows["W-77"].timestamp == "2025-06-15T08:30:00"
    assert rows["W-77"].payment_method == "BALANCE" and rows["W-77"].merchant_id is None
    assert rows["N-3"].amount == 2480.1 and rows["N-3"].payment_method == "WEB"
    assert rows["N-3"].response_code == "SETTLED" and rows["N-3"].location is None
    total = result.totals().first()
    assert (total.sources, total.rows_read, total.records, total.ok) == (3, 3, 3, True)


def test_first_id_wins_across_sources(spark, folder):
    again = put(folder / "pos_duplicate.csv", {**POS_ROW, "amount": "77.70"})
    paths = [folder / "pos_transactions.csv", again]
    result = ingest(spark, src(*paths))
    assert [r.amount for r in result.records.collect()] == [18.25]
    report = result.source_report().orderBy("source_ordinal").collect()
    assert [r.duplicates_removed for r in report] == [0, 1]
    assert [r.valid for r in report] == [1, 1]
    assert ingest(spark, src(*paths), dedupe=False).records.count() == 2


def test_rejected_rows_do_not_claim_ids(spark, folder):
    path = put(folder / "pos_mixed.csv", {**POS_ROW, "currency": "kroner"}, POS_ROW,
               {**POS_ROW, "transaction_id": "S-502", "amount": "free"})
    result = ingest(spark, src(path))
    assert result.records.count() == 1
    rejects = result.rejects.orderBy("row_index").collect()
    assert [(r.source, r.row_index, r.field, r.value) for r in rejects] == [
        ("pos_mixed", 0, "currency", "kroner"), ("pos_mixed", 2, "amount", "free"),
    ]
    assert rejects[1].record.transaction_id == "S-502"
    assert {r.field: r.n for r in result.field_counts().collect()} == {"currency": 1, "amount": 1}
    metrics = result.metrics().first()
    assert (metrics.total, metrics.invalid, metrics.is_valid) == (3, 2, False)
    once = result.materialized()
    assert once.records.count() == 1 and once.rejects.count() == 2


def test_reject_positions_over_many_blocks(spark, folder):
    rows = [
        {**POS_ROW, "transaction_id": f"p{i}", "card_last4": "98" if i % 37 == 5 else "0077"}
        for i in range(2000)
    ]
    path = put(folder / "pos_many.csv", *rows)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        result = ingest(spark, src(path))
        got = sorted(r.row_index for r in result.rejects.select("row_index").collect())
        assert result.annotated.rdd.getNumPartitions() > 4
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [i for i in range(2000) if i % 37 == 5]


def test_bad_amount_can_fail_the_source(spark, folder):
    bad = put(folder / "pos_bad.csv", POS_ROW, {**POS_ROW, "amount": "n0ne"})
    paths = [bad, folder / "atm_transactions.csv"]
    result = ingest(spark, src(*paths), on_bad_amount="fail_source")
    report = result.source_report().orderBy("source_ordinal").collect()
    assert [(r.status, r.rows_read, r.valid, r.invalid) for r in report] == [
        ("FAILED", 2, 0, 0), ("ok", 1, 1, 0),
    ]
    assert "n0ne" in report[0].error
    assert [r.transaction_id for r in result.records.collect()] == ["W-77"]
    total = result.totals().first()
    assert total.failed_sources == 1 and total.ok is False
    assert ingest(spark, src(*paths)).records.count() == 2


def test_failed_sources_do_not_stop_the_others(spark, folder):
    thin = put(folder / "pos_thin.csv", {"transaction_id": "x", "amount": "1"})
    (folder / "pos_empty.csv").write_text("")
    paths = [thin, folder / "pos_absent.csv", folder / "pos_empty.csv",
             folder / "pos_transactions.csv"]
    result = ingest(spark, src(*paths))
    report = result.source_report().orderBy("source_ordinal").collect()
    assert [r.status for r in report] == ["FAILED", "FAILED", "FAILED", "ok"]
    assert [r.rows_read for r in report] == [1, 0, 0, 1]
    assert "customer_id" in report[0].error and "FileNotFound" in report[1].error
    with pytest.raises(ValueError):
        ingest(spark, src(thin), raise_on_error=True)
    with pytest.raises(FileNotFoundError):
        ingest(spark, src(folder / "pos_absent.csv"), raise_on_error=True)
    assert ingest(spark, src(thin)).records.count() == 0


def test_folder_routing(spark, folder):
    (folder / "nested.csv").mkdir()
    listed = files.discover_csv(spark, str(folder)).collect()
    assert [r.file_name for r in listed] == [
        "atm_transactions.csv", "online_transactions.csv", "pos_transactions.csv",
    ]
    result = ingest_folder(spark, str(folder))
    assert result.records.count() == 3
    with pytest.raises(FileNotFoundError):
        files.discover_csv(spark, str(folder / "absent"))
    with pytest.raises(NotADirectoryError):
        files.discover_csv(spark, str(folder / "pos_transactions.csv"))
    with pytest.raises(FileNotFoundError):
        files.discover_csv(spark, str(folder / "nested.csv"))


def test_detect_mapping(spark):
    names = ["pos_2026.csv", "atm.csv", "Online-3.csv", "deposit_atm.csv", "posmarch.csv", "other.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    for match, expected in [
        ("token", ["pos", "atm", "online", "atm", "pos", None]),
        ("substring", ["pos", "atm", "online", "pos", "pos", None]),
    ]:
        got = [r.k for r in df.select(routing.route(F.col("n"), match=match).alias("k")).collect()]
        assert got == expected
        assert [routing.detect_mapping("/d/" + n, match=match) for n in names[:-1]] == expected[:-1]
    with pytest.raises(ValueError):
        routing.detect_mapping("other.csv")


def test_sources_forms_and_registry(spark, folder):
    pos = str(folder / "pos_transactions.csv")
    frame = spark.createDataFrame([POS_ROW]).withColumn("seq", F.lit(7))
    result = ingest(spark, [*src(pos), *src(pos, mapping="POS"), Source(name="f", mapping="pos", frame=frame, position=F.col("seq"))])
    report = result.source_report().orderBy("source_ordinal").collect()
    assert [(r.source, r.valid, r.duplicates_removed) for r in report] == [
        ("pos_transactions", 1, 0), ("pos_transactions", 1, 1), ("f", 1, 1),
    ]
    with pytest.raises(TypeError):
        ingest(spark, [1234])
    with pytest.raises(ValueError):
        ingest(spark, src(pos, mapping="wire"))

    def wire(df):
        return df.select("*", F.lit("ATM").alias("channel"), F.lit("x").alias("unexpected"))

    registry = M.register(M.DEFAULT_MAPPINGS, "Wire", M.SourceMapping("WIRE", ("transaction_id",), wire))
    with pytest.raises(TypeError):
        M.register(registry, "x", object())
    raw = put(folder / "wire_1.csv", {k: POS_ROW[k] for k in ("transaction_id", "customer_id", "amount", "currency", "timestamp")})
    result = ingest(spark, src(raw), mappings=registry)
    assert result.records.first().channel == "ATM"
    assert ingest(spark, src(raw), mappings=registry, strict=True).rejects.first().field is None


def test_raw_capture(spark, folder):
    result = ingest(spark, src(folder / "online_transactions.csv"), include_raw=True)
    raw = result.records.first().raw_source_data
    assert raw["merchant_category"] == "travel" and raw["amount"] == "2,480.10"
    assert set(raw) == set(ONLINE_ROW)


def test_header_names_are_stripped(spark, folder):
    header = [(" amount" if c == "amount" else c) for c in POS_ROW]
    path = put(folder / "pos_spaced.csv", dict(zip(header, POS_ROW.values())))
    assert ingest(spark, src(path)).records.first().amount == 18.25


def test_validation_rules(spark):
    assert outcome(
        spark, {}, {"channel": "online banking"}, {"amount": "$1,250.75"},
        {"timestamp": "02/01/2026 10:00:00"}, {"card_last4": None}, {"amount": None, "currency": None},
        {"currency": "kroner"}, {"amount": "4x"}, {"amount": "-5"}, {"channel": "pigeon"},
        {"timestamp": "someday"}, {"card_last4": "98"}, {"response_time_seconds": "1.5"},
        {"response_time_seconds": "-1"}, {"response_time_seconds": "soon"}, {"is_fraud": "1"},
        {"is_fraud": "maybe"}, {"currency": "x", "amount": "4x"}, {"customer_id": " n/a "},
    ) == [
        None, None, None, None, None, "<record>", "currency", "amount", "amount", "channel",
        "timestamp", "card_last4", None, "response_time_seconds", "response_time_seconds", None,
        "is_fraud", "currency", "<record>",
    ]
    assert outcome(spark, {"amount": "-5"}, allow_negative_amount=True) == [None]
    assert outcome(spark, {"channel": "wire"}, allowed_channels=("WIRE",)) == [None]
    assert outcome(spark, {"unexpected": "x"}) == [None]
    assert outcome(spark, {"unexpected": "x"}, {"amount": None}, strict=True) == ["<record>"] * 2


def test_missing_fields_are_listed_in_contract_order(spark):
    row = V.validate(records(spark, {"currency": None, "amount": None})).first()
    assert row.reject.message.endswith(": amount, currency")
    assert row.reject.error_class == "SCHEMA"
    assert REQUIRED_FIELDS.index("amount") < REQUIRED_FIELDS.index("currency")


def test_typed_records(spark):
    df = spark.sql(
        "select 't1' transaction_id, 12 customer_id, 'POS' channel, 5.25D amount, 'usd' currency,"
        " timestamp_ntz'2026-03-29 02:30:00' timestamp, 1234 card_last4, true is_fraud,"
        " 2 response_time_seconds, map('a', 1) raw_source_data"
    )
    row = V.validate(df).first()
    assert row.reject is None and row.customer_id == "12" and row.card_last4 == "1234"
    assert row.timestamp == "2026-03-29T02:30:00" and row.is_fraud is True
    assert row.response_time_seconds == 2.0 and row.raw_source_data == {"a": "1"}


def test_reject_metrics(spark):
    df = V.validate(records(spark, {}, {"amount": "free"}, {"channel": "pigeon"}))
    m = V.reject_metrics(df).first()
    assert (m.total, m.valid, m.invalid, m.is_valid) == (3, 1, 2, False)
    assert m.failure_rate == pytest.approx(2 / 3)
    assert {r.field: r.n for r in V.reject_field_counts(df).collect()} == {"amount": 1, "channel": 1}
    with pytest.raises(ValueError, match="amount"):
        V.raise_first_reject(df, ["__i"])
    empty = V.reject_metrics(df.limit(0)).first()
    assert (empty.total, empty.is_valid, empty.failure_rate) == (0, True, 0.0)


def test_first_per_key_with_a_hot_key(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 100)).alias("key"),
        (F.col("id") * 7919 % 5000).alias("pos"), (F.col("id") % 4).alias("src"), "id",
    )
    rows = df.collect()
    first = {}
    for r in sorted(rows, key=lambda r: (r.src, r.pos)):
        first.setdefault(r.key, r.id)
    got = {r.key: r.id for r in first_per_key(df, "key", ["src", "pos"]).collect()}
    assert got == first
    dropped = {r.src: r.duplicates_removed for r in duplicate_counts(df, "key", ["src", "pos"], "src").collect()}
    assert sum(dropped.values()) == len(rows) - len(first)


def test_csv_sink_and_typed_scan(spark, folder, tmp_path):
    result = ingest(spark, src(folder / "pos_transactions.csv"), include_raw=True)
    out = sinks.write_csv(result.records, str(tmp_path / "deep" / "out"))
    back = files.read_text_csv(spark, out)
    assert back.columns == list(CANONICAL_FIELDS)
    row = back.first()
    assert row.card_last4 == "0077" and '"location":"kiosk-4"' in row.raw_source_data
    rejects = sinks.write_rejects(result.rejects, str(tmp_path / "rejects"))
    assert spark.read.schema(result.rejects.schema).parquet(rejects).count() == 0


def test_typed_scan(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('a,b,c,d,e,f\n1,1.5,x,True,,NA\n2,inf,"q ""z"", y",false,,007\n\nNaN,1e3,None,TRUE,,n/a\n')
    df = files.read_typed_csv(spark, str(path))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "boolean", "double", "bigint"]
    assert [tuple(r) for r in df.orderBy("b").collect()] == [
        (1, 1.5, "x", True, None, None), (None, 1000.0, None, True, None, None),
        (2, float("inf"), 'q "z", y', False, None, 7),
    ]
    assert files.read_typed_csv(spark, str(path), ["c"]).columns == ["c"]
    with pytest.raises(ValueError, match="zzz"):
        files.read_typed_csv(spark, str(path), ["zzz"])
    assert files.row_count(df).first().n == 3
    assert files.csv_columns(spark, str(path)) == list("abcdef")
    text = files.read_text_csv(spark, str(path), with_ordinal=True)
    assert [r.a for r in files.head(text, 2, ["row_ordinal"]).collect()] == ["1", "2"]


def test_row_index(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    got = files.with_row_index(df, ["k"]).collect()
    assert all(r["index"] == r.k for r in got) and len(got) == 1000
    out = sinks.write_csv(df, str(tmp_path / "indexed"), index=True, order_by=["k"])
    assert files.read_text_csv(spark, out).columns == ["index", "k"]


def test_row_with_surplus_cells_is_rejected(spark, folder):
    path = put(folder / "pos_long.csv", POS_ROW, {**POS_ROW, "transaction_id": "S-502", "location": "a, b"})
    with open(path, "a") as out:
        out.write(",".join([*{**POS_ROW, "transaction_id": "S-503"}.values(), "more", "cells"]) + "\n")
        out.write("S-504,K-1,5\n")
    result = ingest(spark, src(path))
    assert sorted(r.transaction_id for r in result.records.collect()) == ["S-501", "S-502"]
    rejects = result.rejects.orderBy("row_index").collect()
    assert [(r.row_index, r.error_class) for r in rejects] == [(2, "SCHEMA"), (3, "SCHEMA")]
    assert rejects[0].value.endswith("more,cells") and "more cells" in rejects[0].message
    with pytest.raises(Exception, match="more cells"):
        files.read_text_csv(spark, path).collect()


def test_positions_of_a_frame_in_many_partitions(spark):
    rows = [{**POS_ROW, "transaction_id": f"f{i}", "currency": "x1" if i % 3 == 0 else "usd"} for i in range(12)]
    frame = spark.createDataFrame(spark.sparkContext.parallelize([tuple(r.values()) for r in rows], 3), list(rows[0]))
    result = ingest(spark, [Source(name="f", mapping="pos", frame=frame)])
    assert sorted(r.row_index for r in result.rejects.collect()) == [0, 3, 6, 9]


def test_a_broken_part_file_fails_its_source_only(spark, folder):
    parts = folder / "pos_parts"
    parts.mkdir()
    put(parts / "a.csv", POS_ROW)
    put(parts / "b.csv", dict(reversed(list(POS_ROW.items()))))
    result = ingest(spark, src(parts, folder / "atm_transactions.csv", folder / "online_transactions.csv")).materialized()
    report = result.source_report().orderBy("source_ordinal").collect()
    assert [(r.status, r.valid) for r in report] == [("FAILED", 0), ("ok", 1), ("ok", 1)]
    assert sorted(r.transaction_id for r in result.records.collect()) == ["N-3", "W-77"]


def test_folder_of_many_files_is_one_scan_per_mapping(spark, tmp_path):
    for i in range(30):
        put(tmp_path / f"pos_{i:02}.csv", {**POS_ROW, "transaction_id": f"p{i % 20}"}, {**POS_ROW, "transaction_id": f"q{i}", "currency": "kroner"})
        put(tmp_path / f"atm_{i:02}.csv", {**ATM_ROW, "transaction_id": f"a{i}"})
    put(tmp_path / "pos_97.csv", dict(reversed(list({**POS_ROW, "transaction_id": "turned"}.items()))))
    put(tmp_path / "pos_98.csv", {"transaction_id": "x", "amount": "1"})
    (tmp_path / "pos_99.csv").write_text("")  # Spark lists no empty files
    result = ingest_folder(spark, str(tmp_path))
    assert result.annotated._jdf.queryExecution().executedPlan().toString().count("FileScan csv") <= 3
    ids = {r.transaction_id for r in result.records.collect()}
    assert ids == {f"p{i}" for i in range(20)} | {f"a{i}" for i in range(30)} | {"turned"}
    report = {r.source: r for r in result.source_report().collect()}
    assert len(report) == 62
    assert (report["pos_25"].rows_read, report["pos_25"].valid, report["pos_25"].invalid, report["pos_25"].duplicates_removed) == (2, 1, 1, 1)
    assert report["pos_97"].valid == 1 and report["atm_07"].mapping == "atm"
    assert report["pos_98"].status == "FAILED" and "customer_id" in report["pos_98"].error and report["pos_98"].rows_read == 1
    rejects = result.rejects.collect()
    assert len(rejects) == 30 and {r.row_index for r in rejects} == {1}


def test_first_lines_read_little(spark, tmp_path):
    """A long file gives its header for a chunk of it; odd files give a reason or none."""
    (tmp_path / "long.csv").write_text("a,b\n" + "1,2\n" * 200_000)
    (tmp_path / "late.csv").write_bytes(b"\n  \r\n\"x, y\",z\r\n1,2\n")
    (tmp_path / "bare.csv").write_text("only,header")
    (tmp_path / "blank.csv").write_text("\n\n")
    (tmp_path / "bytes.csv").write_bytes(b"\xff\xfe,1\n")
    got = {r.file_name: (r.line, r.error) for r in files.first_lines(spark, str(tmp_path)).collect()}
    assert got["long.csv"] == ("a,b", None) and got["late.csv"] == ('"x, y",z', None) and got["bare.csv"] == ("only,header", None)
    assert got["blank.csv"] == (None, None) and got["bytes.csv"][0] is None and "UnicodeDecodeError" in got["bytes.csv"][1]
    assert files.header_names('"x, y", z ,"q ""r"""') == ["x, y", "z", 'q "r"']
    with files._opened(str(tmp_path / "long.csv")) as stream:
        total = len(stream.read())
    read = []
    opened = files._opened

    class Counted:
        def __init__(self, path):
            self.stream = opened(path)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n):
            read.append(n)
            return self.stream.read(n)

    files._opened = Counted
    try:
        assert files.first_line(str(tmp_path / "long.csv")) == "a,b"
    finally:
        files._opened = opened
    assert sum(read) <= files._CHUNK < total


def test_folder_of_many_headers_is_one_scan(spark, tmp_path):
    """Fifty headers: other orders, extra columns, other widths, cells beyond the header."""
    rng = random.Random(3)
    for i in range(50):
        names = [*POS_ROW, *[f"extra{k}" for k in range(i % 7)]]
        rng.shuffle(names)
        rows = [POS_ROW | {"transaction_id": f"t{i}-{k}"} | {n: f"{n} {i}" for n in names if n not in POS_ROW} for k in range(3)]
        lines = [",".join(names), *[",".join(f'"{r[n]}"' for n in names) for r in rows]]
        lines.append(",".join(["x"] * (len(names) + 1)))
        lines.append(",".join(f'"{(POS_ROW | {"transaction_id": f"s{i}"}).get(n, "")}"' for n in names) + ",")
        (tmp_path / f"pos_{i:02}.csv").write_text("\n".join(lines) + "\n")
    result = ingest_folder(spark, str(tmp_path))
    assert result.annotated._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert {r.transaction_id for r in result.records.collect()} == {f"t{i}-{k}" for i in range(50) for k in range(3)}
    report = result.source_report().collect()
    assert {(r.status, r.rows_read, r.valid, r.invalid) for r in report} == {("ok", 5, 3, 2)}
    assert {(r.row_index, r.error_class) for r in result.rejects.collect()} == {(3, "SCHEMA"), (4, "SCHEMA")}
    raw = ingest_folder(spark, str(tmp_path), include_raw=True).records.filter("transaction_id = 't6-0'").first()
    assert raw.raw_source_data["extra5"] == "extra5 6" and raw.card_last4 == "0077"


def test_unreadable_file_of_a_folder(spark, tmp_path, monkeypatch):
    """A file that fails while it is read is reported; the others are kept."""
    for i in range(4):
        row = POS_ROW | {"transaction_id": f"t{i}"}
        (tmp_path / f"pos_{i}.csv").write_text(",".join(row) + "\n" + ",".join(row.values()) + "\n")
    result = ingest_folder(spark, str(tmp_path))
    lost = ingest_folder(spark, str(tmp_path), unreadable={"pos_2.csv": "OSError: broken"})
    for got in (lost, lost.materialized()):
        assert {r.transaction_id for r in got.records.collect()} == {"t0", "t1", "t3"}
        assert {(r.source, r.status, r.error) for r in got.source_report().collect() if r.error} == {("pos_2", "FAILED", "OSError: broken")}
    assert files.unreadable_files(files.discover_csv(spark, str(tmp_path)).select("file_name", "path")) == {}
    gone = spark.createDataFrame([("pos_9.csv", f"file:{tmp_path}/pos_9.csv"), ("pos_1.csv", f"file:{tmp_path}/pos_1.csv")], "file_name string, path string")
    assert list(files.unreadable_files(gone)) == ["pos_9.csv"]
    # A job that fails for another reason is not taken for an unreadable file.
    broken = replace(result, annotated=result.annotated.withColumn("customer_id", F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        broken.materialized()


def test_positions_of_a_frame_behind_a_shuffle(spark):
    """The rows come in other partitions whenever the frame is evaluated."""
    deal = F.udf(random.random, "double").asNondeterministic()
    rows = [tuple((POS_ROW | {"transaction_id": f"t{i}", "currency": "gbp" if i % 2 else "pounds"}).values()) for i in range(400)]
    frame = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in POS_ROW)).repartition(7, deal())
    result = ingest(spark, [Source(frame=frame, name="pos", mapping="pos")])
    for _ in range(2):
        rejects = result.rejects.collect()
        places = sorted(r.row_index for r in rejects)
        assert len(set(places)) == len(places) == 200 and 0 <= places[0] and places[-1] < 400
    assert {(r.row_index, r.record.transaction_id) for r in rejects} == {(r.row_index, r.record.transaction_id) for r in result.rejects.collect()}


def test_typed_table_parses_once_whatever_the_guess(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "TYPING_ROWS", 2)
    cells = {
        "late text": ["007", "1", None, "x"], "late real": ["12", "-0", "9007199254740993", "1.50"],
        "late gap": [None, None, "5", None], "none": [None] * 4, "late word": ["True", "false", "maybe", None],
        "words": ["True", "false", None, " TRUE"], "endless": ["1.5", "2", "inf", None], "wide": ["1", "2", "99999999999999999999", None],
        **{f"n{i}": [str(i), "2", "3", None] for i in range(20)}, "blank": [" 7", "8 ", "9", None],
    }
    path = put(tmp_path / "typed.csv", *[{k: v[i] for k, v in cells.items()} for i in range(4)])
    lazy, made = files.read_typed_csv(spark, path), files.read_typed_csv(spark, path, materialize_types=True)
    assert made.schema == lazy.schema
    names = {"late text": "string", "late real": "double", "late gap": "bigint", "none": "double", "late word": "string", "wide": "double"}
    assert {n: dict(made.dtypes)[n] for n in names} == names
    shown = lambda df: sorted(str(r) for r in df.collect())  # noqa: E731 - text tells -0.0 from 0.0
    assert shown(made) == shown(lazy)
    assert "FileScan csv" not in made._jdf.queryExecution().toString()
    empty = put(tmp_path / "empty.csv", header=["a", "b"])
    assert files.read_typed_csv(spark, empty, materialize_types=True).collect() == []
