import random

from pyspark.sql import functions as F
from test_ingest import ATM_ROW, POS_ROW, put

from riskframe.contract import CANONICAL_FIELDS
from riskframe.operators.mappings import ATM, POS
from riskframe.operators.validation import validate
from riskframe.plans.ingest import Source, ingest
from riskframe.streaming.ingest import read_stream, start_ingest
from riskframe.streaming.ordered import _ON_DISK, OrderedIngest, first_by_position


def test_stream_matches_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "pos_1.csv", POS_ROW, {**POS_ROW, "amount": "99"}, {**POS_ROW, "transaction_id": "p2"})
    put(folder / "pos_2.csv", {**POS_ROW, "transaction_id": "p3", "currency": "kroner"}, POS_ROW)
    paths = [str(tmp_path / n) for n in ("records", "rejects", "state")]
    for query in start_ingest(read_stream(spark, str(folder), POS), POS, *paths):
        query.awaitTermination(120)
    batch = ingest(spark, [Source(str(folder), mapping="pos")])
    ids = sorted(r.transaction_id for r in spark.read.parquet(paths[0]).collect())
    assert ids == sorted(r.transaction_id for r in batch.records.collect()) == ["S-501", "p2"]
    rejects = spark.read.parquet(paths[1]).collect()
    assert [(r.field, r.value) for r in rejects] == [("currency", "kroner")]


def test_first_by_position_whatever_arrives_first(spark, tmp_path):
    rng = random.Random(5)
    folders = {name: tmp_path / name for name in ("till", "cash")}
    for f in folders.values():
        f.mkdir()
    rows = lambda row, n: [{**row, "transaction_id": f"id-{rng.randrange(25)}", "customer_id": f"K-{rng.random()}", "timestamp": f"2025-06-0{rng.randint(1, 3)}T0{rng.randrange(9)}:00:00",
                            "amount": rng.choice(["5", "6.50", "-1"])} for _ in range(n)]
    stream = OrderedIngest(spark, {"till": (str(folders["till"]), POS), "cash": (str(folders["cash"]), ATM)}, str(tmp_path / "out"), delay="7 days")

    def run():
        for query in (stream.land(), stream.settle()):
            query.awaitTermination(120)

    # Later positions arrive first.
    for n in (3, 1, 2):
        put(folders["cash"] / f"atm_{n}.csv", *rows(ATM_ROW, 20))
        put(folders["till"] / f"pos_{n}.csv", *rows(POS_ROW, 15))
        run()
    assert stream.records().count() == 0 and {r.waiting for r in stream.report().collect()} != {0}
    batch = ingest(spark, [Source(str(folders["till"]), "till", "pos"), Source(str(folders["cash"]), "cash", "atm")])
    shown = lambda df: sorted(str(r) for r in df.select(*[f for f in CANONICAL_FIELDS if f != "raw_source_data"]).collect())
    want, report = shown(batch.records), {r.source: r for r in batch.source_report().collect()}
    rejects = sorted((r.source, r.field, r.value) for r in batch.rejects.collect())
    put(folders["till"] / "pos_9.csv", {**POS_ROW, "transaction_id": "closing", "timestamp": "2025-09-01T00:00:00"})
    run()
    assert shown(stream.records()) == want
    assert sorted((r.source, r.field, r.value) for r in stream.rejects().collect()) == rejects
    for r in stream.report().collect():
        closing = int(r.source == "till")
        same = report[r.source]
        assert (r.rows_read - closing, r.valid - closing, r.invalid) == (same.rows_read, same.valid, same.invalid)
        assert (r.duplicates_removed, r.waiting) == (same.duplicates_removed, closing)
    # A record later than the watermark waits for good.
    put(folders["till"] / "pos_0.csv", {**POS_ROW, "transaction_id": "late", "timestamp": "2025-06-01T00:00:00"})
    run()
    assert shown(stream.records()) == want and {r.source: r.waiting for r in stream.report().collect()} == {"till": 2, "cash": 0}


def test_open_records_lie_on_disk_and_keep_their_cells(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    stream = OrderedIngest(spark, {"till": (str(folder), POS)}, str(tmp_path / "out"), delay="7 days")
    before = {k: spark.conf.get(k, None) for k in _ON_DISK}
    for name, row in (("pos_2", POS_ROW), ("pos_1", {**POS_ROW, "amount": "7"}), ("pos_9", {**POS_ROW, "transaction_id": "last", "timestamp": "2030-01-01T00:00:00"})):
        put(folder / f"{name}.csv", row)
        for query in (stream.land(), stream.settle()):
            query.awaitTermination(120)
    names = [p.name for p in (tmp_path / "out" / "state-records" / "state").rglob("*")]
    # Not as snapshots of a map in memory.
    assert any(n.endswith(".changelog") for n in names) and not any(n.endswith((".delta", ".snapshot")) for n in names)
    assert {k: spark.conf.get(k, None) for k in _ON_DISK} == before
    (record,) = stream.records().collect()
    assert (record.transaction_id, float(record.amount), record.raw_source_data, record.copies) == ("S-501", 7.0, None, [2])


def test_the_first_record_brings_its_map(spark, tmp_path):
    rows = read_batch(spark, tmp_path)
    got = first_by_position(rows, 1, "7 days")
    assert dict(got.dtypes)["raw_source_data"] == "map<string,string>"
    assert [(r.transaction_id, r.raw_source_data, r.copies) for r in got.collect()] == [("S-501", {"b": None, "a": "2"}, [2])]


def read_batch(spark, tmp_path):
    """Two copies of a record; the later row has the earlier position."""
    put(tmp_path / "a.csv", {**POS_ROW, "amount": "1"}, {**POS_ROW, "amount": "2"})
    raw = spark.read.csv(str(tmp_path / "a.csv"), header=True)
    position = [F.lit(0).alias("__source"), F.lit("f").alias("__file"), F.lit(0).alias("__block"), (-F.col("amount").cast("int")).alias("__row")]
    cells = F.create_map(F.lit("b"), F.lit(None).cast("string"), F.lit("a"), F.col("amount")).alias("raw_source_data")
    return validate(POS.apply(raw.select(*POS.required, *position, cells), clean=False))
