"""Sources, sinks and ingestion over CSV files that Spark writes from ``orders``."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

import riskframe as R
from queries import query
from queries.rules import TRUTH, order_key, raw
from riskframe.contract import CANONICAL_FIELDS
from riskframe.operators.mappings import ATM, ONLINE, POS
from riskframe.sources.files import apply_types, infer_types
from riskframe.sources.scratch import materialize, scratch_path
from riskframe.streaming.ordered import OrderedIngest

_WRITTEN: dict[tuple[str, str, str], str] = {}


def written(spark: SparkSession, sf: str, name: str, build) -> str:
    """Path of a CSV folder written once per session; rows keep the order of their key."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _WRITTEN:
        path = f"{scratch_path(spark, 'csv')}/{name}"
        build().write.csv(path, header=True, quote='"', escape='"', emptyValue="")
        _WRITTEN[key] = path
    return _WRITTEN[key]


def plain_orders(spark, sf) -> str:
    """``orders`` as CSV with leading zeros, quotes, line-end blanks and empty cells."""

    def build():
        c = F.col
        return (
            spark.read.parquet(f"{sf}/orders.parquet")
            .orderBy("o_orderkey")
            .select(
                F.lpad(c("o_orderkey").cast("string"), 12, "0").alias("code"),
                c("o_orderkey").alias("key"),
                c("o_totalprice").alias("price"),
                F.concat(F.lit('say "'), "o_orderpriority", F.lit('", ok')).alias("note"),
                F.when(c("o_custkey") % 10 == 0, "NA")
                .when(c("o_custkey") % 10 == 1, "")
                .otherwise(c("o_custkey").cast("string"))
                .alias("customer"),
                F.when(c("o_orderkey") % 2 == 0, "True").otherwise("False").alias("even"),
                F.lit(None).cast("string").alias("nothing"),
            )
        )

    return written(spark, sf, "orders_plain", build)


_ORDERED = "o_orderkey AS key"


@query(
    "s01_discover_csv",
    "SELECT 'csv' AS kind, true AS sized, count(*) AS n FROM orders",
)
def discover_csv(spark, sf):
    folder = plain_orders(spark, sf)
    files = R.discover_csv(spark, folder).agg(
        F.bool_and(F.col("bytes") > 0).alias("sized"),
        F.min(F.element_at(F.split("file_name", "[.]"), -1)).alias("kind"),
        F.collect_list("path").alias("paths"),
    )
    found = files.first()
    n = R.read_text_csv(spark, found.paths).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(found.kind).alias("kind"), F.lit(found.sized).alias("sized"), "n")


@query(
    "s02_csv_columns",
    """SELECT CAST(row_number() OVER () - 1 AS INTEGER) AS ordinal, column_name AS "column"
    FROM (DESCRIBE SELECT * FROM orders)""",
)
def csv_columns(spark, sf):
    path = written(
        spark, sf, "orders", lambda: spark.read.parquet(f"{sf}/orders.parquet").orderBy("o_orderkey")
    )
    names = R.csv_columns(spark, path)
    return spark.createDataFrame(list(enumerate(names)), "ordinal int, column string")


@query("s03_row_count", "SELECT count(*) AS n FROM orders")
def row_count(spark, sf):
    return R.row_count(R.read_text_csv(spark, plain_orders(spark, sf)))


@query(
    "s04_head",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS code, 'say "' || o_orderpriority
    || '", ok' AS note FROM orders ORDER BY o_orderkey LIMIT 5000""",
)
def head(spark, sf):
    text = R.read_text_csv(spark, plain_orders(spark, sf), with_ordinal=True)
    return R.head(text, 5000, ["row_ordinal"]).select("code", "note")


@query(
    "s05_typed_scan",
    """SELECT o_orderkey AS "key", o_totalprice AS price, o_orderkey % 2 = 0 AS even,
    CASE WHEN o_custkey % 10 > 1 THEN o_custkey END AS customer, CAST(NULL AS DOUBLE) AS nothing
    FROM orders""",
)
def typed_scan(spark, sf):
    columns = ["key", "price", "even", "customer", "nothing"]
    return R.read_typed_csv(spark, plain_orders(spark, sf), columns)


@query(
    "s05_typed_scan_one_parse",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0')::BIGINT AS code, o_totalprice AS price, o_orderkey % 2 = 0 AS even,
    CASE WHEN o_custkey % 10 > 1 THEN o_custkey END AS customer, CAST(NULL AS DOUBLE) AS nothing
    FROM orders""",
)
def typed_scan_one_parse(spark, sf):
    columns = ["code", "price", "even", "customer", "nothing"]
    return R.read_typed_csv(spark, plain_orders(spark, sf), columns, materialize_types=True)


@query(
    "s06_text_scan",
    """SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS code,
    'say "' || o_orderpriority || '", ok' AS note,
    CASE WHEN o_custkey % 10 > 1 THEN CAST(o_custkey AS VARCHAR) END AS customer FROM orders""",
)
def text_scan(spark, sf):
    return R.read_text_csv(spark, plain_orders(spark, sf)).select("code", "note", "customer")


@query(
    "s07_canonical_frame",
    "SELECT "
    + ", ".join(
        {
            "transaction_id": "CAST(o_orderkey AS VARCHAR) AS transaction_id",
            "amount": "o_totalprice AS amount",
            "card_type": "o_orderstatus AS card_type",
        }.get(f, f'NULL AS "{f}"')
        for f in CANONICAL_FIELDS
    )
    + " FROM orders",
)
def canonical(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").withColumnsRenamed(
        {"o_orderkey": "transaction_id", "o_totalprice": "amount", "o_orderstatus": "card_type"}
    )
    frame = R.canonical_frame(orders)
    return frame.withColumn("raw_source_data", F.to_json("raw_source_data"))


@query(
    "s08_csv_sink",
    """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS "index",
    CAST(o_orderkey AS VARCHAR) AS transaction_id, o_totalprice AS amount,
    '{"status":"' || o_orderstatus || '"}' AS raw_source_data FROM orders""",
)
def csv_sink(spark, sf):
    c = F.col
    orders = spark.read.parquet(f"{sf}/orders.parquet").select(
        c("o_orderkey").alias("__order"),
        c("o_orderkey").alias("transaction_id"),
        c("o_totalprice").alias("amount"),
        F.create_map(F.lit("status"), "o_orderstatus").alias("raw_source_data"),
    )
    path = f"{scratch_path(spark, 'sink')}/deep/records"
    R.write_csv(orders, path, index=True, order_by=["__order"])
    back = R.read_text_csv(spark, path)
    text = {"transaction_id", "raw_source_data"}
    types = {k: t for k, t in infer_types(back).items() if k not in text}
    return apply_types(back, types).select("index", "transaction_id", "amount", "raw_source_data")


_NAMES = "CASE o_orderkey % 6 WHEN 0 THEN 'pos' WHEN 1 THEN 'atm' WHEN 2 THEN 'pos' " \
    "WHEN 3 THEN 'online' WHEN 4 THEN 'atm' END"


@query(
    "s09_file_routing",
    f"SELECT {_NAMES} AS mapping, count(*) AS n FROM orders GROUP BY 1",
)
def file_routing(spark, sf):
    kinds = ["POS_", "my.atm-", "posmarch", "x/Online.", "deposit_atm ", "other"]
    names = F.concat(F.element_at(F.array(*map(F.lit, kinds)), (order_key() % 6 + 1).cast("int")), order_key(), F.lit(".csv"))
    files = spark.read.parquet(f"{sf}/orders.parquet").select(names.alias("file_name"))
    return R.routed_files(files).groupBy("mapping").agg(F.count(F.lit(1)).alias("n"))


# --- ingestion --------------------------------------------------------------------------------------

# Order keys are dealt to the three channels in turn; the file's own channel column is only
# read online.
_KINDS = {"pos": (0, POS), "atm": (1, ATM), "online": (2, ONLINE)}


def sources(spark, sf) -> list[R.Source]:
    """Three raw sources, each a folder of CSV part files in key order."""
    specs = []
    for name, (code, mapping) in _KINDS.items():

        def build(code=code, mapping=mapping):
            rows = raw(spark, sf).filter(order_key() % 3 == code).orderBy("o_orderkey")
            return rows.select(*mapping.required)

        specs.append(R.Source(written(spark, sf, f"{name}_raw", build), name, name))
    return specs


_BAD = """CASE WHEN customer_id IS NULL OR no_amount THEN '<record>'
  WHEN currency IS NULL THEN 'currency' WHEN amount IS NULL OR amount < 0 THEN 'amount'
  WHEN "timestamp" IS NULL THEN 'timestamp'
  WHEN card_last4 IS DISTINCT FROM card_text THEN 'card_last4' END"""
_SOURCE = "CAST(o_orderkey % 3 AS INTEGER)"
READ = f"""{TRUTH}, read AS (SELECT o_orderkey, {_SOURCE} AS source_ordinal,
  ['pos', 'atm', 'online'][o_orderkey % 3 + 1] AS source,
  row_number() OVER (PARTITION BY {_SOURCE} ORDER BY o_orderkey) - 1 AS row_index,
  {_BAD} AS field, transaction_id, customer_id,
  ['POS', 'ATM', 'ONLINE_BANKING'][o_orderkey % 3 + 1] AS channel, amount, currency, "timestamp",
  CASE WHEN o_orderkey % 3 = 0 THEN location END AS location,
  CASE WHEN o_orderkey % 3 <> 1 THEN merchant_id END AS merchant_id,
  CASE WHEN o_orderkey % 3 = 1 THEN terminal_id END AS terminal_id, card_last4, card_type,
  CASE o_orderkey % 3 WHEN 0 THEN payment_method WHEN 1 THEN 'CASH' ELSE CASE o_orderkey % 5
    WHEN 0 THEN 'online banking' WHEN 1 THEN 'pos' WHEN 2 THEN 'Atm!' WHEN 3 THEN 'pigeon'
    ELSE 'ONLINE_BANKING' END END AS payment_method,
  CASE WHEN o_orderkey % 3 = 0 THEN authorization_code END AS authorization_code,
  CASE WHEN o_orderkey % 3 = 2 THEN 'APPROVED' ELSE response_code END AS response_code
  FROM truth),
valid AS (SELECT *, row_number() OVER (PARTITION BY transaction_id
  ORDER BY source_ordinal, o_orderkey) AS k FROM read WHERE field IS NULL)"""
_SHOWN = [f for f in CANONICAL_FIELDS if f != "raw_source_data"]
_RECORDS = ", ".join(
    f'NULL AS "{f}"' if f in ("response_time_seconds", "is_fraud") else f'"{f}"' for f in _SHOWN
)
REPORT = f"""{READ}, report AS (SELECT source_ordinal, r.source, r.source AS mapping,
  'ok' AS status, count(*) AS rows_read, count(*) FILTER (r.field IS NULL) AS valid,
  count(*) FILTER (r.field IS NOT NULL) AS invalid,
  count(*) FILTER (v.k > 1) AS duplicates_removed, NULL AS error
  FROM read r LEFT JOIN (SELECT o_orderkey, k FROM valid) v USING (o_orderkey)
  GROUP BY source_ordinal, r.source)"""


#: Files of each of the five layouts of the mixed folder.
_FILES = 200


def mixed_folder(spark, sf) -> str:
    """One folder of about a thousand small files in five layouts, and three files that cannot be ingested."""
    key = (spark.sparkContext.applicationId, sf, "mixed")
    if key in _WRITTEN:
        return _WRITTEN[key]
    folder = scratch_path(spark, "mixed")
    jvm = spark._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    store = Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(Path(folder))
    layouts = [("pos", 0, "a", POS.required), ("pos", 0, "b", POS.required[::-1]), ("pos", 0, "c", ["extra", *POS.required])]
    layouts += [("atm", 1, "a", ATM.required), ("online", 2, "a", ONLINE.required)]
    rows = materialize(raw(spark, sf).withColumn("extra", F.lit("x, y")), "raw")
    for name, code, letter, columns in layouts:
        part = rows.filter(order_key() % 3 == code)
        if name == "pos":
            part = part.filter(F.floor(order_key() / 3) % 3 == "abc".index(letter))
        most = max(1, -(-part.count() // _FILES))
        path = f"{scratch_path(spark, 'csv')}/{name}{letter}"
        part.repartitionByRange(8, "o_orderkey").sortWithinPartitions("o_orderkey").select(*columns).write.option("maxRecordsPerFile", most).csv(
            path, header=True, quote='"', escape='"', emptyValue="")
        found = [f.getPath() for f in store.listStatus(Path(path)) if f.getPath().getName().endswith(".csv")]
        for i, file in enumerate(sorted(found, key=lambda f: f.getName())):
            store.rename(file, Path(f"{folder}/{name}_{letter}{i:04}.csv"))
    odd = {"pos_void": b" \n\n", "pos_unread": b"\xff\xfe,\xff\n1,2\n", "pos_broken": b"transaction_id,amount\n1,2.50\n"}
    for name, content in odd.items():
        stream = store.create(Path(f"{folder}/{name}.csv"))
        stream.write(bytearray(content))
        stream.close()
    _WRITTEN[key] = folder
    return folder


@query(
    "s09_ingest_folder",
    f"""WITH {READ}, firsts AS (SELECT transaction_id, min(source) AS source FROM read WHERE field IS NULL GROUP BY 1)
    SELECT source AS mapping, count(*) + CAST(source = 'pos' AS INTEGER) AS rows_read, count(*) FILTER (field IS NULL) AS valid,
    count(*) FILTER (field IS NOT NULL) AS invalid, CASE WHEN source = 'pos' THEN 3 ELSE 0 END AS failed,
    (SELECT count(*) FROM firsts f WHERE f.source = r.source) AS kept FROM read r GROUP BY source""",
)
def ingest_folder(spark, sf):
    """A mixed folder: five headers, three scans, three files that fail by themselves."""
    report = R.ingest_folder(spark, mixed_folder(spark, sf)).source_report()
    total = lambda c: F.sum(c).cast("bigint")
    return report.groupBy("mapping").agg(
        total("rows_read").alias("rows_read"), total("valid").alias("valid"), total("invalid").alias("invalid"),
        F.count_if(F.col("status") == "FAILED").alias("failed"), total(F.col("valid") - F.col("duplicates_removed")).alias("kept"),
    )


@query(
    "i01_ingest_one_source",
    f"WITH {READ} SELECT {_RECORDS} FROM valid WHERE source = 'pos' "
    "QUALIFY row_number() OVER (PARTITION BY transaction_id ORDER BY o_orderkey) = 1",
)
def ingest_one(spark, sf):
    return R.ingest(spark, sources(spark, sf)[:1]).records.select(*_SHOWN)


@query("i02_merge_sources", f"WITH {READ} SELECT {_RECORDS}, source_ordinal FROM valid")
def merge_sources(spark, sf):
    merged = R.ingest(spark, sources(spark, sf), dedupe=False).records_with_origin
    return merged.select(*_SHOWN, F.col("__source").alias("source_ordinal"))


@query("i03_first_id_wins", f"WITH {READ} SELECT {_RECORDS} FROM valid WHERE k = 1")
def first_id_wins(spark, sf):
    return R.ingest(spark, sources(spark, sf)).records.select(*_SHOWN)


@query(
    "i03_first_row_per_key",
    """SELECT l_orderkey || '-' || l_linenumber AS id, l_partkey, l_suppkey, l_quantity
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
      ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
def first_row_per_key(spark, sf):
    lines = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("id"),
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    )
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    return R.first_per_key(lines, "id", order).drop("l_extendedprice")


@query(
    "i04_duplicates_per_source",
    f"WITH {REPORT} SELECT source, valid, duplicates_removed FROM report",
)
def duplicates_per_source(spark, sf):
    report = R.ingest(spark, sources(spark, sf)).source_report()
    return report.select("source", "valid", "duplicates_removed")


@query("i05_source_report", f"WITH {REPORT} SELECT * FROM report")
def source_report(spark, sf):
    return R.ingest(spark, sources(spark, sf)).source_report()


@query(
    "i06_report_totals",
    f"""WITH {REPORT} SELECT count(*) AS sources, CAST(sum(rows_read) AS BIGINT) AS rows_read,
    CAST(sum(valid - duplicates_removed) AS BIGINT) AS records,
    CAST(sum(invalid) AS BIGINT) AS invalid,
    CAST(sum(duplicates_removed) AS BIGINT) AS duplicates_removed,
    count(*) FILTER (status <> 'ok') AS failed_sources, sum(invalid) = 0 AS ok FROM report""",
)
def report_totals(spark, sf):
    return R.ingest(spark, sources(spark, sf)).totals()


@query(
    "i10_quarantine",
    f"""WITH {READ} SELECT source, row_index, CASE WHEN field <> '<record>' THEN field END AS field,
    CASE WHEN field = '<record>' THEN 'SCHEMA' ELSE 'VALIDATION' END AS error_class,
    transaction_id FROM read WHERE field IS NOT NULL""",
)
def quarantine(spark, sf):
    rejects = R.ingest(spark, sources(spark, sf)).rejects
    path = R.write_rejects(rejects, scratch_path(spark, "rejects"))
    kept = spark.read.schema(rejects.schema).parquet(path)
    return kept.select(
        "source", "row_index", "field", "error_class",
        F.trim("record.transaction_id").alias("transaction_id"),
    )


@query(
    "v02_failed_source",
    """SELECT 'thin' AS source, 'FAILED' AS status, count(*) AS rows_read, CAST(0 AS BIGINT) AS valid
    FROM orders""",
)
def failed_source(spark, sf):
    path = written(
        spark, sf, "thin_pos", lambda: raw(spark, sf).select("transaction_id", F.col("amount").alias(" amount"))
    )
    report = R.ingest(spark, [R.Source(path, "thin", "pos")]).source_report()
    return report.select("source", "status", "rows_read", "valid")


@query(
    "v17_bad_amount_fails_source",
    f"""WITH {READ} SELECT source, bool_or(amount IS NULL) AS failed, count(*) AS rows_read,
    CASE WHEN bool_or(amount IS NULL) THEN 0 ELSE count(*) FILTER (field IS NULL) END AS valid
    FROM (SELECT * FROM read UNION ALL SELECT * REPLACE ('clean' AS source) FROM read
      WHERE amount > 0 AND source = 'atm') GROUP BY source""",
)
def bad_amount_fails_source(spark, sf):
    specs = sources(spark, sf)
    good = R.read_text_csv(spark, specs[1].path, with_ordinal=True)
    plain = ~F.col("amount").rlike("-|7x7|^4,5,6") & F.col("amount").rlike("[0-9]")
    clean = R.Source(name="clean", mapping="atm", frame=good.filter(plain).drop("row_ordinal"))
    report = R.ingest(spark, [*specs, clean], on_bad_amount="fail_source").source_report()
    return report.select(
        "source", (F.col("status") == "FAILED").alias("failed"), "rows_read", "valid"
    )


@query(
    "s06_surplus_cells",
    """SELECT o_orderkey % 9 = 0 AS surplus, count(*) AS n, count(*) FILTER (o_orderkey % 9 = 0) AS lines
    FROM orders GROUP BY 1""",
)
def surplus_cells(spark, sf):
    """Rows with more cells than the header, which an unquoted comma makes."""
    priority = F.col("o_orderpriority")
    rows = spark.read.parquet(f"{sf}/orders.parquet").select(
        order_key().cast("string").alias("key"),
        F.when(order_key() % 9 == 0, F.concat(priority, F.lit(",more"))).otherwise(priority).alias("note"),
    )
    path = f"{scratch_path(spark, 'surplus')}/orders"
    rows.write.csv(path, header=True, quote="")
    text = R.read_text_csv(spark, path, surplus="line")
    return text.groupBy(F.col("line").isNotNull().alias("surplus")).agg(
        F.count("key").alias("n"), F.count("line").alias("lines")
    )


@query(
    "i10_positions_of_a_frame",
    f"""WITH {READ} SELECT count(*) AS rejects, count(*) AS positions, true AS inside
    FROM read WHERE field IS NOT NULL AND source = 'pos'""",
)
def frame_positions(spark, sf):
    """Rejects of a frame in many partitions have positions of their own among its rows."""
    rows = raw(spark, sf).filter(order_key() % 3 == 0).repartitionByRange(4, "o_orderkey").select(*POS.required)
    frame = rows.cache()
    n = frame.count()
    rejects = R.ingest(spark, [R.Source(name="pos", mapping="pos", frame=frame)]).rejects
    return rejects.agg(
        F.count(F.lit(1)).alias("rejects"),
        F.count_distinct("row_index").alias("positions"),
        F.bool_and(F.col("row_index").between(0, n - 1)).alias("inside"),
    )


@query(
    "v02_broken_part_file",
    f"""WITH {READ} SELECT source, 'ok' AS status, count(*) AS rows_read FROM read
    WHERE source <> 'online' GROUP BY source UNION ALL SELECT 'broken', 'FAILED', 0""",
)
def broken_part_file(spark, sf):
    """A part file with another header fails its own source and no other."""

    def build():
        return raw(spark, sf).select(*POS.required)

    path = f"{scratch_path(spark, 'broken')}/pos"
    build().write.csv(path, header=True)
    build().select(*reversed(POS.required)).write.mode("append").csv(path, header=True)
    specs = [*sources(spark, sf)[:2], R.Source(path, "broken", "pos")]
    return R.ingest(spark, specs).materialized().source_report().select("source", "status", "rows_read")


#: Longer than the order dates reach, so that all copies of an id are one session.
_DELAY = "4000 days"
_STREAMS: dict[tuple[str, str], OrderedIngest] = {}


def settled_stream(spark, sf) -> OrderedIngest:
    """The three raw sources as streams whose newest files arrive first, one a batch, closed by a record of a later time.

    Run once per session: the records and the report read the tables that it leaves.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key in _STREAMS:
        return _STREAMS[key]
    folders = {name: (written(spark, sf, f"{name}_raw", None), mapping) for name, (_, mapping) in _KINDS.items() if sources(spark, sf)}
    closing, path = scratch_path(spark, "closing"), scratch_path(spark, "stream")
    last = {f: "0" for f in POS.required} | {"transaction_id": "closing", "amount": "1", "currency": "EUR", "card_last4": "0000"}
    last = spark.createDataFrame([last | {"timestamp": "2030-01-01T00:00:00"}]).select(*POS.required)
    last.limit(0).write.csv(closing, header=True)
    stream = OrderedIngest(
        spark, {**folders, "closing": (closing, POS)}, path, _DELAY, {"latestFirst": "true", "maxFilesPerTrigger": "1"}
    )
    stream.land().awaitTermination()
    stream.settle().awaitTermination()
    last.write.mode("append").csv(closing, header=True)
    stream.land().awaitTermination()
    stream.settle().awaitTermination()
    _STREAMS[key] = stream
    return stream


@query("x01_stream_first_by_position", f"WITH {READ} SELECT {_RECORDS} FROM valid WHERE k = 1")
def stream_first_by_position(spark, sf):
    return settled_stream(spark, sf).records().filter("source != 'closing'").select(*_SHOWN)


@query(
    "x01_stream_report",
    f"WITH {REPORT} SELECT source, rows_read, valid, invalid, duplicates_removed, CAST(0 AS BIGINT) AS waiting FROM report",
)
def stream_report(spark, sf):
    return settled_stream(spark, sf).report().filter("source != 'closing'")
