"""The driver's entry, and the package on the workers."""

import __spark_entry__ as entry
import pyarrow as pa

from queries import ORACLES, QUERIES
from riskframe.shipping import ship


def test_every_query_ships_the_package():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert all(q.__wrapped__ for q in entry.queries().values())


def test_workers_import_the_archive(spark):
    ship(spark)
    ship(spark)
    assert [f for f in spark.sparkContext._python_includes if f.startswith("riskframe")] == ["riskframe.zip"]

    def where(batches):
        import sys

        import riskframe.contract

        for b in batches:
            shipped = [any(p.endswith("riskframe.zip") for p in sys.path)] * b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(shipped), pa.array([riskframe.contract.TARGET] * b.num_rows)], names=["shipped", "target"])

    rows = spark.range(3).mapInArrow(where, "shipped boolean, target string").collect()
    assert {tuple(r) for r in rows} == {(True, "fraud_bool")}
