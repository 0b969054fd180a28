from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep))])

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
    builder = builder.config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "4g")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return DATA


def canonical(v):
    if isinstance(v, float):
        return float(f"{v:.9g}")
    return str(v).replace(" 00:00:00", "") if hasattr(v, "isoformat") else v


def same_rows(spark_rows, columns, cursor) -> None:
    """Rows of both engines, columns by name, in any order."""
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(columns)
    order = [names.index(c) for c in columns]
    mine = sorted(repr(tuple(canonical(r[c]) for c in columns)) for r in spark_rows)
    theirs = sorted(repr(tuple(canonical(r[i]) for i in order)) for r in cursor.fetchall())
    assert mine == theirs


def close_rows(spark_rows, columns, cursor) -> None:
    """Rows of both engines, unrounded: numbers to 1e-9 of their size, all else equal."""
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(columns)
    order = [names.index(c) for c in columns]

    def arranged(rows):
        plain = [[canonical(v) if not isinstance(v, float) else v for v in r] for r in rows]
        return sorted(plain, key=lambda r: [repr(v) if not isinstance(v, float) else f"{v + 1e-7:.5g}" for v in sorted(r, key=lambda v: isinstance(v, float))])

    mine, theirs = arranged([[r[c] for c in columns] for r in spark_rows]), arranged([[r[i] for i in order] for r in cursor.fetchall()])
    assert len(mine) == len(theirs)
    for a, b in zip(mine, theirs, strict=True):
        for x, y, c in zip(a, b, columns, strict=True):
            assert abs(x - y) <= 1e-9 * max(1, abs(x)) if isinstance(x, float) and isinstance(y, float) else x == y, (c, a, b)


@pytest.fixture(scope="session")
def duck(sf):
    import glob

    import duckdb

    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        path = f if os.path.isfile(f) else f"{f}/*.parquet"
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{path}'")
    return con
