import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

#: The driver's small tables; tests that read them are skipped where they are absent.
TINY = Path(os.environ.get("FEEDLOOM_TEST_TABLES", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    work = tempfile.mkdtemp(prefix="feedloom-test-")
    session = (
        SparkSession.builder.master("local[4]")
        .appName("feedloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables():
    if not TINY.exists():
        pytest.skip("no test tables")
    return str(TINY)


@pytest.fixture(scope="session")
def duck(tables):
    """DuckDB with the tables as views."""
    import duckdb

    con = duckdb.connect()
    for p in Path(tables).glob("*.parquet"):
        con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
    return con


@pytest.fixture
def same_rows():
    """Compare a Spark result with SQL over the tables, column by column, order aside."""
    import numpy as np
    import pandas as pd

    def plain(v):
        if isinstance(v, (list, tuple, np.ndarray)):
            return tuple(plain(x) for x in v)
        if isinstance(v, (dict,)):
            return tuple((k, plain(x)) for k, x in sorted(v.items()))
        if hasattr(v, "asDict"):
            return tuple((k, plain(x)) for k, x in sorted(v.asDict().items()))
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return None
        if isinstance(v, (bool, np.bool_)):
            return bool(v)
        if isinstance(v, (float, np.floating)):
            return round(float(v), 6) + 0.0
        if isinstance(v, (int, np.integer)):
            return float(v) if abs(int(v)) < 2**53 else int(v)
        return v

    def check(df, con, sql):
        cols = sorted(df.columns)
        got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == cols
        at = [names.index(c) for c in cols]
        want = [tuple(plain(r[i]) for i in at) for r in rel.fetchall()]
        assert sorted(map(repr, got)) == sorted(map(repr, want))

    return check
