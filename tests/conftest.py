import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def same(sf_dir):
    """Compares a DataFrame with SQL that DuckDB runs over the same tables."""
    import duckdb

    def rows(frame, cols):
        text = lambda v: "~" if v is None or str(v) in ("<NA>", "nan", "NaT") else repr(float(v)) if hasattr(v, "__float__") and not isinstance(v, (str, bool)) else str(v)
        return sorted(tuple(map(text, r)) for r in frame[cols].astype(object).itertuples(index=False))

    def compare(df, sql, tables=None):
        con = duckdb.connect()
        for p in Path(tables or sf_dir).glob("*.parquet"):
            con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
        want, got = con.execute(sql).df(), df.toPandas()
        assert sorted(want.columns) == sorted(got.columns)
        assert rows(got, sorted(got.columns)) == rows(want, sorted(want.columns))

    return compare
