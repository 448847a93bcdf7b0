import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "8").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return DATA


@pytest.fixture(scope="session")
def duck(sf_dir):
    """A DuckDB connection with the tables as views."""
    import duckdb

    con = duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        path = f"{sf_dir}/{t}.parquet"
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def plain(v):
    """A value that compares equal across engines."""
    if isinstance(v, float):
        return repr(round(v, 6))
    return repr(float(v)) if type(v).__name__ == "Decimal" else repr(v)


def assert_same(df, duck, sql):
    columns = sorted(df.columns)
    assert columns == sorted(duck.sql(sql).columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    want = duck.sql("SELECT " + ", ".join(f'"{c}"' for c in columns) + f" FROM ({sql})").fetchall()
    assert got == sorted(tuple(plain(v) for v in r) for r in want)
