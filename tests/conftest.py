import os
import sys
import tempfile

import pytest

sys.path[:0] = [os.path.dirname(os.path.abspath(__file__)), os.path.dirname(os.path.dirname(os.path.abspath(__file__)))]

from testdata import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from bluelines.session import ENGINE_DEFAULTS

    b = (SparkSession.builder.master("local[4]").appName("bluelines-tests")
         .config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false"))
    for k, v in ENGINE_DEFAULTS.items():
        b = b.config(k, v)
    s = b.getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir() and not s.conf.get("spark.checkpoint.dir", None):
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="bluelines-test-ckpt-"))
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from bluelines.sources.tables import TABLES, table_path

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF_SMALL, t)}')")
    return con
