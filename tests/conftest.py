import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession
    from quarry.session import get_spark
    s = SparkSession.getActiveSession() or get_spark(master="local[8]", shuffle_partitions=8, app="quarry-tests")
    yield s


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from quarry.sources.tables import TABLES

    def make(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con
    return make
