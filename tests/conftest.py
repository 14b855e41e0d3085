import math
import os
import sys
from glob import glob

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse"))).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for f in glob(f"{SF}/*.parquet"):
        connection.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return connection


def canonical(value):
    """Values of either engine in one form."""
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return repr(round(value, 9) + 0.0)
    if isinstance(value, (list, tuple)):
        return str([canonical(v) for v in value])
    return str(value)


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(canonical(r[k]) for k in order) for r in rows)
