import tempfile

import pytest
from pyspark.sql import SparkSession

#: Started before the tests are collected, since Columns can be written down only within a session.
SPARK = (
    SparkSession.builder.master("local[4]")
    .config("spark.sql.shuffle.partitions", "4")
    .config("spark.ui.enabled", "false")
    .config("spark.sql.session.timeZone", "UTC")
    .config("spark.driver.memory", "4g")
    .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="shared-"))
    .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="warehouse-"))
    .getOrCreate()
)
SPARK.sparkContext.setLogLevel("ERROR")


@pytest.fixture(scope="session")
def spark():
    return SPARK


@pytest.fixture(scope="session")
def column(spark):
    """Evaluates a Column over literal rows: column(expr, schema, rows) -> list of values."""

    def run(expr, schema, rows):
        return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(expr.alias("out")).collect()]

    return run
