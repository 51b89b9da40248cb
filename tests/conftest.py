import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tributary.session import configure
    session = (SparkSession.builder.master("local[*]")
               .config("spark.sql.shuffle.partitions", "8")
               .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tributary-wh-"))
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    yield session


@pytest.fixture
def scratch(spark):
    from tributary.session import scratch_path
    return lambda name: scratch_path(spark, "tests", name)
