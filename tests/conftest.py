import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (SparkSession.builder.master("local[4]").appName("tagshelf-tests")
               .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
               .config("spark.driver.memory", "4g")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.session.timeZone", "UTC")
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Builds a table of strings (or of the given DDL schema) from tuples."""
    def build(names, data, schema=None):
        return spark.createDataFrame(data, schema or ", ".join(f"`{n}` string" for n in names.split()))
    return build


@pytest.fixture(scope="session")
def vectors(spark):
    """Four words on two axes, one of them a zero vector."""
    data = [("potato", [1.0, 0.0]), ("chip", [0.0, 1.0]), ("stew", [3.0, 4.0]), ("air", [0.0, 0.0])]
    return spark.createDataFrame(data, "word string, vector array<double>")


@pytest.fixture
def shuffled_joins(spark):
    """Keeps Spark from broadcasting small tables on its own."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
