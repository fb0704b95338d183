import shutil

import pytest
from pyspark.sql import SparkSession

from cohortloom.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", shared.as_uri())
        .config("spark.sql.warehouse.dir", (shared / "warehouse").as_uri())
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()
    shutil.rmtree(shared)


@pytest.fixture(scope="session")
def value(spark):
    """Evaluate one SQL expression."""

    def run(expression: str):
        return spark.range(1).selectExpr(f"{expression} AS v").first()["v"]

    return run
