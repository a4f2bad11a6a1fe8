import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    found = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "4g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", f"file://{base}/shared").config("spark.sql.warehouse.dir", f"{base}/warehouse").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return f"{DATA}/sf0.001"
