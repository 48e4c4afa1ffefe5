import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import ackline  # noqa: E402
from ackline import session  # noqa: E402

cloudpickle.register_pickle_by_value(ackline)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("ackline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    )
    spark = session.configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()
