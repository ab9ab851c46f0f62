import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    made = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-"))
        .getOrCreate()
    )
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()
