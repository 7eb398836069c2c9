import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools")]

from faultline.session import configure, shared_dir  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "4")
               .config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
               .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    shared_dir(session)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return SF
