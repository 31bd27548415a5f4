import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.driver.memory", "3g").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", str(base / "warehouse")).getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    session.sparkContext.environment["PYTHONPATH"] = str(ROOT)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return DATA
