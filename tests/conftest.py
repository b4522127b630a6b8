import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["PYTHONPATH"] = f"{Path(__file__).resolve().parents[1]}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp()}").config("spark.sql.warehouse.dir", tempfile.mkdtemp()).getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()
