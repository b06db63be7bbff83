import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tests"))

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from cartwright.session import prepare

    work = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    session = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .appName("cartwright-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.warehouse.dir", f"{work}/warehouse")
        .config("spark.checkpoint.dir", f"{work}/shared")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    prepare(session)
    yield session
    session.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
