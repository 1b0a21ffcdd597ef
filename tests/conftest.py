import os
import subprocess
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    local = subprocess.run(["mktemp", "-d", "/tmp/spark-XXXXXX"], capture_output=True, text=True, check=True).stdout.strip()
    found = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.local.dir", local)
        .config("spark.sql.warehouse.dir", f"{local}/warehouse")
        .config("spark.checkpoint.dir", f"file://{local}/shared")
        .getOrCreate()
    )
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()
