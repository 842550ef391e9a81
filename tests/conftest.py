from __future__ import annotations

import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))
os.environ["PYTHONPATH"] = os.pathsep.join([str(Path(__file__).parents[1]), os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    base = tmp_path_factory.mktemp("spark")
    settings = {
        "spark.sql.shuffle.partitions": "3", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g",
        "spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"file://{base}/warehouse", "spark.ui.showConsoleProgress": "false",
    }
    session = SparkSession.builder.master("local[4]").config(map=settings).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
