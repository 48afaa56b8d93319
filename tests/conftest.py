from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).parent.parent))
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    conf = {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "3g", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp"), "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="spark-", dir="/tmp")}
    s = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def folder():
    return tempfile.mkdtemp(prefix="spark-", dir="/tmp")
