from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from weirgate.session import RUNTIME_CONF, STREAM_CONF  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = (
        SparkSession.builder.master("local[8]")
        .appName("weirgate-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "6g")
    )
    for key, value in {**RUNTIME_CONF, **STREAM_CONF}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
