import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def vectors(spark):
    """200 vectors of 12 small integers in five loose groups, and exact copies of some."""
    import numpy as np

    rng = np.random.default_rng(7)
    heart = rng.integers(0, 40, (5, 12))
    rows = [
        (int(i), [float(v) for v in heart[i % 5] + rng.integers(-6, 7, 12)]) for i in range(180)
    ]
    rows += [(1000 + i, rows[i][1]) for i in range(20)]
    return spark.createDataFrame(rows, "row_id bigint, fp array<float>").repartition(3)
