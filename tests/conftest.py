import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from strata.session import DEFAULT_CONF, scratch_root  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8")
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    scratch_root(session)
    yield session
    session.stop()


@pytest.fixture
def scratch(spark):
    from strata.session import scratch_dir

    return lambda name="t": scratch_dir(spark, name)
