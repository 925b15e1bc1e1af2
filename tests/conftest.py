import os
import sys
import tempfile

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mirrorset.config import Limits  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="mirrorset-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(params=[Limits(), Limits(small_rows=0, group_rows=0, salts=20)], ids=["small", "large"])
def limits(request):
    """Both ways of planning: counted tables that fit, and tables that do not."""
    return request.param


@pytest.fixture(scope="session")
def hot(spark):
    """2,000 rows of which one group holds a third and one key column is sometimes NULL."""
    return spark.range(2000).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('g', id % 40) END AS g",
        "(id * 7919) % 1000 AS v",
    )
