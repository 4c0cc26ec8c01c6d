import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from evenkeel import DEFAULT_LIMITS, Limits  # noqa: E402

# Every key set is too large to broadcast, every key with more than two rows is hot, tables are never read again.
TIGHT_LIMITS = Limits(broadcast_bytes=0, hot_rows=2, hot_keys=10**9, reread_share=9)


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(params=[DEFAULT_LIMITS, TIGHT_LIMITS], ids=["broadcast", "shuffle"])
def limits(request):
    """Both ways of fetching rows must give the same results."""
    return request.param
