import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    session = (SparkSession.builder.master("local[8]").appName("tests")
               .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
               .config("spark.python.sql.dataFrameDebugging.enabled", "false")
               .config("spark.driver.memory", "8g").getOrCreate())
    session.sparkContext.setLogLevel("ERROR")
    from vitaspan.session import drop_frozen, prepare

    yield prepare(session)
    drop_frozen(session)


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of tuples."""
    def collect(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
    return collect
