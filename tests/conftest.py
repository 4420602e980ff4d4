import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from candlekit.schema import BARS_SCHEMA  # noqa: E402
from candlekit.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "candlekit-tests",
        master="local[4]",
        cores=4,
        **{
            # Many short queries: skip the slow compiler stages.
            "spark.driver.extraJavaOptions": "-XX:TieredStopAtLevel=1",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint")),
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


MAIN_ROWS = """
AAPL  2024-01-02 09:30  185.50 186.00 185.00 185.75 1000000
AAPL  2024-01-02 10:00  185.75 186.25 185.50 186.00 950000
AAPL  2024-01-03 09:30  186.25 187.00 186.00 186.75 1100000
AAPL  2024-01-03 10:00  186.75 187.25 186.50 187.00 980000
AAPL  2024-01-04 09:30  187.25 188.00 187.00 187.75 1050000
GOOGL 2024-01-02 09:30  140.00 140.50 139.50 140.25 800000
GOOGL 2024-01-02 10:00  140.25 140.75 140.00 140.50 750000
GOOGL 2024-01-03 09:30  140.75 141.25 140.50 141.00 850000
GOOGL 2024-01-03 10:00  141.00 141.50 140.75 141.25 780000
GOOGL 2024-01-04 09:30  141.50 142.00 141.25 141.75 830000
"""


def bar_rows(text):
    from datetime import datetime

    for line in text.strip().splitlines():
        ticker, day, time, *prices, volume = line.split()
        yield (ticker, datetime.fromisoformat(f"{day} {time}"), *map(float, prices), int(volume))


@pytest.fixture(scope="session")
def main_bars(spark):
    return spark.createDataFrame(list(bar_rows(MAIN_ROWS)), BARS_SCHEMA)


@pytest.fixture(scope="session")
def no_bars(spark):
    return spark.createDataFrame([], BARS_SCHEMA)
