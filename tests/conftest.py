import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tickloom.schemas import WINDOW  # noqa: E402
from tickloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return SMALL


# The five-row lake: AAPL and NVDA twice, with equal window ends.
LAKE_ROWS = [
    ("AAPL", 172.50, 172.47, 172.53, 0.0078, 0.06, 287, 75349.35),
    ("NVDA", 820.00, 819.78, 820.11, 0.0538, 0.33, 327, 83394.95),
    ("TSLA", 195.00, 194.94, 195.08, 0.0135, 0.14, 311, 78329.42),
    ("AAPL", 172.55, 172.50, 172.60, 0.0092, 0.10, 250, 60466.79),
    ("NVDA", 819.90, 819.80, 820.00, 0.0319, 0.20, 259, 64720.39),
]


@pytest.fixture(scope="session")
def five_rows(spark):
    start, end = datetime(2026, 5, 10, 5, 10), datetime(2026, 5, 10, 5, 15)
    rows = [(s, start, end, *rest) for s, *rest in LAKE_ROWS]
    return spark.createDataFrame(rows, WINDOW)


def as_dicts(df, key):
    return {row[key]: row.asDict() for row in df.collect()}
