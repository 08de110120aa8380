import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[4]", spark__sql__shuffle__partitions="2", spark__ui__enabled="false",
        spark__driver__memory="4g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Frame of text lines in ``value``."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=str)
