import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from millrace.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests", "local[8]", shuffle_partitions=4, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="8g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from millrace.session import Tables

    return Tables(spark, SF)


def rows(df, *order):
    """Collected rows as plain tuples, sorted."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((v is not None, v) for v in r))
