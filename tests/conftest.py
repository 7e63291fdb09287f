import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from abacist import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session(
        "abacist-tests",
        master="local[8]",
        spark__sql__shuffle__partitions="4",
        spark__driver__memory="6g",
        spark__sql__maxMetadataStringLength="5000",
        spark__ui__showConsoleProgress="false",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a report as dicts, sorted by the given columns."""

    def collect(df, *by):
        found = [r.asDict(recursive=True) for r in df.collect()]
        return sorted(found, key=lambda r: tuple((r[c] is None, r[c]) for c in by))

    return collect
