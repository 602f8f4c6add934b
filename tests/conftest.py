import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pulsegrid.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="4", spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows(df, *columns):
    """Sorted tuples of a DataFrame."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(x is None, str(x)) for x in r])


@pytest.fixture(autouse=True)
def arrow_settings(request):
    """Operators may lower the size of Arrow batches for their session, which all tests share: each test starts from the defaults."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for name in ("maxRecordsPerBatch", "maxBytesPerBatch"):
            session.conf.unset(f"spark.sql.execution.arrow.{name}")
