import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rosterflow.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def rows_of(df, *columns):
    """Rows as sorted tuples; null sorts first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
