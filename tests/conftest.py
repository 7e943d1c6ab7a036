import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from docketry.session import build_session

    session = build_session("tests", master="local[4]", shuffle_partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def rows():
    return lambda df, *columns: sorted(tuple(r[c] for c in (columns or df.columns)) for r in df.collect())
