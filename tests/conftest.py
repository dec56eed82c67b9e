import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from lapak.session import local_session

    session = local_session("lapak-tests", cores=8)
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame("a int, b string", [(1, "x")])``"""
    return lambda schema, rows: spark.createDataFrame(rows, schema)


@pytest.fixture
def values():
    """Single column of a frame as a list, ordered by the first column."""
    return lambda df, *names: [tuple(r) if len(names) != 1 else r[0] for r in df.orderBy(df.columns[0]).select(*names).collect()]
