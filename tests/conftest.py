import os
import sys

import pytest

# Spark gives its Python tasks one BLAS thread; functions of a task that tests call directly get the same, before numpy is loaded
os.environ.setdefault("OMP_NUM_THREADS", "1")
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import local_session

    session = local_session(os.environ.get("TEST_CPUS", "8"), "tests")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Frame from a DDL schema and literal rows."""
    return lambda schema, *data: spark.createDataFrame(list(data), schema)


def values(df, *columns):
    """Sorted list of row tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is not None, v) if not isinstance(v, (list, dict)) else str(v) for v in r))
