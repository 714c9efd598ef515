import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tallyline.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cores="4", partitions=2, memory="6g")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """rows(ddl, tuples) -> DataFrame; timestamps and dates may be given as text."""
    def make(ddl, data):
        names = [c.strip().split()[0] for c in ddl.split(",")]
        types = [c.strip().split()[1] for c in ddl.split(",")]
        loose = ", ".join(f"{n} {'string' if t in ('timestamp', 'date') else t}" for n, t in zip(names, types))
        df = spark.createDataFrame(data, loose)
        return df.selectExpr(*[f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types)])
    return make


def table(df, *cols):
    """Rows of a DataFrame as sorted tuples of text, for comparison."""
    picked = df.select(*cols) if cols else df
    return sorted(tuple("" if v is None else str(v) for v in r) for r in picked.collect())
