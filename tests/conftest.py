import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sample_tables import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from kiln.session import get_spark

    s = get_spark("local[4]", app="kiln-tests")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from kiln.sources.tables import TABLE_NAMES

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con
