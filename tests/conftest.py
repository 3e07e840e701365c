import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
FIXTURES = os.path.join(os.path.dirname(os.path.abspath(__file__)), "fixtures")


@pytest.fixture(scope="session")
def spark():
    from cuenca.session import get_session
    ckpt = tempfile.mkdtemp(prefix="cuenca-test-ckpt-")
    s = get_session("local[4]", app="cuenca-tests", shuffle_partitions=4,
                    extra={"spark.checkpoint.dir": ckpt, "spark.ui.showConsoleProgress": "false",
                           "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cuenca-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb
    from cuenca.sources.tables import TABLE_NAMES
    con = duckdb.connect()
    for t in TABLE_NAMES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con
