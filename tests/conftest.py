from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session

    s = build_session("local[4]", shuffle_partitions=8, app_name="tessera-tests",
                      extra={"spark.driver.memory": "8g",
                             "spark.checkpoint.dir": tempfile.mkdtemp(prefix="tessera-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    import duckdb

    from tessera.sources.tables import TABLES

    def connect(sf_dir):
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
        return con

    return connect


@pytest.fixture(scope="session")
def registry():
    from tessera.plans.registry import load_all

    return load_all()
