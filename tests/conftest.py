import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def spark():
    from tripflow.session import build_session

    session = build_session(
        "tripflow-tests",
        "local[8]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="6g",
    )
    yield session
    session.stop()


@pytest.fixture
def staging(spark):
    """Builds staging rows from dicts; what a row leaves out is NULL."""
    from datetime import datetime

    from tripflow import schemas

    def build(*rows):
        filled = []
        for row in rows:
            full = {f.name: row.get(f.name) for f in schemas.STAGING.fields}
            if isinstance(full["event_time"], str):
                full["event_time"] = datetime.fromisoformat(full["event_time"])
            if full["event_time"] is not None:
                full["event_date"] = full["event_time"].date()
            filled.append(tuple(full.values()))
        return spark.createDataFrame(filled, schemas.STAGING)

    return build


def pytest_configure(config):
    import os
    import time

    os.environ["TZ"] = "UTC"
    time.tzset()
