import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from blockloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(
        "tests", 8, **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g"}
    )
    yield session
    session.stop()


@pytest.fixture
def plan_of():
    """Physical plan as text."""

    def text(frame):
        return frame._jdf.queryExecution().executedPlan().toString()

    return text


@pytest.fixture
def setting(spark):
    """Change session settings for one test."""
    changed = {}

    def change(key, value):
        changed.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in changed.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)
