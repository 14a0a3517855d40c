import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tidemark.session import spark_session

    session = spark_session("tests", **{
        "spark.master": "local[4]",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW_FIELDS = (
    "event_id event_time arrival_time event_type product_id category_id category_code brand price"
    " user_id session_id is_late_arrival late_arrival_delay_seconds"
).split()


@pytest.fixture(scope="session")
def make_events(spark):
    """Raw events from short dicts; what is left out gets a plain value."""
    from tidemark.schemas import RAW_EVENT

    def make(rows):
        full = []
        for i, row in enumerate(rows):
            base = {
                "event_id": f"e{i:04d}", "event_time": None, "arrival_time": "2024-10-15 10:00:00",
                "event_type": "view", "product_id": "p1", "category_id": None, "category_code": None,
                "brand": None, "price": 0.0, "user_id": "u1", "session_id": "s1", "is_late_arrival": False,
                "late_arrival_delay_seconds": None,
            }
            base.update(row)
            full.append(tuple(base[f] for f in RAW_FIELDS))
        return spark.createDataFrame(full, RAW_EVENT)

    return make


@pytest.fixture(scope="session")
def canonical(make_events):
    from tidemark.operators.events import canonical_events

    return lambda rows: canonical_events(make_events(rows))
