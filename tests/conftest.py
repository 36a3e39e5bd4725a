import os
import sys
import uuid

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from orderpulse.operators.tables import ensure_tables  # noqa: E402
from orderpulse.plans.initial_load import Target  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.sql.maxMetadataStringLength", "1000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def target(spark, tmp_path):
    """A function that makes an empty database with the given tables."""
    import datetime

    def make(*specs):
        name = f"t_{uuid.uuid4().hex[:10]}"
        ensure_tables(spark, name, str(tmp_path / name), specs)
        return Target(name, str(tmp_path / name), datetime.date(2024, 1, 2))
    return make


@pytest.fixture
def tiny_limits(monkeypatch):
    """Every size check fails and every key is hot, so that the distributed forms run."""
    from orderpulse.operators import sizing
    monkeypatch.setattr(sizing, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(sizing, "ROWS_PER_SPLIT", 2)


def rows(df):
    """Rows as a sorted list of tuples; NULL sorts first."""
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is not None, str(v)) for v in r])
