import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]").appName("tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.debug.maxToStringFields", "1000")
        .config("spark.sql.maxMetadataStringLength", "10000")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def settings(spark):
    """`with settings(key=value)`-style session settings, put back afterwards."""
    @contextmanager
    def using(conf):
        before = {key: spark.conf.get(key, None) for key in conf}
        for key, value in conf.items():
            spark.conf.set(key, value)
        try:
            yield
        finally:
            for key, value in before.items():
                spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return using


@pytest.fixture
def events(spark):
    from iotlake.plans import inputs

    return inputs.events(spark, SF)


def rows(frame, *columns):
    """Collected rows as a sorted list of tuples."""
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(frame):
    """The physical plan as text."""
    return frame._jdf.queryExecution().executedPlan().toString()
