import os

import pytest

from contrail.session import build_session

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("contrail-tests", "local[8]", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", SMALL)


@pytest.fixture
def flights_of(spark):
    """Build bronze-named flights from a few columns; the rest are NULL."""
    from contrail import contracts as C

    def build(*rows: dict):
        names = [C.YEAR_PARTITION, *C.FLIGHT_COLUMNS[1:]]
        schema = ", ".join(f"`{name}` string" for name in names)
        return spark.createDataFrame(
            [tuple(row.get(name) for name in names) for row in rows], schema)

    return build


@pytest.fixture
def silver_of(spark):
    """Build silver rows from a few columns; the rest are NULL."""
    from contrail import contracts as C

    def build(*rows: dict):
        return spark.createDataFrame(
            [tuple(row.get(name) for name in C.SILVER.names) for row in rows], C.SILVER)

    return build
