import logging
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tabweave.session import local_session

logging.getLogger("SQLQueryContextLogger").setLevel(logging.CRITICAL)
logging.getLogger("DataFrameQueryContextLogger").setLevel(logging.CRITICAL)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, shuffle_partitions=4)
    session.sparkContext.setLogLevel("OFF")
    # On tables this small, compiling a plan costs more than running it interpreted.
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    session.conf.set("spark.sql.codegen.factoryMode", "NO_CODEGEN")
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """Rows and a DDL schema -> DataFrame."""

    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return make
