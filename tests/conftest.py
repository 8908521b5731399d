import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cellweft.session import build_session

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", 8, partitions=4, memory="8g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def cells(spark):
    from cellweft.sources.cells import cells as make
    return make(spark, SF).cache()


@pytest.fixture(scope="session")
def quant(spark):
    from cellweft.sources.cells import quant as make
    return make(spark, SF).cache()
