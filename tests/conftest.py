import pathlib
import sys

import pytest
from paths import SMALL

ROOT = pathlib.Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))


@pytest.fixture(scope="session")
def spark():
    from formloom.session import local_session

    session = local_session("4", app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from formloom.sources.testdata import Tables

    return Tables(spark, SMALL)
