from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
sys.path.insert(0, str(ROOT / "tools"))

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from stratamart.session import build_session
    s = build_session("tests", "local[4]", 4, **{"spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def duck():
    from check_oracles import duck as connect
    return connect(SF_DIR)


@pytest.fixture()
def scratch(spark):
    from stratamart.session import fresh_path
    return lambda name: fresh_path(spark, name)


@pytest.fixture(scope="session")
def shop(spark):
    from fixture_rows import raw_tables
    return raw_tables(spark)
