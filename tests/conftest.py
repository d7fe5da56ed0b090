import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tidewell.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session(shuffle_partitions=4)


@pytest.fixture(scope="session")
def tables(spark):
    from tidewell.sources.tables import Tables

    return Tables(spark, SF)


@pytest.fixture(scope="session")
def duck():
    from oracle_check import duck

    return duck(SF)
