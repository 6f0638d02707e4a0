import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tagseries.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=8, partitions=4)
    # tiny inputs: compiling costs more than it saves; the DuckDB comparison switches it on
    session.conf.set("spark.sql.codegen.wholeStage", "false")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SMALL):
        pytest.skip("test tables are not here")
    return SMALL
