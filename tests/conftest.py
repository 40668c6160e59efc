import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TEST_SF_DIR = os.environ.get("FRESHET_TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from freshet.session import build_session

    # Catalog tables of the tests live in a scratch warehouse, not in the repo.
    warehouse = tempfile.mkdtemp(prefix="freshet-warehouse-")
    s = build_session(master="local[4]", app_name="freshet-tests", shuffle_partitions=8,
                      extra={"spark.sql.warehouse.dir": warehouse})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return TEST_SF_DIR
