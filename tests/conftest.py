import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from donorlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4,
                      extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="donorlens-wh-")})
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    if not os.path.exists(os.path.join(SF_SMALL, "lineitem.parquet")):
        pytest.skip("test data not available")
    return SF_SMALL
