import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from strata.session import get_session
    wh = tmp_path_factory.mktemp("warehouse")
    s = get_session("local[4]", app="strata-tests", shuffle_partitions=8,
                    extra={"spark.sql.warehouse.dir": str(wh),
                           "spark.checkpoint.dir": str(tmp_path_factory.mktemp("ckpt"))})
    yield s
    s.stop()
