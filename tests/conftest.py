import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


@pytest.fixture(scope="session")
def spark():
    from ledgerline.session import build_session
    scratch = tempfile.mkdtemp(prefix="ledgerline-test-", dir="/tmp")
    s = build_session("local[4]", app="ledgerline-tests", shuffle_partitions=4,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.sql.warehouse.dir": os.path.join(scratch, "wh")})
    yield s
    s.stop()


@pytest.fixture()
def scratch_dir():
    return tempfile.mkdtemp(prefix="ledgerline-case-", dir="/tmp")
