import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[4]", app="strata-tests", shuffle_partitions=4)
    if not s.conf.get("spark.checkpoint.dir", None):
        d = tempfile.mkdtemp(prefix="strata-test-ckpt-")
        s.conf.set("spark.checkpoint.dir", d)
    yield s


@pytest.fixture()
def tmp_root(tmp_path):
    return str(tmp_path)
