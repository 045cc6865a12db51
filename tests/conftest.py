import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faultline.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="faultline-tests", shuffle_partitions=8,
                      extra_conf={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="faultline-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="faultline-test-")
