import os

import pytest

from faultline.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session("local[8]", shuffle_partitions=4, extra_conf={
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints"))})
    s.sparkContext.setLogLevel("ERROR")
    return s


SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf():
    return SF
