import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from ledgerline.session import build_session, clear_staged
    session = build_session("local[4]", "ledgerline-tests", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    clear_staged(session)
    session.stop()


@pytest.fixture(scope="session")
def duck():
    from oracle import connect
    return connect(SF_DIR)
