import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from wattlake.session import build_session, ensure_checkpoint_dir

    s = build_session("local[*]", "wattlake-tests", {
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="wl-wh-"),
    })
    s.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(s, tempfile.mkdtemp(prefix="wl-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="wl-run-")
