import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from tickline.session import build_session

    ckpt = tempfile.mkdtemp(prefix="tickline-test-ckpt-")
    s = build_session(
        "tickline-tests",
        master="local[8]",
        shuffle_partitions=8,
        extra_conf={"spark.driver.memory": "8g", "spark.checkpoint.dir": ckpt},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Drop a test's temporary views (the memory sink's), which other tests would list."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for t in session.catalog.listTables():
            if t.isTemporary:
                session.catalog.dropTempView(t.name)


@pytest.fixture()
def tmpdir_path():
    return tempfile.mkdtemp(prefix="tickline-test-")
