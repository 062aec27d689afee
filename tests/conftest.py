from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
# Python workers import user functions defined in test modules by name.
os.environ["PYTHONPATH"] = os.pathsep.join(
    [os.path.join(ROOT, "tests"), ROOT, os.environ.get("PYTHONPATH", "")]).rstrip(os.pathsep)

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from sliceflow.session import build_session

    s = build_session("local[4]", "sliceflow-tests", shuffle_partitions=4)
    # tests only: the checkpoint root is unset locally, so give it a fresh folder
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sliceflow-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_out(tmp_path):
    return str(tmp_path)
