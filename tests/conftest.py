import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tidewater.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tw-ckpt-")})
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
