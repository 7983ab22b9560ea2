import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from sluice.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("*", shuffle_partitions=8)
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s
    s.stop()
