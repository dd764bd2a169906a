import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = local_session("*", shuffle_partitions=8, app_name="cohortlens-tests", checkpoints=str(tmp_path_factory.mktemp("checkpoints")))
    yield s
    s.stop()
