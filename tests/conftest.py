import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cardsentry.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", shuffle_partitions=8,
                    extra_conf={"spark.driver.memory": "8g"})
    # tests set their own shared folder (a cluster names it in spark.checkpoint.dir)
    if s.sparkContext.getCheckpointDir() is None:
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cardsentry-test-"))
    yield s
    s.stop()
