import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reshift.session import local_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="*", shuffle_partitions=8, app="reshift-tests",
                            extra={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="reshift-wh-")})
    # tests own their checkpoint folder; a cluster names its shared one
    if not session.sparkContext.getCheckpointDir() and not session.conf.get("spark.checkpoint.dir", None):
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="reshift-test-ckpt-"))
    yield session
    session.stop()
