import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from panelkit.session import build_session
    scratch = tempfile.mkdtemp(prefix="panelkit-test-")
    s = build_session(master="local[*]", shuffle_partitions=8,
                      extra={"spark.checkpoint.dir": os.path.join(scratch, "ckpt"),
                             "spark.local.dir": os.path.join(scratch, "local")})
    yield s
    s.stop()
