import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from limnia.session import build_session, checkpoint_dir  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    conf = {
        "spark__sql__shuffle__partitions": 4, "spark__ui__enabled": "false", "spark__driver__memory": "8g",
        "spark__driver__host": "localhost",
    }
    s = build_session("limnia-tests", "local[8]", **conf)
    if not checkpoint_dir(s):  # own folder only where the environment names none
        s.stop()
        s = build_session("limnia-tests", "local[8]", spark__checkpoint__dir=tempfile.mkdtemp(prefix="run-"), **conf)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
