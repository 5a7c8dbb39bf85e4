import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

DATA = os.environ.get("TEST_DATA", "/root/testdata")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyloom.session import build_session

    s = build_session("tests", "local[8]", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")), "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    """Smallest tables by default; TEST_SF=sf0.01 runs the same checks on the larger ones."""
    return f"{DATA}/{os.environ.get('TEST_SF', 'sf0.001')}"
