import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pitlane.session import LOCAL_TUNING, get_session
    s = get_session("local[*]", extra={**LOCAL_TUNING, "spark.driver.memory": "8g",
                                       "spark.checkpoint.dir": tempfile.mkdtemp(prefix="pitlane-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s


def rows(df, order=None):
    """Collect a small test result as sorted plain tuples."""
    out = [tuple(r) for r in df.collect()]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r)) if order is None else out
