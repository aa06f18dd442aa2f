import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from barsmith import session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    built = session.build("tests", cores="8", partitions=4)
    built.sparkContext.setLogLevel("ERROR")
    yield built
    built.stop()
