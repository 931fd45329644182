import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from matchloom.session import local_session


@pytest.fixture(scope="session")
def spark():
    s = local_session(8, "tests", "8g")
    s.sparkContext.setLogLevel("ERROR")
    s.conf.set("spark.sql.shuffle.partitions", "8")
    yield s
    s.stop()
