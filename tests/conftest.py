import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark():
    from reviewlake.session import get_spark
    s = get_spark("local[*]", app="reviewlake-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir(spark):
    from reviewlake.session import scratch_path
    return scratch_path(spark, "test")
