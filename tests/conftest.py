import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ratecast.session import get_spark
    s = get_spark("ratecast-tests", master="local[4]", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def events(spark):
    return spark.read.parquet(f"{SF001}/events.parquet")
