import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from tallyhouse.session import local_session  # noqa: E402

DATA = Path(os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    small = {"spark.sql.shuffle.partitions": "3", "spark.default.parallelism": "3"}
    session = local_session(8, memory="6g", app="tallyhouse-tests", conf=small)
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture(scope="session")
def sf_dir():
    if not DATA.exists():
        pytest.skip("driver tables not present")
    return str(DATA)


@pytest.fixture
def tuples():
    """Rows of a DataFrame as a sorted list of tuples."""
    return lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
