import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from ledgerflow.session import get_spark, shared_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = get_spark("local[*]", 8)
    shared_dir(s)           # tests run without a cluster setting: create a checkpoint folder
    yield s
    s.stop()
