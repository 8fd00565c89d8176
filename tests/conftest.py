import os
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakerecon import local_session  # noqa: E402

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    root = tempfile.mkdtemp(prefix="lakerecon-tests-")
    session = local_session(
        "tests",
        8,
        **{
            "spark.checkpoint.dir": f"{root}/shared",
            "spark.sql.warehouse.dir": f"{root}/warehouse",
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)
