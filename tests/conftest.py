import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

from cairnflow.session import local_session  # noqa: E402

DATA = Path(os.environ.get("TESTDATA", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    folder = DATA / "sf0.001"
    if not folder.exists():
        pytest.skip("no test tables")
    return str(folder)
