import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
for folder in (ROOT, ROOT / "tests"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from millrace.session import local_session, prepare  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = prepare(local_session(4, "millrace-tests"))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()
