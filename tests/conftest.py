import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
for p in (ROOT, os.path.dirname(os.path.abspath(__file__))):
    if p not in sys.path:
        sys.path.insert(0, p)


@pytest.fixture(scope="session")
def spark():
    from areacast.session import local_session

    session = local_session(8, shuffle_partitions=8, app_name="areacast-tests")
    yield session
    session.stop()


@pytest.fixture
def write_text(tmp_path):
    """Write text files under tmp_path; returns the folder or file path."""
    def _write(name: str, text: str) -> str:
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text, encoding="utf-8")
        return str(path)
    return _write
