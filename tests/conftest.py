from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    from sylva.session import local_session

    s = local_session("tests", "4", spark__driver__memory="4g", spark__sql__shuffle__partitions="4")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf() -> str:
    return f"{DATA}/sf0.001"
