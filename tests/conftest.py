import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parents[1])
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = ROOT + os.pathsep + os.environ.get("PYTHONPATH", "")
os.environ.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture(scope="session")
def spark():
    from cadenza.session import session

    s = session("tests", "local[4]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false", spark__driver__memory="4g", spark__ui__showConsoleProgress="false")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
