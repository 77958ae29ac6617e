import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = f"{TOP}:{os.environ.get('PYTHONPATH', '')}"  # for Python workers


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tidemark.session import session

    s = session("local[4]", 4, **{"spark.ui.enabled": "false", "spark.driver.memory": "3g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.ui.showConsoleProgress": "false"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
