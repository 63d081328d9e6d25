import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
for path in (ROOT, str(Path(__file__).resolve().parent)):
    if path not in sys.path:
        sys.path.insert(0, path)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from gleanery.session import session

    s = session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
