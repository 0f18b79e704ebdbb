import os
import sys
from pathlib import Path

import pytest

ROOT = str(Path(__file__).resolve().parent.parent)
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join(x for x in (ROOT, os.environ.get("PYTHONPATH", "")) if x)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from daystack.session import local_session

    s = local_session(4, 4, **{"spark.driver.memory": "4g", "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")), "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoint"))})
    s.sparkContext.setLogLevel("ERROR")
    return s
