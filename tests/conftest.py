import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from pathweave.session import builder

    out = (
        builder("tests").master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g").getOrCreate()
    )
    out.sparkContext.setLogLevel("ERROR")
    yield out
    out.stop()


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
