import os
import sys
import tempfile
from pathlib import Path

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")
ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path(os.environ.get("TEST_DATA", "/root/testdata/sf0.001"))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    own = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.sql.session.timeZone", "UTC").config("spark.local.dir", own).config("spark.sql.warehouse.dir", f"{own}/warehouse").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def data():
    if not DATA.is_dir():
        pytest.skip("the test tables are not here")
    return str(DATA)
