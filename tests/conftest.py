import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
os.environ["TZ"] = "UTC"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from forelight.session import session

    base = tmp_path_factory.mktemp("spark")
    s = session(
        "tests",
        4,
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.checkpoint.dir": f"file://{base}/shared", "spark.sql.warehouse.dir": f"{base}/warehouse", "spark.default.parallelism": "4"},
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"
