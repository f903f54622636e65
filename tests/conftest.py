import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from granary import session  # noqa: E402

TESTDATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    spark = session.create(
        "granary tests",
        "local[8]",
        4,
        {
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(shared),
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.driver.memory": "8g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def folder():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("no test tables here")
    return str(path)


@pytest.fixture(scope="session")
def bed(spark, folder):
    from granary.sources.testbed import Testbed

    return Testbed(spark, folder)
