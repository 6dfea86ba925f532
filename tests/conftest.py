import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    from macroseries.session import get_spark
    extra = {
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="ms-wh-"),
    }
    # robustness runs: a session configured unlike ours must give the same rows
    if os.environ.get("TEST_TZ"):
        extra["spark.sql.session.timeZone"] = os.environ["TEST_TZ"]
    if os.environ.get("TEST_ANSI"):
        extra["spark.sql.ansi.enabled"] = os.environ["TEST_ANSI"]
    s = get_spark("local[8]", shuffle_partitions=int(os.environ.get("TEST_SHUFFLE", "8")),
                  extra=extra)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
