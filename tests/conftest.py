import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from viaduct.session import build_session

    s = build_session("local[8]", app_name="viaduct-tests", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def warehouse(spark):
    from viaduct.plans.warehouse import warehouse_for

    return warehouse_for(spark, SF001)


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
