import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from lading.session import build_session, checkpoint_dir
    s = build_session("local[*]", 8, app_name="lading-tests")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("ckpt")))
    checkpoint_dir(s)
    yield s
    s.stop()


def whole_months(spark, materialize=None):
    """The small contract without its last month, which is one day: there two
    warehouses have no order, so their forecast accuracy is NULL and the check
    on it fails by its rule (tests/test_quality_gate.py)."""
    from lading.sources.contract import SourceContract

    class WholeMonths(SourceContract):
        def table(self, name):
            df = super().table(name)
            return df.where("o_orderdate < '2001-08-01'") if name == "orders" else df

    return WholeMonths(spark, SF_SMALL, materialize)
