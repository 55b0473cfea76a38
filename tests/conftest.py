import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tablegauge.session import get_session
    s = get_session("local[*]", shuffle_partitions=8,
                    extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="tg-test-ckpt-")})
    yield s
    s.stop()


@pytest.fixture
def x3(spark):
    """Four machines: a preparation table (FIXTURES X3)."""
    rows = [(120, 7, "north", "Acme", "No", 11, 1, "A", 230), (75, 3, "south", "Bolt", "Yes", 12, 1, "A", 230),
            (300, 12, "east", "Crane", "No", 13, 1, "A", 230), (90, 5, "north", "Acme", "No", 14, 1, "A", 230)]
    return spark.createDataFrame(rows, "hours long, load long, site string, maker string, failed string, unit long, "
                                       "plant long, grade string, volt long")


@pytest.fixture
def x4(spark):
    """Ten predictions (FIXTURES X4): TP 3, FN 2, FP 1, TN 4; AUC 22/25."""
    rows = [("Yes", "Yes", .9), ("No", "No", .2), ("No", "Yes", .6), ("Yes", "Yes", .7), ("Yes", "No", .3),
            ("No", "No", .1), ("No", "No", .35), ("Yes", "Yes", .8), ("No", "No", .05), ("Yes", "No", .45)]
    return spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i long, y_true string, y_pred string, p_pos double")
