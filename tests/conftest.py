import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    s = (
        SparkSession.builder.master("local[4]")
        .appName("ledgerlake-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerlake-t-")


def payment(tid="T1", ts="2026-05-29 06:39:15", card="C1", merchant="M1", amount=100.0,
            currency="USD", mcc="5411", channel="POS", auth="APPROVED", location="New York, USA"):
    return (tid, ts, card, merchant, amount, currency, mcc, channel, auth, location)


@pytest.fixture
def payments_df(spark):
    from ledgerlake.config import PAYMENT_SCHEMA

    def make(rows):
        return spark.createDataFrame(rows, PAYMENT_SCHEMA)

    return make
