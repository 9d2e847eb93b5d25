from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from riskweave.settings import RiskSettings  # noqa: E402

SALTED = RiskSettings(token_salt="RISK_SALT_V3")
SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from riskweave.session import local_session

    s = local_session(4, shuffle_partitions=4, app="riskweave-tests")
    s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="riskweave-test-ckpt-"))
    yield s
    s.stop()


@pytest.fixture()
def tmp_root():
    return tempfile.mkdtemp(prefix="riskweave-test-")


TXN_COLUMNS = (
    "transaction_id string, account_number string, customer_id string, transaction_datetime timestamp, "
    "transaction_date date, transaction_type string, transaction_channel string, amount_usd double, "
    "currency_code string, originating_country string, merchant_category_code string, merchant_name string, "
    "is_international boolean, account_balance_usd double, branch_code string, source_system string, "
    "batch_file_name string"
)


def txn(tid, acct, day, amount=100.0, *, hour=12, channel="ONLINE", ttype="DEBIT", currency="USD",
        country="US", mcc="5411", intl=False, balance=1000.0, customer="C1"):
    """One transaction row in the batch schema (F1 order)."""
    d = dt.date.fromisoformat(day) if isinstance(day, str) else day
    ts = dt.datetime(d.year, d.month, d.day, hour, 0, 0)
    return (tid, acct, customer, ts, d, ttype, channel, amount, currency, country, mcc, "M", intl, balance,
            "BR1", "CBS", "f.parquet")
