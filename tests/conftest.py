from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feeloom.schemas import FEE_SCHEMA  # noqa: E402
from feeloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests")
    yield session
    session.stop()


def fee(client, adviser, date, amount, nino=None):
    date = dt.date.fromisoformat(date) if isinstance(date, str) else date
    return (client, nino or f"N{client}", adviser, date, amount)


@pytest.fixture(scope="session")
def ledger(spark):
    """ledger(fee(...), ...) -> raw DataFrame; None stands for a NULL client."""

    def build(*rows):
        return spark.createDataFrame(list(rows), "client_id string, client_nino string, adviser_id string, "
                                                 "fee_date date, fee_amount double")  # fmt: skip

    assert build().schema.fieldNames() == FEE_SCHEMA.fieldNames()
    return build


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
