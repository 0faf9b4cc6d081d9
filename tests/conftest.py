from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwright.schemas import SALES_TRANSACTIONS_RAW  # noqa: E402
from tillwright.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__showConsoleProgress="false",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def raw_sales(spark):
    """Factory of raw sales rows: keyword values over a plain in-store sale."""

    def make(*rows):
        plain = {
            "transaction_id": "t", "transaction_date": "2022-05-01", "customer_id": 1, "customer_fname": "Ann",
            "cusomter_lname": "Lee", "cusomter_email": "ann@mail.com", "sales_agent_id": 7, "branch_id": 3,
            "product_id": 11, "product_name": "lamp", "product_category": "home", "units": 1, "unit_price": 10.0,
            "is_online": "no", "payment_method": "Cash",
        }
        names = SALES_TRANSACTIONS_RAW.names
        return spark.createDataFrame(
            [tuple((plain | row).get(name) for name in names) for row in rows], SALES_TRANSACTIONS_RAW
        )

    return make
