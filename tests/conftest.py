import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from starloom.session import get_session  # noqa: E402

RAW_COLS = ["Order_Number", "State_Code", "Customer_Name", "Order_Date", "Status", "Product",
            "Category", "Brand", "Cost", "Sales", "Quantity", "Total_Cost", "Total_Sales",
            "Assigned Supervisor"]


@pytest.fixture(scope="session")
def spark():
    warehouse = tempfile.mkdtemp(prefix="starloom-wh-")
    s = get_session("local[4]", app="starloom-tests", shuffle_partitions=4,
                    extra_conf={"spark.sql.warehouse.dir": warehouse})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="starloom-test-")


def raw_row(order_number=1.0, state="AP", customer="Asha Rao", date="05/03/2024",
            status="Delivered", product="Pen", category="Office", brand="Acme", cost=10.0,
            sales=12.0, quantity=2.0, total_cost=20.0, total_sales=24.0, supervisor="Ajay Sharma"):
    return (order_number, state, customer, date, status, product, category, brand, cost, sales,
            quantity, total_cost, total_sales, supervisor)


@pytest.fixture
def make_raw(spark):
    from starloom.sources.raw import RAW_SCHEMA

    def _make(rows):
        return spark.createDataFrame(rows, RAW_SCHEMA)
    return _make
