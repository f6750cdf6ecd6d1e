import pytest

from conftest import raw_row
from starloom.plans.dims import (build_dim_cust, build_dim_date, build_dim_emp, build_dim_geo,
                                 build_dim_prod, build_dim_status)
from starloom.plans.prep import preprocess, preprocess_counts, require_columns


def test_preprocess_drops_missing_keys_and_parses(make_raw):
    raw = make_raw([raw_row(1.0), raw_row(None), raw_row(float("nan")),
                    raw_row(2.0, date="31/02/2024"), raw_row(3.0, date="5/3/2024")])
    clean = preprocess(raw)
    assert clean.columns[0] == "order_number" and "assigned supervisor" in clean.columns
    rows = {r.order_number: r.order_date for r in clean.collect()}
    assert set(rows) == {1.0, 2.0, 3.0}
    assert rows[2.0] is None and str(rows[3.0]) == "2024-03-05"
    c = preprocess_counts(raw).first()
    assert (c.raw_rows, c.clean_rows) == (5, 3)


def test_require_columns_lists_all_missing(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError, match="order_date"):
        require_columns(df, ["a", "order_date", "order_number"])
    with pytest.raises(ValueError, match="order_date"):
        build_dim_date(df)


def test_dim_cust_names_and_keys(make_raw):
    raw = make_raw([raw_row(1.0, customer="Vipin Kumar"), raw_row(2.0, customer="Bijendra"),
                    raw_row(3.0, customer="Ram Kumar Singh"), raw_row(4.0, customer=None),
                    raw_row(5.0, customer="Vipin Kumar")])
    d = build_dim_cust(preprocess(raw), audit=False)
    assert d.columns == ["customer_id", "customer_name", "first_name", "last_name"]
    got = {r.customer_name: (r.customer_id, r.first_name, r.last_name) for r in d.collect()}
    assert got == {"Bijendra": (1, "Bijendra", "Bijendra"),
                   "Ram Kumar Singh": (2, "Ram", "Singh"),
                   "Vipin Kumar": (3, "Vipin", "Kumar")}


def test_dim_emp_with_audit_and_first_seen(make_raw):
    raw = make_raw([raw_row(1.0, supervisor="Roshan Kumar", date="02/01/2024"),
                    raw_row(2.0, supervisor="Ajay Sharma", date="03/01/2024"),
                    raw_row(3.0, supervisor="Roshan Kumar", date="01/01/2024")])
    clean = preprocess(raw)
    d = build_dim_emp(clean)
    assert d.columns[-2:] == ["create_date", "update_date"]
    r = d.filter("employee_name = 'Ajay Sharma'").first()
    assert r.employee_id == 1 and r.create_date == r.update_date
    fs = build_dim_emp(clean, audit=False, key_order="first_seen", seen_cols=["order_date"])
    assert {r.employee_name: r.employee_id for r in fs.collect()} == {
        "Roshan Kumar": 1, "Ajay Sharma": 2}


def test_dim_status_descriptions(make_raw):
    raw = make_raw([raw_row(float(i), status=s) for i, s in enumerate(
        ["Delivered", "Order", "Processing", "Shipped", "Returned", None, "Order"])])
    d = build_dim_status(preprocess(raw), audit=False)
    got = {r.status_name: (r.status_id, r.status_description) for r in d.collect()}
    assert got == {"Delivered": (1, "Order has been delivered"),
                   "Order": (2, "Order has been placed"),
                   "Processing": (3, "Order is being processed"),
                   "Returned": (4, "Unknown status"),
                   "Shipped": (5, "Order has been shipped")}
    d2 = build_dim_status(preprocess(raw), audit=False, default=None)
    assert d2.filter("status_name = 'Returned'").first().status_description is None


def test_dim_prod_single_valued_cost(make_raw):
    raw = make_raw([
        raw_row(1.0, product="Pen", brand="Acme", cost=10.0),
        raw_row(2.0, product="Pen", brand="Acme", cost=10.0),
        raw_row(3.0, product="Pen", brand="Zeta", cost=11.0),   # same name, second brand
        raw_row(4.0, product="Pen", brand="Zeta", cost=12.0),   # two prices -> 0
        raw_row(5.0, product="Cup", brand="Acme", cost=None),
        raw_row(6.0, product="Cup", brand="Acme", cost=7.0),    # {null, 7} -> 7
        raw_row(7.0, product="Mug", brand="Acme", cost=None),   # all null -> 0
        raw_row(8.0, product="Ink", brand=None, cost=1.0),      # null brand: no member
    ])
    d = build_dim_prod(preprocess(raw), audit=False)
    got = {(r.product_name, r.brand): (r.product_id, r.standard_cost) for r in d.collect()}
    assert got == {("Cup", "Acme"): (1, 7.0), ("Mug", "Acme"): (2, 0.0),
                   ("Pen", "Acme"): (3, 10.0), ("Pen", "Zeta"): (4, 0.0)}


def test_dim_date_excludes_null(make_raw):
    raw = make_raw([raw_row(1.0, date="01/01/2024"), raw_row(2.0, date=None),
                    raw_row(3.0, date="01/01/2024"), raw_row(4.0, date="06/01/2024")])
    d = build_dim_date(preprocess(raw))
    assert d.count() == 2
    sat = d.filter("date_full = DATE'2024-01-06'").first()
    assert (sat.day_name, sat.is_weekend, sat.day_of_week) == ("Saturday", True, 6)


def test_dim_geo_seed(spark):
    g = build_dim_geo(spark)
    rows = g.collect()
    assert len(rows) == 107
    by_country = {}
    for r in rows:
        by_country[r.country] = by_country.get(r.country, 0) + 1
    assert by_country == {"India": 38, "United States": 56, "Canada": 13}
    assert len({r.iso_code for r in rows}) == 107 and len({r.state_id for r in rows}) == 107
    pe = [r for r in rows if r.iso_code == "CA-PE"][0]
    assert pe.capital_city == "Charlottetown"
    tg = [r for r in rows if r.state_code == "TG"][0]
    assert tg.iso_code == "IN-TS"
    assert g.columns == ["state_id", "state_code", "country", "state_name", "capital_city",
                         "status", "iso_code"]
    # stable: same ids on a second build
    assert {r.iso_code: r.state_id for r in build_dim_geo(spark).collect()} == \
        {r.iso_code: r.state_id for r in rows}


def test_preprocess_text_typed_source(spark):
    import datetime as dt
    df = spark.createDataFrame(
        [("12.0", "AP", "A B", "05/03/2024", "Order", "Pen", "Office", "Acme", "1.5", "2", "3.0",
          "4.5", "6", "S T"),
         ("x", "AP", "A B", "05/03/2024", "Order", "Pen", "Office", "Acme", "1", "2", "3", "4",
          "5", "S T")],
        ", ".join(f"`{c}` string" for c in [
            "Order_Number", "State_Code", "Customer_Name", "Order_Date", "Status", "Product",
            "Category", "Brand", "Cost", "Sales", "Quantity", "Total_Cost", "Total_Sales",
            "Assigned Supervisor"]))
    rows = preprocess(df).collect()
    assert len(rows) == 1 and rows[0].order_number == 12.0 and rows[0].cost == 1.5
    assert rows[0].order_date == dt.date(2024, 3, 5)
    typed = spark.createDataFrame([(1.0, dt.date(2024, 1, 2))], "Order_Number double, Order_Date date")
    assert preprocess(typed).first().order_date == dt.date(2024, 1, 2)
