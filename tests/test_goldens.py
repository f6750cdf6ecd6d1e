"""Small goldens, retyped as fixtures: names, key order, status labels."""

from conftest import raw_row
from starloom.plans.dims import build_dim_emp, build_dim_status
from starloom.plans.prep import preprocess
from starloom.plans.star import build_star, register_views

SUPERVISORS = ["Ajay Sharma", "Roshan Kumar", "Aarvi Gupta", "Vijay Singh", "Aadil Khan",
               "Advika Joshi"]


def _raw(make_raw):
    # supervisors appear in the order above; each appears several times
    rows = []
    for i in range(36):
        rows.append(raw_row(float(i + 1), supervisor=SUPERVISORS[(i // 2) % 6],
                            date=f"{1 + i // 6:02d}/01/2024"))
    return make_raw(rows)


def test_employee_keys_first_seen_and_sorted(make_raw):
    clean = preprocess(_raw(make_raw))
    first = build_dim_emp(clean, audit=False, key_order="first_seen",
                          seen_cols=["order_date", "order_number"])
    got = {r.employee_name: (r.employee_id, r.employee_first_name, r.employee_last_name)
           for r in first.collect()}
    assert got == {n: (i + 1, n.split()[0], n.split()[-1]) for i, n in enumerate(SUPERVISORS)}
    ranked = {r.employee_name: r.employee_id for r in build_dim_emp(clean, audit=False).collect()}
    assert ranked == {n: i + 1 for i, n in enumerate(sorted(SUPERVISORS))}


def test_status_golden(make_raw):
    raw = make_raw([raw_row(float(i), status=s) for i, s in enumerate(
        ["Delivered", "Order", "Processing", "Shipped"] * 3)])
    got = [(r.status_name, r.status_id, r.status_description)
           for r in build_dim_status(preprocess(raw), audit=False).orderBy("status_id").collect()]
    assert got == [("Delivered", 1, "Order has been delivered"),
                   ("Order", 2, "Order has been placed"),
                   ("Processing", 3, "Order is being processed"),
                   ("Shipped", 4, "Order has been shipped")]


def test_register_views_sql(spark, make_raw):
    star = build_star(_raw(make_raw), audit=False)
    register_views(star, prefix="g_")
    r = spark.sql("SELECT count(*) AS n, count(DISTINCT e.employee_id) AS k FROM g_fact_orders f "
                  "JOIN g_dim_emp e ON f.employee_id = e.employee_id").first()
    assert (r.n, r.k) == (36, 6)
