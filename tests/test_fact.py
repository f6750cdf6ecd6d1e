import datetime as dt

from conftest import raw_row
from starloom import contracts as C
from starloom.plans.star import build_star


def _star(make_raw, rows, **kw):
    return build_star(make_raw(rows), audit=False, **kw)


def test_fact_grain_keys_and_sentinels(make_raw):
    rows = [
        raw_row(1.0, state="TN", product="Pen", brand="Acme"),
        raw_row(2.0, state="GA", product="Pen", brand="Zeta"),        # name under two brands
        raw_row(3.0, state="TX", customer=None, status=None, supervisor=None),
        raw_row(4.0, state=None, date="31/02/2024", total_sales=0.0),
        raw_row(5.0, total_sales=None, cost=None),
        raw_row(6.0, total_sales=-5.0, total_cost=float("nan")),
        raw_row(None),                                                 # dropped
    ]
    star = _star(make_raw, rows)
    fact = star["fact_orders"]
    assert fact.columns == C.FACT_ORDERS.names
    assert fact.schema == C.conform(fact, C.FACT_ORDERS).schema
    got = {r.order_number: r for r in fact.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]          # grain kept: one row per clean row
    geo = {r.state_code: r.state_id for r in star["dim_geo"].filter("country='India'").collect()}
    assert got[1].state_id == geo["TN"] and got[2].state_id == geo["GA"]   # India's TN/GA
    assert got[3].state_id == "-1" and got[4].state_id == "-1"
    assert (got[3].customer_id, got[3].status_id, got[3].employee_id) == (-1, -1, -1)
    prod = {(r.product_name, r.brand): r.product_id for r in star["dim_prod"].collect()}
    assert got[1].product_id == prod[("Pen", "Acme")] and got[2].product_id == prod[("Pen", "Zeta")]
    assert got[4].order_date is None and got[1].order_date == dt.date(2024, 3, 5)
    assert (got[4].profit, got[4].profit_margin) == (-20.0, 0.0)
    assert (got[5].total_sales, got[5].unit_cost, got[5].profit, got[5].profit_margin) == (0.0, 0.0, 0.0, 0.0)
    assert (got[6].total_cost, got[6].profit, got[6].profit_margin) == (0.0, 0.0, 0.0)
    assert got[1].profit == 4.0 and abs(got[1].profit_margin - 4.0 / 24.0) < 1e-12
    assert got[1].quantity == 2 and isinstance(got[1].quantity, int)


def test_product_match_options(make_raw):
    rows = [raw_row(1.0, product="Pen", brand="Acme"), raw_row(2.0, product="Pen", brand="Zeta"),
            raw_row(3.0, product="Cup", brand="Acme")]
    by_name = _star(make_raw, rows, product_match="name", allow_fan_out=True)["fact_orders"]
    assert by_name.count() == 5        # each Pen row matches both Pen products
    lw = _star(make_raw, rows, product_match="last_wins")
    pid = {r.order_number: r.product_id for r in lw["fact_orders"].collect()}
    zeta = lw["dim_prod"].filter("brand = 'Zeta'").first().product_id
    assert pid[1] == pid[2] == zeta


def test_margin_unguarded_without_fill(make_raw):
    rows = [raw_row(1.0, total_sales=0.0), raw_row(2.0, total_sales=40.0, total_cost=30.0)]
    fact = _star(make_raw, rows, margin="unguarded")["fact_orders"]
    got = {r.order_number: r.profit_margin for r in fact.collect()}
    assert got == {1: 0.0, 2: 0.25}    # NULL from the zero division is filled with 0


def test_broadcast_plan_for_small_dims(make_raw):
    fact = _star(make_raw, [raw_row(1.0)])["fact_orders"]
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_sort_merge_and_salted_paths_match_broadcast(spark, make_raw):
    rows = [raw_row(float(i), customer=None if i % 5 == 0 else ("Hot Key" if i % 3 else f"C {i}"),
                    product=f"P{i % 7}", status="Order" if i % 2 else "Shipped")
            for i in range(1, 120)]
    ref = sorted(tuple(r) for r in _star(make_raw, rows)["fact_orders"].collect())
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        for kw in ({}, {"salt_buckets": 4}):
            fact = _star(make_raw, rows, broadcast_max_rows=0, **kw)["fact_orders"]
            plan = fact._jdf.queryExecution().executedPlan().toString()
            got = sorted(tuple(r) for r in fact.collect())
            final = fact._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan + final
            assert got == ref
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_shared_member_pass_equals_per_dimension(make_raw):
    rows = [raw_row(float(i), customer=None if i % 9 == 0 else f"C {i % 11}",
                    supervisor=f"S {i % 4}", status=["Order", "Shipped", None, "Returned"][i % 4],
                    product=f"P{i % 5}", brand=None if i % 13 == 0 else "B",
                    cost=None if i % 7 == 0 else float(i % 3),
                    date=None if i % 10 == 0 else f"{1 + i % 28:02d}/0{1 + i % 9}/2024")
            for i in range(1, 150)]
    for order in ("sorted", "first_seen"):
        a = _star(make_raw, rows, member_pass="shared", person_key_order=order)
        b = _star(make_raw, rows, member_pass="per_dimension", person_key_order=order)
        for name in a:
            ra = sorted((tuple(r) for r in a[name].collect()), key=repr)
            rb = sorted((tuple(r) for r in b[name].collect()), key=repr)
            assert ra == rb, (order, name)


def test_sentinel_and_strict_options(make_raw):
    import pytest
    rows = [raw_row(1.0, customer=None), raw_row(2.0, date="31/02/2024")]
    fact = _star(make_raw, rows, sentinel=0)["fact_orders"]
    got = {r.order_number: (r.customer_id, r.state_id) for r in fact.collect()}
    assert got[1][0] == 0
    with pytest.raises(Exception):
        _star(make_raw, rows, strict_dates=True)["fact_orders"].collect()


def test_random_geo_keys_are_fixed_once_built(make_raw):
    star = _star(make_raw, [raw_row(1.0, state="AP")], geo_key="random")
    geo = {r.state_code: r.state_id for r in star["dim_geo"].filter("country = 'India'").collect()}
    again = {r.state_code: r.state_id for r in star["dim_geo"].filter("country = 'India'").collect()}
    assert geo == again
    assert star["fact_orders"].first().state_id == geo["AP"]


def test_moved_rows_leave_their_natural_keys_behind(make_raw):
    rows = [raw_row(float(i), product=f"P{i % 7}", customer=None if i % 5 == 0 else f"C{i % 11}") for i in range(60)]
    small, moved = _star(make_raw, rows)["fact_orders"], _star(make_raw, rows, broadcast_max_rows=0)["fact_orders"]
    outputs, plans = [], [moved._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        kids = plan.children()
        plans += [kids.apply(i) for i in range(kids.size())]
        if plan.nodeName() == "Join":
            out = plan.output()
            outputs.append({out.apply(i).name() for i in range(out.size())})
    assert len(outputs) == 5 and sum("category" in names for names in outputs) == 1  # of its own lookup alone
    assert sorted(map(str, moved.collect())) == sorted(map(str, small.collect()))
    together = _star(make_raw, rows, broadcast_max_rows=0, lookups="together")["fact_orders"]
    assert sorted(map(str, together.collect())) == sorted(map(str, small.collect()))


def test_a_dimension_is_as_large_as_what_is_looked_up_in_it(make_raw, monkeypatch):
    from starloom.operators import lookup
    from starloom.plans import fact
    sizes, bounded = {}, lookup.bounded_broadcast

    def recorded(dim, max_rows=None, known_size=None, *more):
        sizes[dim.columns[0]] = known_size
        return bounded(dim, max_rows, known_size, *more)

    monkeypatch.setattr(fact, "bounded_broadcast", recorded)
    star = build_star(make_raw([raw_row(float(i), customer=f"Customer {i}") for i in range(20)]))
    used = lookup.size_of(star["dim_cust"].select("customer_name", "customer_id"))
    assert sizes["customer_id"] == used and used[1] < lookup.size_of(star["dim_cust"])[1]


def test_numbered_rows_are_looked_up_apart_with_the_same_result(make_raw):
    from pyspark.sql import functions as F
    rows = [raw_row(float(i % 50), product=f"P{i % 7}", brand=f"B{i % 3}", customer=None if i % 5 == 0 else f"C{i % 11}",
                    state=["AP", "TX", None][i % 3], status=None if i % 13 == 0 else "Order") for i in range(80)]
    numbered = make_raw(rows).withColumn("_row", F.monotonically_increasing_id())
    for kw in ({}, {"salt_buckets": 4}, {"salt_buckets": 4, "hot_share": 0.2}, {"product_match": "last_wins"},
               {"product_match": "name", "allow_fan_out": True}, {"lookups": "together"},
               {"lookups": "together", "product_match": "name", "allow_fan_out": True}):
        small = build_star(make_raw(rows), **kw)["fact_orders"]
        apart = build_star(numbered, row_id="_row", broadcast_max_rows=0, **kw)["fact_orders"]
        assert apart.dtypes == small.dtypes
        assert sorted(map(str, apart.collect())) == sorted(map(str, small.collect())), kw


def test_a_repeated_member_multiplies_numbered_rows_as_others(make_raw):
    from pyspark.sql import functions as F

    from starloom.plans.fact import build_fact_orders
    from starloom.plans.prep import preprocess
    clean = preprocess(make_raw([raw_row(float(i), customer=f"C{i % 4}") for i in range(12)]))
    dims = {n: t for n, t in build_star(make_raw([raw_row(1.0, customer=f"C{i}") for i in range(3)])).items() if n != "fact_orders"}
    dims["dim_cust"] = dims["dim_cust"].unionByName(dims["dim_cust"].where("customer_name = 'C1'"))
    numbered = clean.withColumn("_row", F.monotonically_increasing_id())
    whole = build_fact_orders(clean, dims, broadcast_max_rows=0)
    apart = build_fact_orders(numbered, dims, broadcast_max_rows=0, row_id="_row")
    assert whole.count() == 15 and sorted(map(str, apart.collect())) == sorted(map(str, whole.collect()))
