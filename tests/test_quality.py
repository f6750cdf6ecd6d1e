from starloom.plans import quality as Q


def _tables(spark):
    fact = spark.createDataFrame(
        [(1, "2024-01-01", 1, "s1", 1, 1, 1, 1.0, 1.0, 1, 1.0, 1.0, 0.0, 0.5),
         (1, "2024-01-02", 9, "-1", -1, 1, 1, None, 1.0, 0, 1.0, 1.0, 0.0, 1.5),
         (2, None, 1, "s1", 1, 1, 1, float("nan"), 1.0, None, 1.0, 1.0, 0.0, -2.0)],
        "order_number int, order_date string, customer_id int, state_id string, product_id int, "
        "status_id int, employee_id int, unit_cost double, unit_sales double, quantity int, "
        "total_cost double, total_sales double, profit double, profit_margin double",
    ).withColumn("order_date", __import__("pyspark.sql.functions", fromlist=["F"]).to_date("order_date"))
    dims = {
        "dim_date": spark.sql("SELECT DATE'2024-01-01' AS date_full, 1 AS day_of_week, 'Monday' AS "
                              "day_name, 1 AS day_of_month, 1 AS day_of_year, 1 AS week_of_year, "
                              "13 AS month_num, 'January' AS month_name, 1 AS quarter, 2024 AS year, "
                              "false AS is_weekend"),
        "dim_cust": spark.createDataFrame([(1, "Åsa Ström", "Åsa", "Ström")],
                                          "customer_id int, customer_name string, first_name string, "
                                          "last_name string"),
        "dim_geo": spark.createDataFrame([("s1", "AP", "India", "A", None, "State", "IN-AP")],
                                         "state_id string, state_code string, country string, "
                                         "state_name string, capital_city string, status string, "
                                         "iso_code string"),
        "dim_prod": spark.createDataFrame([(1, "x" * 31, "c", "b", 1.0)],
                                          "product_id int, product_name string, category string, "
                                          "brand string, standard_cost double"),
        "dim_ostatus": spark.createDataFrame([(1, "Order", "d")], "status_id int, status_name "
                                             "string, status_description string"),
        "dim_emp": spark.createDataFrame([(1, "A B", "A", "B")], "employee_id int, employee_name "
                                         "string, employee_first_name string, employee_last_name "
                                         "string"),
    }
    return {**dims, "fact_orders": fact}


def _as_map(df):
    return {(r.table_name, r.rule, r.column_name): r.violations for r in df.collect()}


def test_completeness_counts_nan_as_missing(spark):
    t = _tables(spark)
    rep = Q.completeness(t, [("unit_cost", "fact_orders"), ("quantity", "fact_orders"),
                             ("order_date", "fact_orders")])
    got = {r.column_name: (r.total_records, r.null_count, r.null_percentage, r.null_share)
           for r in rep.collect()}
    assert got["unit_cost"] == (1, 2, 200.0, 66.67)   # denominator is the non-null count
    assert got["quantity"] == (2, 1, 50.0, 33.33)
    assert rep.columns == ["column_name", "table_name", "total_records", "null_count",
                           "null_percentage", "null_share"]


def test_checks(spark):
    t = _tables(spark)
    nn = _as_map(Q.check_not_null(t))
    assert nn[("fact_orders", "not_null", "order_date")] == 1
    assert nn[("fact_orders", "not_null", "unit_cost")] == 1     # NULL, not NaN
    pk = _as_map(Q.check_primary_key(t))
    assert pk[("fact_orders", "primary_key", "order_number")] == 1
    assert pk[("dim_cust", "primary_key", "customer_id")] == 0
    fk = _as_map(Q.check_foreign_keys(t))
    assert fk[("fact_orders", "foreign_key", "customer_id")] == 1         # 9 is an orphan
    assert fk[("fact_orders", "foreign_key_unassigned", "state_id")] == 1
    assert fk[("fact_orders", "foreign_key_unassigned", "product_id")] == 1
    assert fk[("fact_orders", "foreign_key", "order_date")] == 1          # 2024-01-02
    assert fk[("fact_orders", "foreign_key", "status_id")] == 0
    assert len(fk) == 12
    rg = {(r.table_name, r.rule): r.violations for r in Q.check_ranges(t).collect()}
    assert rg[("fact_orders", "check_quantity_positive")] == 1    # NULL passes
    assert rg[("fact_orders", "check_profit_margin")] == 2
    assert rg[("dim_date", "check_month_num")] == 1
    ln = _as_map(Q.check_lengths(t))
    assert ln[("dim_prod", "max_length", "product_name")] == 1
    assert ln[("dim_cust", "max_length", "customer_name")] == 0   # 12 bytes <= 100
    ku = {r.table_name: (r.row_count, r.distinct_keys) for r in Q.key_uniqueness(t).collect()}
    assert ku["fact_orders"] == (3, 2)
    assert Q.check_all(t).count() == len(nn) + len(pk) + len(fk) + len(rg) + len(ln)
