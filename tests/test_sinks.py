import os

import pytest

from conftest import raw_row
from starloom import contracts as C
from starloom.plans.star import build_star
from starloom.sinks import create_star_tables, create_table_ddl, save, write_star
from starloom.sources.raw import read_raw_csv


def _star(make_raw):
    rows = [raw_row(float(i), customer=f"Cust {i % 3}", product=f"P{i % 4}") for i in range(1, 30)]
    return build_star(make_raw(rows))


def test_write_star_parquet_csv_round_trip(spark, make_raw, tmp_dir):
    star = _star(make_raw)
    written = write_star(star, tmp_dir, "both")
    assert set(written) == set(C.STAR)
    for name, df in star.items():
        back = spark.read.parquet(f"{tmp_dir}/parquet/{name}")
        assert back.count() == df.count()
        assert back.columns == df.columns
        csv = spark.read.option("header", True).csv(f"{tmp_dir}/csv/{name}")
        assert csv.columns == df.columns and csv.count() == df.count()
    fact = spark.read.parquet(f"{tmp_dir}/parquet/fact_orders")
    assert fact.schema == C.FACT_ORDERS.schema or [f.dataType for f in fact.schema] == \
        [f.dataType for f in C.FACT_ORDERS.schema]


def test_save_requires_equal_lengths(spark, tmp_dir):
    with pytest.raises(ValueError, match="must match"):
        save([spark.range(1)], ["a", "b"], tmp_dir)


def test_raw_csv_source(spark, make_raw, tmp_dir):
    raw = make_raw([raw_row(1.0), raw_row(None, customer="X Y")])
    path = os.path.join(tmp_dir, "raw")
    raw.write.option("header", True).csv(path)
    back = read_raw_csv(spark, path)
    assert back.columns == raw.columns and back.count() == 2
    assert back.filter("Order_Number IS NULL").count() == 1


def test_ddl_and_managed_tables(spark, make_raw):
    ddl = create_table_ddl(C.FACT_ORDERS, bucketed=True)
    assert "CLUSTERED" not in create_table_ddl(C.FACT_ORDERS)  # one default for DDL and writes
    assert "order_number INT NOT NULL" in ddl and "state_id VARCHAR(40) NOT NULL" in ddl
    assert "CLUSTERED BY (product_id) SORTED BY (order_date, product_id) INTO 16 BUCKETS" in ddl
    assert "create_date TIMESTAMP NOT NULL DEFAULT CURRENT_TIMESTAMP" in create_table_ddl(C.DIM_CUST)
    spark.sql("CREATE DATABASE IF NOT EXISTS sl_ddl")
    stmts = create_star_tables(spark, database="sl_ddl")
    assert stmts[-1].startswith("CREATE TABLE IF NOT EXISTS sl_ddl.fact_orders")
    assert {r.tableName for r in spark.sql("SHOW TABLES IN sl_ddl").collect()
            if not r.isTemporary} == set(C.STAR)
    spark.sql("CREATE DATABASE IF NOT EXISTS sl_star")
    star = _star(make_raw)
    write_star(star, "", "table", database="sl_star", buckets=4, bucketed=True)
    desc = {r.col_name: r.data_type for r in
            spark.sql("DESCRIBE TABLE EXTENDED sl_star.fact_orders").collect()}
    assert desc.get("Num Buckets") == "4"
    assert spark.table("sl_star.fact_orders").count() == star["fact_orders"].count()
    spark.sql("CREATE DATABASE IF NOT EXISTS sl_plain")
    write_star(star, "", "table", database="sl_plain")
    plain = {r.col_name: r.data_type for r in
             spark.sql("DESCRIBE TABLE EXTENDED sl_plain.fact_orders").collect()}
    assert "Num Buckets" not in plain


def test_job_run_end_to_end(spark, make_raw, tmp_dir):
    from starloom.plans.job import run
    rows = [raw_row(float(i), customer=f"Cust {i % 5}", status="Order" if i % 2 else "Returned")
            for i in range(1, 40)] + [raw_row(None)]
    src = os.path.join(tmp_dir, "extract")
    make_raw(rows).coalesce(2).write.option("header", True).csv(src)
    out = os.path.join(tmp_dir, "out")
    result = run(spark, src, out)
    assert result["raw_rows"] == 40 and result["fact_rows"] == 39
    assert spark.read.parquet(f"{out}/fact_orders").count() == 39
    checks = spark.read.option("header", True).csv(f"{out}/_reports/checks")
    pk = checks.filter("table_name = 'dim_cust' AND rule = 'primary_key'").first()
    assert pk.violations == "0"
    comp = spark.read.option("header", True).csv(f"{out}/_reports/completeness")
    assert comp.count() == 30


def test_cli(spark, make_raw, tmp_dir):
    from starloom.__main__ import main
    src = os.path.join(tmp_dir, "extract")
    make_raw([raw_row(float(i)) for i in range(1, 6)]).write.option("header", True).csv(src)
    result = main(["--source", src, "--target", os.path.join(tmp_dir, "o"), "--no-reports",
                   "--target-format", "csv", "--week-start", "sunday", "--fact-by-year"])
    assert result["fact_rows"] == 5
    dd = spark.read.option("header", True).csv(os.path.join(tmp_dir, "o", "dim_date")).first()
    assert dd.day_of_week == "3"      # 2024-03-05 is a Tuesday; Sunday = 1
    assert os.path.isdir(os.path.join(tmp_dir, "o", "fact_orders", "order_year=2024"))


def test_catalog_table_source(spark, make_raw, tmp_dir):
    from starloom.plans.dims import build_dim_geo
    from starloom.plans.job import run
    from starloom.sources.raw import read_raw_table
    spark.sql("CREATE DATABASE IF NOT EXISTS sl_raw")
    make_raw([raw_row(float(i)) for i in range(1, 4)]).write.mode("overwrite") \
        .saveAsTable("sl_raw.online_orders")
    assert read_raw_table(spark, "sl_raw", "online_orders").count() == 3
    result = run(spark, "sl_raw.online_orders", os.path.join(tmp_dir, "o"),
                 source_format="table", reports=False)
    assert result["raw_rows"] == 3 and result["fact_rows"] == 3
    ids = [r.state_id for r in build_dim_geo(spark, key="random").collect()]
    assert len(set(ids)) == 107 and all(len(i) == 36 for i in ids)


def test_fact_partitioned_by_year_prunes(spark, make_raw, tmp_dir):
    rows = [raw_row(float(i), date=f"01/0{1 + i % 3}/20{21 + i % 3}") for i in range(1, 31)]
    star = build_star(make_raw(rows))
    write_star(star, tmp_dir, "parquet", fact_by_year=True)
    years = sorted(d for d in os.listdir(f"{tmp_dir}/fact_orders") if d.startswith("order_year="))
    assert years == ["order_year=2021", "order_year=2022", "order_year=2023"]
    back = spark.read.parquet(f"{tmp_dir}/fact_orders").filter("order_year = 2022")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_year" in plan and back.count() == 10


def _star_of(raw):
    from starloom.plans.star import build_star
    return build_star(raw)


def test_declared_tables_are_loaded_by_insert(spark, make_raw):
    spark.sql("CREATE DATABASE IF NOT EXISTS sl_load")
    create_star_tables(spark, database="sl_load")
    star = _star(make_raw)
    for _ in range(2):  # overwriting twice loads once
        write_star(star, "", "table", database="sl_load")
    kinds = {r.col_name: r.data_type for r in spark.sql("DESCRIBE TABLE sl_load.fact_orders").collect()}
    assert kinds["state_id"] == "varchar(40)"
    assert spark.table("sl_load.fact_orders").count() == star["fact_orders"].count()
    spark.sql("INSERT INTO sl_load.dim_cust (customer_id, customer_name) VALUES (-1, 'none')")
    assert spark.table("sl_load.dim_cust").where("customer_id = -1").first().create_date is not None
    write_star(star, "", "table", database="sl_load", mode="append")
    assert spark.table("sl_load.fact_orders").count() == 2 * star["fact_orders"].count()


def test_csv_columns_by_name_and_rejects(spark, make_raw, tmp_dir):
    import pytest
    from conftest import raw_row

    from starloom.plans.job import run
    path = os.path.join(tmp_dir, "by_name")
    raw = make_raw([raw_row(1.0, cost=10.0, sales=20.0)])
    raw.select(*[f"`{c}`" for c in sorted(raw.columns)]).write.option("header", True).csv(path)
    row = read_raw_csv(spark, path).first()
    assert (row.Cost, row.Sales) == (10.0, 20.0)
    raw.drop("Cost").write.option("header", True).csv(os.path.join(tmp_dir, "short"))
    with pytest.raises(ValueError, match="Cost"):
        read_raw_csv(spark, os.path.join(tmp_dir, "short"))
    bad = os.path.join(tmp_dir, "bad.csv")
    names = ",".join(f'"{c}"' for c in raw.columns)
    line = "{},AP,{},05/03/2024,Order,Pen,Office,Acme,1,2,3,4,5,Ann Lee"
    with open(bad, "w") as f:
        f.write("\n".join([names, line.format("1.0", "Al Bo"), line.format("12x", "Cy Do"),
                           line.format("3.0", '"Two\nLines"')]) + "\n")
    kept = read_raw_csv(spark, bad, multi_line=True, keep_rejects=True).collect()
    assert len(kept) == 3 and [r.Order_Number for r in kept] == [1.0, None, 3.0]
    assert [r._corrupt_record is not None for r in kept] == [False, True, False]
    assert kept[2].Customer_Name == "Two\nLines"
    split = read_raw_csv(spark, bad, keep_rejects=True).collect()  # the split record shows as rejects
    assert sum(r._corrupt_record is not None for r in split) == 3
    result = run(spark, bad, os.path.join(tmp_dir, "out"), multi_line=True, reports=False)
    assert (result["raw_rows"], result["rejected_rows"], result["fact_rows"]) == (3, 1, 2)
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        read_raw_csv(spark, bad, multi_line=True, mode="FAILFAST").collect()


def test_year_partitioned_files_are_sorted_on_date(spark, make_raw, tmp_dir):
    from conftest import raw_row
    rows = [raw_row(float(i), date=f"{1 + i * 7 % 28:02d}/{1 + i % 12:02d}/{2023 + i % 2}") for i in range(60)]
    star = _star_of(make_raw(rows))
    write_star(star, os.path.join(tmp_dir, "y"), "parquet", fact_by_year=True)
    import glob

    import pyarrow.parquet as pq
    files = glob.glob(os.path.join(tmp_dir, "y", "fact_orders", "order_year=*", "*.parquet"))
    assert files
    for f in files:
        dates = pq.ParquetFile(f).read(columns=["order_date"])["order_date"].to_pylist()
        assert dates == sorted(dates)
