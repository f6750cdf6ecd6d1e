import os

from conftest import raw_row
from starloom.streaming import read_fact, run_incremental


def test_incremental_loads_keep_keys(spark, make_raw, tmp_dir):
    src, root, ck = (os.path.join(tmp_dir, x) for x in ("src", "star", "ck"))
    b1 = make_raw([raw_row(1.0, customer="Bea Lim"), raw_row(2.0, customer="Al Bo"),
                   raw_row(None, customer="Zed Q")])
    b1.coalesce(1).write.option("header", True).csv(os.path.join(src, "b1"))
    run_incremental(spark, os.path.join(src, "*"), root, ck)
    cust1 = {r.customer_name: r.customer_id for r in spark.read.parquet(f"{root}/dim_cust").collect()}
    assert cust1 == {"Al Bo": 1, "Bea Lim": 2}
    assert read_fact(spark, root).count() == 2

    b2 = make_raw([raw_row(3.0, customer="Aaron A", product="Cup"), raw_row(4.0, customer="Bea Lim")])
    b2.coalesce(1).write.option("header", True).csv(os.path.join(src, "b2"))
    run_incremental(spark, os.path.join(src, "*"), root, ck)
    cust2 = {r.customer_name: r.customer_id for r in spark.read.parquet(f"{root}/dim_cust").collect()}
    assert cust2 == {"Al Bo": 1, "Bea Lim": 2, "Aaron A": 3}    # existing keys unchanged
    fact = read_fact(spark, root)
    assert fact.count() == 4
    assert {r.order_number: r.customer_id for r in fact.collect()} == {1: 2, 2: 1, 3: 3, 4: 2}
    prods = spark.read.parquet(f"{root}/dim_prod")
    assert prods.count() == 2 and prods.select("product_id").distinct().count() == 2
    # a third run with no new files changes nothing
    run_incremental(spark, os.path.join(src, "*"), root, ck)
    assert read_fact(spark, root).count() == 4
    assert spark.read.parquet(f"{root}/dim_cust").count() == 3


def test_replayed_batch_is_idempotent(spark, make_raw, tmp_dir):
    from starloom.streaming import process_batch
    root = os.path.join(tmp_dir, "star")
    batch = make_raw([raw_row(1.0, customer="Al Bo"), raw_row(2.0, customer="Cy Do")])
    process_batch(batch, 0, root)
    process_batch(batch, 0, root)          # the same epoch again, after a failure
    assert read_fact(spark, root).count() == 2
    assert spark.read.parquet(f"{root}/dim_cust").count() == 2
    assert spark.read.parquet(f"{root}/dim_ostatus").count() == 1


def test_one_run_many_micro_batches(spark, make_raw, tmp_dir):
    src, root, ck = (os.path.join(tmp_dir, x) for x in ("src", "star", "ck"))
    make_raw([raw_row(1.0, customer="Mo Ng"), raw_row(2.0, customer="Bo Ax")]).coalesce(1) \
        .write.parquet(os.path.join(src, "p1"))
    make_raw([raw_row(3.0, customer="Al Cy"), raw_row(4.0, customer="Mo Ng")]).coalesce(1) \
        .write.parquet(os.path.join(src, "p2"))
    run_incremental(spark, os.path.join(src, "*"), root, ck, source_format="parquet",
                    max_files_per_trigger=1)
    fact = read_fact(spark, root)
    batches = {r.batch_id for r in spark.read.parquet(f"{root}/fact_orders").select("batch_id").collect()}
    assert fact.count() == 4 and len(batches) == 2
    ids = sorted(r.customer_id for r in spark.read.parquet(f"{root}/dim_cust").collect())
    assert ids == [1, 2, 3]


def test_second_source_and_lost_checkpoint(spark, make_raw, tmp_dir):
    from starloom.streaming import read_dim_prod
    one, two, root = (os.path.join(tmp_dir, x) for x in ("one", "two", "star"))
    make_raw([raw_row(1.0, cost=10.0), raw_row(2.0, cost=10.0)]).coalesce(1).write.parquet(one)
    make_raw([raw_row(3.0, cost=12.0)]).coalesce(1).write.parquet(two)
    run_incremental(spark, one, root, os.path.join(tmp_dir, "ck1"), source_format="parquet")
    assert read_dim_prod(spark, root).first().standard_cost == 10.0
    # another source with its own checkpoint starts at epoch 0 again
    run_incremental(spark, two, root, os.path.join(tmp_dir, "ck2"), source_format="parquet")
    assert {r.order_number for r in read_fact(spark, root).collect()} == {1, 2, 3}
    assert read_dim_prod(spark, root).first().standard_cost == 0.0  # two costs: none is the standard
    # the first source's checkpoint is lost: its files are known, so nothing doubles
    run_incremental(spark, one, root, os.path.join(tmp_dir, "ck3"), source_format="parquet")
    assert sorted(r.order_number for r in read_fact(spark, root).collect()) == [1, 2, 3]


def test_stream_takes_csv_columns_by_name(spark, make_raw, tmp_dir):
    src, root = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "star")
    raw = make_raw([raw_row(1.0, cost=10.0, sales=20.0)])
    raw.select(*[f"`{c}`" for c in sorted(raw.columns)]).coalesce(1).write.option("header", True).csv(src)
    run_incremental(spark, src, root, os.path.join(tmp_dir, "ck"))
    row = read_fact(spark, root).first()
    assert (row.unit_cost, row.unit_sales) == (10.0, 20.0)
