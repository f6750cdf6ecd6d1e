import datetime
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


# the queries of the optional subpackage have their own tests
CORE = sorted(set(E.queries()) - set(E._llm.QUERIES if E._llm else ()))


def test_registry_pairs():
    assert set(CORE) <= set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == [c.name for c in E.C.FACT_ORDERS.columns]
    assert df.count() > 0


def test_no_python_udf_and_pruned_scans(spark):
    df = E.queries()["fact_orders_dirty"](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan
    raw_plan = E.queries()["raw_orders"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    # only the needed lineitem columns are read
    assert "l_shipdate" not in raw_plan and "l_tax" not in raw_plan


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _bag(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    norm = []
    for r in rows:
        norm.append(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order))
    return sorted(norm, key=repr)


@pytest.mark.skipif(not os.path.exists(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", CORE)
def test_query_matches_oracle(spark, duck, name):
    sdf = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in sdf.collect()]
    plan = sdf._jdf.queryExecution().executedPlan().toString()
    assert not any(p in plan for p in ("PythonUDF", "BatchEvalPython", "ArrowEvalPython",
                                       "MapInPandas", "FlatMapGroupsInPandas")), name
    res = duck.execute(E.oracle_sql()[name])
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    assert sorted(sdf.columns) == sorted(d_cols)
    assert len(s_rows) == len(d_rows)
    assert _bag(sdf.columns, s_rows) == _bag(d_cols, d_rows)


@pytest.mark.parametrize("name", ["fact_orders_shuffled", "fact_orders_salted", "fact_orders_hot_salted"])
def test_large_dimension_queries_run_sort_merge_joins(spark, name):
    df = E.queries()[name](spark, SF)
    plan = df._jdf.queryExecution()
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    assert plan.executedPlan().toString().count("SortMergeJoin") >= 5, name


def test_key_numbering_is_spread_over_tasks(spark):
    """The numbering job itself, before its result is checkpointed."""
    from pyspark.sql import functions as F

    from starloom.operators.dense_keys import number_rows
    keyed = number_rows(spark.range(4000).select((F.col("id") * 7 % 4000).alias("id")), ["id"], "k", 4)
    sizes = [r["count"] for r in keyed.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 2000
    assert keyed.where("k != id + 1").count() == 0 and dict(keyed.dtypes)["k"] == "bigint"


@pytest.fixture(scope="module")
def small_tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows = {
        "lineitem": ([(k, k % 3, k % 2, n, 2.0, 10.0 + k, 0.1, "OF"[k % 2]) for k in range(1, 9) for n in (1, 2)],
                     "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                     "l_extendedprice double, l_discount double, l_linestatus string"),
        "orders": ([(k, k % 4, "OPF"[k % 3], datetime.datetime(2024, 3, k)) for k in range(1, 9)],
                   "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderdate timestamp_ntz"),
        "customer": ([(k, f"Customer#{k}", k) for k in range(4)], "c_custkey bigint, c_name string, c_nationkey int"),
        "part": ([(k, f"part {k}", "KIND", f"Brand#{k}", 5.0 + k) for k in range(3)],
                 "p_partkey bigint, p_name string, p_type string, p_brand string, p_retailprice double"),
        "supplier": ([(k, f"Supplier#{k}") for k in range(2)], "s_suppkey bigint, s_name string"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{d}/{name}.parquet")
    return d


def test_united_formats_in_one_shuffle(spark):
    a = spark.createDataFrame([(1, None), (1, None), (2, 0.5), (3, 1.0)], "k int, v double")
    b = spark.createDataFrame([(1, None), (2, 0.5), (2, 0.5), (4, float("nan"))], "k int, v double")
    got = E._united(a, b)
    assert got.columns == ["k", "v"]
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    expected = a.intersectAll(b).unionByName(a.exceptAll(b)).unionByName(b.exceptAll(a))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 6


def test_texts_of_one_table_are_made_before_the_joins(spark, small_tables):
    raw = E.queries()["raw_orders"](spark, small_tables)
    above = raw._jdf.queryExecution().optimizedPlan().toString().partition("Join")[0]
    assert "regexp_replace" not in above and "date_format" not in above
    row = raw.where("Order_Number = 5 AND Total_Cost = 14").first()
    assert (row["Customer_Name"], row["State_Code"], row["Order_Date"], row["Status"], row["Assigned Supervisor"]) == (
        "Customer 1", "TN", "05/03/2024", "Delivered", "Supplier 1")


def test_star_checks_join_the_tables_once(spark, small_tables, monkeypatch):
    calls, joined = [], E.orders_from_tables
    monkeypatch.setattr(E, "orders_from_tables", lambda *a, **kw: calls.append(1) or joined(*a, **kw))
    assert E.q_fact_margin_unguarded(spark, small_tables).count() == 16
    assert len(calls) == 1


def test_both_published_stars_join_the_tables_once(spark, small_tables, monkeypatch):
    calls = []
    for name in ("joined_lines", "orders_from_tables"):
        made = getattr(E, name)
        monkeypatch.setattr(E, name, lambda *a, _made=made, **kw: calls.append(1) or _made(*a, **kw))
    versions = E.q_published_versions(spark, small_tables)
    assert {r.version: r["count"] for r in versions.groupBy("version").count().collect()} == {1: 16, 2: 16}
    assert len(calls) == 1


def test_the_bookmarked_table_takes_its_rows_where_they_are(spark, small_tables, monkeypatch):
    from pyspark.sql import DataFrameWriter
    monkeypatch.setattr(DataFrameWriter, "insertInto", lambda *a, **kw: pytest.fail("rows written twice"))
    assert E.q_table_bookmark(spark, small_tables).count() == 16


def test_small_dimensions_are_not_merged_into_the_natural_fact(spark, small_tables):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # the lookups' own bounds decide
    try:
        fact = E.q_table_bookmark(spark, small_tables)
        assert "SortMergeJoin" not in fact._jdf.queryExecution().executedPlan().toString() and fact.count() == 16
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("query, ending", [("incremental_fact", ".zstd.parquet"), ("stream_quarantine", ".csv.lz4")])
def test_landed_rows_are_small(spark, small_tables, monkeypatch, query, ending):
    folders, scratch = [], E.scratch_folder
    monkeypatch.setattr(E, "scratch_folder", lambda *a: folders.append(scratch(*a)) or folders[-1])
    assert E.queries()[query](spark, small_tables).count() > 0
    at = f"{folders[0].removeprefix('file:')}/landing"
    landed = [f for f in os.listdir(at) if f.startswith("part-")]
    assert landed and all(f.endswith(ending) for f in landed)


def _joins(df):
    plans = [df._jdf.queryExecution().optimizedPlan()]
    while plans:
        plan = plans.pop()
        kids = plan.children()
        plans += [kids.apply(i) for i in range(kids.size())]
        if plan.nodeName() == "Join":
            out = plan.output()
            yield plan.condition().get().toString(), {out.apply(i).name() for i in range(out.size())}


@pytest.mark.parametrize("query", ["fact_orders_shuffled", "fact_orders_salted", "fact_orders_hot_salted"])
def test_large_lookups_send_numbers_and_natural_keys_alone(spark, small_tables, query):
    fact = E.queries()[query](spark, small_tables)
    lookups = [names for condition, names in _joins(fact) if "_sl_salt" in condition]
    assert len(lookups) == 5 and not any("total_sales" in names for names in lookups)
    assert fact.count() == 16


def test_lookups_together_take_the_landed_extract(spark, small_tables, monkeypatch):
    from starloom.operators import lookup
    monkeypatch.setattr(lookup, "scratch_folder", lambda *a: pytest.fail("rows landed twice"))
    assert E.queries()["fact_orders_together"](spark, small_tables).count() == 16


@pytest.fixture
def folders(monkeypatch):
    made, scratch = {}, E.scratch_folder
    monkeypatch.setattr(E, "scratch_folder", lambda spark, name: made.setdefault(name, scratch(spark, name)))
    return made


def test_scratch_rows_are_deleted_once_nothing_reads_them(spark, small_tables, folders):
    fact = E.queries()["compacted_fact"](spark, small_tables)
    assert not E.exists(spark, folders["extract"]) and not E.exists(spark, f"{folders['upkeep']}/whole")
    assert fact.count() == 16


def test_equal_formats_are_compared_without_moving_rows(spark, small_tables, folders):
    both = E.queries()["star_both_round_trip"](spark, small_tables)
    assert "Exchange" not in both._jdf.queryExecution().executedPlan().toString()
    assert not E.exists(spark, folders["extract"]) and both.count() == 16
    files = [f for f in os.listdir(f"{folders['star'].removeprefix('file:')}/csv/fact_orders") if f.startswith("part-")]
    assert files and all(f.endswith(".csv.gz") for f in files)


def test_united_tells_apart_what_hashes_alike(spark):
    a = spark.createDataFrame([(None, 5, -0.0), (1, 2, 0.5), (1, 2, 0.5), (7, 7, None)], "k int, v int, x double")
    b = spark.createDataFrame([(5, None, 0.0), (1, 2, 0.5), (7, 7, None)], "k int, v int, x double")
    expected = [(None, 5, 0.0), (5, None, 0.0), (1, 2, 0.5), (1, 2, 0.5), (7, 7, None)]
    assert sorted(map(str, map(tuple, E._united(a, b).collect()))) == sorted(map(str, expected))
    assert sorted(map(str, map(tuple, E._united(a, a).collect()))) == sorted(map(str, [expected[0], *expected[2:]]))
    assert E._united(a.limit(0), b).count() == E._united(b, a.limit(0)).count() == 3


def test_shuffle_files_of_a_landed_table_are_released(spark, tmp_dir):
    import time
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        blocks = manager.getAllBlocks()
        return {n for i in range(blocks.size()) if (n := blocks.apply(i).name()).startswith("shuffle_")}

    before, conf = shuffled(), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    set_before = spark.conf.get(conf)
    rows = spark.range(1000).repartition(3, "id")
    landed = E._landed_at(rows, f"{tmp_dir}/landed")
    until = time.time() + 20
    while shuffled() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.2)
    assert not shuffled() - before and landed.count() == rows.count() == 1000
    with E.shuffles_released(spark), E.shuffles_released(spark):
        assert spark.conf.get(conf) == "true"
    assert spark.conf.get(conf) == set_before
