import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import (bounded_broadcast, dense_key, extend_key, first_seen_key,
                                last_wins, lookup_key, number_rows, single_valued)


def test_dense_key_equals_global_row_number(spark):
    rnd = random.Random(7)
    names = [f"n{rnd.randint(0, 10**9):09d}" for _ in range(5000)] + [None, None]
    df = spark.createDataFrame([(n,) for n in names], "k string")
    got = dense_key(df, ["k"], "id", num_buckets=7)
    ref = (df.dropna().distinct()
             .withColumn("rid", F.row_number().over(Window.orderBy("k"))))
    joined = got.join(ref, "k", "full")
    assert joined.filter("id IS NULL OR rid IS NULL OR id <> rid").count() == 0
    ids = [r.id for r in got.orderBy("id").collect()]
    assert ids == list(range(1, len(set(n for n in names if n)) + 1))


def test_number_rows_multi_column_and_skew(spark):
    # one hot key value in the first column: range partitions still number densely
    rows = [(1, i) for i in range(3000)] + [(k, 0) for k in range(2, 500)]
    df = spark.createDataFrame(rows, "a int, b int")
    got = number_rows(df, ["a", "b"], "id", num_buckets=5)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("a", "b")))
    assert got.join(ref, ["a", "b"]).filter("id <> rid").count() == 0
    assert got.count() == len(rows)


def test_first_seen_key(spark):
    df = spark.createDataFrame(
        [("b", "2024-01-01", 2.0), ("a", "2024-01-02", 1.0), ("c", "2024-01-01", 1.0),
         ("a", "2023-12-31", 9.0), ("d", None, 1.0)],
        "name string, d string, n double")
    got = {r.name: r.id for r in first_seen_key(df, ["name"], ["d", "n"], "id").collect()}
    # d never seen with a date -> NULL first appearance sorts first
    assert got == {"d": 1, "a": 2, "c": 3, "b": 4}


def test_extend_key_keeps_existing(spark):
    existing = spark.createDataFrame([("x", 1), ("y", 2)], "k string, id int")
    cand = spark.createDataFrame([("y",), ("a",), ("z",), (None,)], "k string")
    new = {r.k: r.id for r in extend_key(existing, cand, ["k"], "id").collect()}
    assert new == {"a": 3, "z": 4}


def test_single_valued(spark):
    df = spark.createDataFrame(
        [("p1", 1.0), ("p1", 1.0), ("p2", 1.0), ("p2", 2.0), ("p3", None), ("p3", 5.0),
         ("p4", None)], "k string, v double")
    got = {r.k: r.s for r in single_valued(df, ["k"], "v", "s").collect()}
    assert got == {"p1": 1.0, "p2": None, "p3": 5.0, "p4": None}
    got0 = {r.k: r.s for r in single_valued(df, ["k"], "v", "s", default=0.0).collect()}
    assert got0["p2"] == 0.0 and got0["p4"] == 0.0


def test_lookup_broadcast_and_salted_paths_agree(spark):
    fact = spark.createDataFrame([(i % 3 if i % 4 else None, i) for i in range(200)],
                                 "code int, v int")
    dim = spark.createDataFrame([(0, 10), (1, 11), (2, 12)], "c int, key int")
    small = lookup_key(fact, dim, {"code": "c"}, "key")
    salted = lookup_key(fact, dim, {"code": "c"}, "key", broadcast_max_rows=1, salt_buckets=4)
    plain = lookup_key(fact, dim, {"code": "c"}, "key", broadcast_max_rows=1)
    ref = sorted((tuple(r) for r in small.collect()), key=repr)
    assert sorted((tuple(r) for r in salted.collect()), key=repr) == ref
    assert sorted((tuple(r) for r in plain.collect()), key=repr) == ref
    assert small.count() == 200
    assert "BroadcastHashJoin" in small._jdf.queryExecution().executedPlan().toString()


def test_bounded_broadcast_checks_size(spark):
    dim = spark.range(10)
    _, small = bounded_broadcast(dim, max_rows=10)
    _, big = bounded_broadcast(dim, max_rows=9)
    assert small and not big


def test_last_wins(spark):
    dim = spark.createDataFrame([("pen", 1), ("pen", 4), ("cup", 2)], "name string, id int")
    assert {r.name: r.id for r in last_wins(dim, "name", "id").collect()} == {"pen": 4, "cup": 2}


def test_number_rows_many_ranges(spark):
    df = spark.range(0, 3000, 3).select((F.col("id") * 7 % 10007).alias("k"))
    got = number_rows(df, ["k"], "id", num_buckets=257)
    ref = df.withColumn("rid", F.row_number().over(Window.orderBy("k")))
    assert got.join(ref, "k").filter("id <> rid").count() == 0
    assert got.count() == 1000


def test_hot_key_salting(spark):
    from starloom.operators import hot_keys
    # key 1 holds half of the rows; NULL keys are never hot
    rows = [(1, i) for i in range(500)] + [(k % 50 + 2, i) for k, i in zip(range(400), range(400))] \
        + [(None, i) for i in range(100)]
    fact = spark.createDataFrame(rows, "code int, v int")
    hot = {r.code for r in hot_keys(fact, ["code"], 0.2).collect()}
    assert 1 in hot and None not in hot and len(hot) <= 5
    dim = spark.createDataFrame([(k, k * 10) for k in range(1, 60)], "c int, key int")
    ref = sorted((tuple(r) for r in lookup_key(fact, dim, {"code": "c"}, "key").collect()), key=repr)
    got = lookup_key(fact, dim, {"code": "c"}, "key", broadcast_max_rows=0, salt_buckets=4,
                     hot_share=0.2)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == ref


def test_large_dimension_joins_are_sort_merge_and_spread_null_keys(spark):
    from pyspark.sql import functions as F

    from starloom.operators import lookup_key
    from starloom.operators.lookup import size_of
    fact = spark.range(20_000).select("id", F.when(F.col("id") % 10 >= 6, (F.col("id") % 500).cast("string")).alias("code"))
    dim = spark.range(500).select(F.col("id").cast("string").alias("code"), F.col("id").alias("key"))
    out = lookup_key(fact, dim, {"code": "code"}, "key", broadcast_max_rows=0)
    sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    assert out.where("code IS NULL AND key IS NULL").count() == 12_000
    assert out.where("code IS NOT NULL AND CAST(key AS STRING) = code").count() == 8_000
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        plan = out._jdf.queryExecution()
        out.collect()
        assert "SortMergeJoin" in plan.executedPlan().toString()
        assert "BroadcastHashJoin" not in plan.executedPlan().toString()
        assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert size_of(dim)[0] == 500 and size_of(dim)[1] > 500 * 40


def test_keys_are_64_bit_and_contract_width_is_checked(spark, make_raw):
    import pytest
    from conftest import raw_row
    from pyspark.errors import PySparkException

    from starloom.plans.star import build_star
    raw = make_raw([raw_row(3e9), raw_row(4e9)])
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(PySparkException, match="does not fit"):
                build_star(raw)["fact_orders"].collect()
            wide = build_star(raw, wide_keys=True)["fact_orders"]
            assert {r.order_number for r in wide.collect()} == {3_000_000_000, 4_000_000_000}
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


def test_lookup_together_equals_one_by_one(spark):
    from starloom.operators.lookup import lookup_together
    fact = spark.createDataFrame(
        [(i, f"a{i % 5}" if i % 7 else None, f"b{i % 3}", "hot" if i % 3 else f"c{i}", float(i)) for i in range(200)]
        + [(0, "a0", None, "hot", None)] * 3, "n int, `a b` string, b string, c string, x double")
    one = spark.createDataFrame([(f"a{i}", i) for i in range(4)], "name string, a_id int")
    two = spark.createDataFrame([(f"b{i}", c, f"k{i}{c}") for i in range(3) for c in ("hot", "c9")], "b string, cc string, two_id string")
    steps = [(one, {"a b": "name"}, "a_id"), (two, {"b": "b", "c": "cc"}, "two_id")]
    got = lookup_together(fact, steps)
    want = fact
    for dim, on, key in steps:
        want = lookup_key(want, dim, on, key)
    assert dict(got.dtypes) == dict(want.dtypes)
    assert sorted(map(tuple, got.select(want.columns).collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    plan = got._jdf.queryExecution()
    got.write.format("noop").mode("overwrite").save()
    got.collect()
    text = plan.executedPlan().toString()
    # the entries and their members, then rows and findings by number: no more, whatever the number of lookups
    assert text.split("== Initial Plan ==")[0].count("Exchange hashpartitioning") == 3
    assert lookup_together(fact.limit(0), steps).count() == 0
    with pytest.raises(TypeError):
        lookup_together(fact, [(one, {"n": "name"}, "a_id")])
