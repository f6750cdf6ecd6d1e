"""Property tests: the rewrites equal their textbook definitions."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from starloom.operators import number_rows, single_valued

SETTINGS = dict(max_examples=12, deadline=None,
                suppress_health_check=[HealthCheck.function_scoped_fixture])


@settings(**SETTINGS)
@given(keys=st.lists(st.tuples(st.integers(-5, 5), st.text("ab", max_size=3)), max_size=60,
                     unique=True),
       buckets=st.integers(1, 9))
def test_number_rows_is_row_number(spark, keys, buckets):
    df = spark.createDataFrame(keys, "a int, b string")
    got = {(r.a, r.b): r.id for r in number_rows(df, ["a", "b"], "id", buckets).collect()}
    want = sorted(keys)
    assert got == {k: i + 1 for i, k in enumerate(want)}


@settings(**SETTINGS)
@given(rows=st.lists(st.tuples(st.sampled_from(["p", "q", "r"]),
                               st.one_of(st.none(), st.sampled_from([0.0, 1.5, 2.0]))),
                     max_size=40))
def test_single_valued_is_count_distinct_one(spark, rows):
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.s for r in single_valued(df, ["k"], "v", "s").collect()}
    ref = (df.groupBy("k").agg(F.count_distinct("v").alias("n"), F.max("v").alias("m"))
             .select("k", F.when(F.col("n") == 1, F.col("m")).alias("s")))
    assert got == {r.k: r.s for r in ref.collect()}


@settings(**SETTINGS)
@given(names=st.lists(st.one_of(st.none(), st.sampled_from(["Al Bo", "Cy", "Al Bo ", "Di Ex Fa"])),
                      max_size=30))
def test_dense_key_matches_window_over_distinct(spark, names):
    from starloom.operators import dense_key
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = {r.n: r.id for r in dense_key(df, ["n"], "id", num_buckets=3).collect()}
    ref = (df.dropna().distinct().withColumn("id", F.row_number().over(Window.orderBy("n"))))
    assert got == {r.n: r.id for r in ref.collect()}
