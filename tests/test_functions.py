import datetime as dt
import re

from pyspark.sql import functions as F

from starloom.functions import (date_attributes, first_token, last_token, parse_date,
                                profit_margin, stable_uuid)


def test_name_split_whitespace(spark):
    df = spark.createDataFrame([("Adhir Samal",), ("Bijendra",), ("Ram Kumar Singh",),
                                ("  Asha   Rao ",), ("",), (None,)], "n string")
    out = df.select("n", first_token("n").alias("f"), last_token("n").alias("l")).collect()
    got = {r.n: (r.f, r.l) for r in out}
    assert got["Adhir Samal"] == ("Adhir", "Samal")
    assert got["Bijendra"] == ("Bijendra", "Bijendra")
    assert got["Ram Kumar Singh"] == ("Ram", "Singh")
    assert got["  Asha   Rao "] == ("Asha", "Rao")
    assert got[""] == (None, None)
    assert got[None] == (None, None)


def test_name_split_single_space_mode(spark):
    df = spark.createDataFrame([(" Asha Rao",)], "n string")
    r = df.select(first_token("n", "space").alias("f"), last_token("n", "space").alias("l")).first()
    assert (r.f, r.l) == ("", "Rao")


def test_parse_date_lenient_and_strict(spark):
    df = spark.createDataFrame([("05/03/2024",), ("5/3/2024",), ("31/02/2024",), (None,),
                                ("2024-01-01",)], "s string")
    got = [r.d for r in df.select(parse_date("s").alias("d")).collect()]
    assert got == [dt.date(2024, 3, 5), dt.date(2024, 3, 5), None, None, None]
    bad = spark.createDataFrame([("31/02/2024",)], "s string")
    try:
        bad.select(parse_date("s", strict=True)).collect()
    except Exception as e:  # noqa: BLE001
        assert "31/02/2024" in str(e) or "DATETIME" in str(e).upper()
    else:
        raise AssertionError("strict parse should raise")


def test_date_attributes_iso_edges(spark):
    df = spark.createDataFrame([(dt.date(2021, 1, 3),), (dt.date(2024, 12, 30),),
                                (dt.date(2024, 3, 9),)], "d date")
    mon = df.select("d", *[c.alias(k) for k, c in date_attributes(F.col("d")).items()])
    rows = {r.d: r for r in mon.collect()}
    sun = rows[dt.date(2021, 1, 3)]
    assert (sun.day_of_week, sun.day_name, sun.week_of_year, sun.is_weekend) == (7, "Sunday", 53, True)
    mon_ = rows[dt.date(2024, 12, 30)]
    assert (mon_.day_of_week, mon_.week_of_year, mon_.quarter, mon_.month_name) == (1, 1, 4, "December")
    sat = rows[dt.date(2024, 3, 9)]
    assert (sat.day_of_week, sat.is_weekend, sat.day_of_year) == (6, True, 69)
    sunday_first = df.select("d", date_attributes(F.col("d"), "sunday")["day_of_week"].alias("w"))
    assert {r.d: r.w for r in sunday_first.collect()}[dt.date(2021, 1, 3)] == 1


def test_profit_margin_modes(spark):
    df = spark.createDataFrame([(100.0, 80.0), (0.0, 5.0), (-10.0, 5.0), (None, 5.0), (50.0, None)],
                               "s double, c double")
    g = [r.m for r in df.select(profit_margin(F.col("s"), F.col("c")).alias("m")).collect()]
    assert g == [0.2, 0.0, 0.0, 0.0, None]
    u = [r.m for r in df.select(profit_margin(F.col("s"), F.col("c"), "unguarded").alias("m")).collect()]
    assert u == [0.2, None, 1.5, None, None]


def test_stable_uuid(spark):
    df = spark.createDataFrame([("India", "IN-AP"), ("India", "IN-AP"), ("Canada", "CA-PE")],
                               "country string, iso string")
    ids = [r.k for r in df.select(stable_uuid("country", "iso").alias("k")).collect()]
    assert ids[0] == ids[1] != ids[2]
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", i)
               for i in ids)


def test_name_split_on_any_white_space(spark):
    names = ["\tJohn Doe\n", "Ann\u00a0Mary \t Lee", "\n\t ", "Solo\r", None]
    rows = spark.createDataFrame([(n,) for n in names], "n string").select(
        "n", first_token("n").alias("a"), last_token("n").alias("b")).collect()
    for r in rows:
        want = (r.n or "").split()
        assert (r.a, r.b) == ((want[0], want[-1]) if want else (None, None))
