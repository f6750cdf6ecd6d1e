"""Commits, publication in one step, loads at the same time, compaction, clustering."""

import glob
import os
import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

import pyarrow.parquet as pq
import pytest
from conftest import raw_row
from pyspark.sql import functions as F

from starloom import contracts as C
from starloom.plans.quality import DIM_COMPLETENESS_COLUMNS, FACT_COMPLETENESS_COLUMNS, completeness
from starloom.plans.star import build_star
from starloom.sinks import ConcurrentChange, StarLog, compact, expire, publish_star, read_star, snapshots
from starloom.sinks.upkeep import clustered, z_value
from starloom.streaming import (completeness_so_far, incremental, key_uniqueness_so_far, load_counts, load_table, process_batch,
                                read_dim_prod, read_fact, read_rejects, read_table, run_incremental)

TS = datetime(2025, 3, 31, tzinfo=timezone.utc)


def bag(df):
    return sorted(map(tuple, df.collect()), key=repr)


def folders(root, table):
    return glob.glob(f"{root}/{table}/part=*")


# ------------------------------------------------------------------ commits

def test_a_file_is_created_once(spark, tmp_dir):
    path = f"{tmp_dir}/c/0001.json"
    with ThreadPoolExecutor(8) as pool:
        won = list(pool.map(lambda i: (snapshots.create_once(spark, path, f"writer {i}"), i), range(8)))
    winner = [i for ok, i in won if ok]
    assert len(winner) == 1 and snapshots.read_text(spark, path) == f"writer {winner[0]}"
    assert [f for f in os.listdir(f"{tmp_dir}/c") if "draft" in f] == []


def test_a_loser_starts_again_from_the_winner(spark, tmp_dir):
    log, other = StarLog(spark, tmp_dir), StarLog(spark, tmp_dir)
    bases = []

    def change(base):
        bases.append(base.version)
        if len(bases) == 1:  # somebody else is faster
            other.update("other", lambda now: snapshots.replace(now, keys={"customer_id": 7}))
        return snapshots.replace(base, keys={**base.keys, "employee_id": base.keys.get("customer_id", 0) + 1})

    made = log.update("mine", change)
    assert bases == [0, 1] and made.version == 2 and made.keys == {"customer_id": 7, "employee_id": 8}
    assert log.latest() == made and log.at(1).keys == {"customer_id": 7}
    assert log.update("nothing", lambda base: None) == made and log.versions() == [1, 2]
    stuck = StarLog(spark, tmp_dir)
    stuck.commit = lambda *a: None
    with pytest.raises(ConcurrentChange):
        stuck.update("stuck", lambda base: base, attempts=2)


def test_snapshot_survives_json():
    part = snapshots.Part("t/part=a", 3, 10, 1, "x", 2, {"c": 1})
    s = snapshots.Snapshot(4, "load", "now", {"t": (part,)}, {"k": 9}, {"x": {"batch": 2}}, {"t": 3},
                           {"db.t": ("d=1",)})
    assert snapshots.Snapshot.from_json(s.to_json()) == s
    assert s.with_parts({}, {"t": [part]}).parts("t") == ()


# ------------------------------------------------------------------ loads at once

def meet_once(monkeypatch, owner, name, parties=2):
    """Let the first calls of a function wait for each other after their work."""
    barrier, first, plain = threading.Barrier(parties), set(), getattr(owner, name)

    def meeting(*a, **k):
        out = plain(*a, **k)
        me = threading.get_ident()
        if me not in first and len(first) < parties:
            first.add(me)
            barrier.wait(120)
        return out

    monkeypatch.setattr(owner, name, meeting)


def test_overlapping_loads_started_together_share_keys(spark, make_raw, tmp_dir, monkeypatch):
    calls = []
    plain = incremental._Members.find
    monkeypatch.setattr(incremental._Members, "find", lambda self, base: (calls.append(base.version), plain(self, base))[1])
    meet_once(monkeypatch, incremental._Members, "find")  # both have seen the empty star
    batches = [make_raw([raw_row(1.0, customer="A B", product="Pen"), raw_row(2.0, customer="B C", product="Cup")]),
               make_raw([raw_row(3.0, customer="B C", product="Cup"), raw_row(4.0, customer="C D", product="Mug")])]
    with ThreadPoolExecutor(2) as pool:
        counts = list(pool.map(lambda k: process_batch(batches[k], 0, tmp_dir, load_id=f"load{k}"), range(2)))
    # one of them had to start again, once: the winner's commit of its rows is no reason to
    assert sorted(calls)[:2] == [0, 0] and len(calls) == 3
    assert counts == [{"read": 2, "loaded": 2, "rejected": 0}] * 2
    for table, names in (("dim_cust", {"A B", "B C", "C D"}), ("dim_prod", {"Pen", "Cup", "Mug"})):
        rows = read_table(spark, tmp_dir, table).collect()
        assert sorted(r[0] for r in rows) == [1, 2, 3] and {r[1] for r in rows} == names
    fact = read_fact(spark, tmp_dir).join(read_table(spark, tmp_dir, "dim_cust"), "customer_id")
    assert {(r.order_number, r.customer_name) for r in fact.collect()} == {
        (1, "A B"), (2, "B C"), (3, "B C"), (4, "C D")}
    log = StarLog(spark, tmp_dir)
    named = {p.path for ps in log.latest().tables.values() for p in ps}
    assert all(os.path.relpath(f, tmp_dir) in named for t in C.STAR for f in folders(tmp_dir, t))  # the loser tidied up


def test_the_same_files_from_two_checkpoints_at_once(spark, make_raw, tmp_dir, monkeypatch):
    src, root = f"{tmp_dir}/src", f"{tmp_dir}/star"
    make_raw([raw_row(1.0), raw_row(2.0)]).coalesce(1).write.parquet(src)
    meet_once(monkeypatch, incremental, "build_fact_orders")  # neither has committed its files
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: run_incremental(spark, src, root, f"{tmp_dir}/ck{k}", source_format="parquet"), range(2)))
    assert sorted(r.order_number for r in read_fact(spark, root).collect()) == [1, 2]
    assert sorted(r.read for r in load_counts(spark, root).collect()) == [0, 2]


def test_a_batch_that_fails_is_not_there(spark, make_raw, tmp_dir, monkeypatch):
    plain, batch = incremental.build_fact_orders, make_raw([raw_row(1.0)])
    monkeypatch.setattr(incremental, "build_fact_orders", lambda *a, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        process_batch(batch, 0, tmp_dir)
    assert read_fact(spark, tmp_dir).count() == 0 and load_counts(spark, tmp_dir).count() == 0
    monkeypatch.setattr(incremental, "build_fact_orders", plain)
    assert process_batch(batch, 0, tmp_dir) == process_batch(batch, 0, tmp_dir) == {"read": 1, "loaded": 1, "rejected": 0}
    assert read_fact(spark, tmp_dir).count() == 1 and read_table(spark, tmp_dir, "dim_cust").count() == 1
    empty = process_batch(batch.limit(0), 1, tmp_dir)
    assert empty == {"read": 0, "loaded": 0, "rejected": 0}


# ------------------------------------------------------------------ rejects

def write_csv(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("Order_Number,State_Code,Customer_Name,Order_Date,Status,Product,Category,Brand,Cost,Sales,Quantity,"
                "Total_Cost,Total_Sales,Assigned Supervisor\n")
        f.writelines(",".join(str(v) if v is not None else "" for v in r) + "\n" for r in rows)


def test_rejects_of_a_stream_are_kept_and_counted(spark, tmp_dir):
    src, root = f"{tmp_dir}/src", f"{tmp_dir}/star"
    write_csv(f"{src}/a.csv", [raw_row(1.0), raw_row("12x", customer="Bad Number"), raw_row(None, customer="No Number"),
                               raw_row(4.0, cost="ten")])
    run_incremental(spark, src, root, f"{tmp_dir}/ck")
    row = load_counts(spark, root).first()
    assert (row.read, row.loaded, row.rejected) == (4, 1, 3)
    kept = read_rejects(spark, root).collect()
    assert {(r.reasons[0], r.load_id, r.batch_id) for r in kept} == {
        ("malformed", row.load_id, 0), ("no_order_number", row.load_id, 0)}
    assert {"12x" in r.record or "ten" in r.record for r in kept if r.reasons == ["malformed"]} == {True}
    assert all(r.file.endswith("a.csv") for r in kept)
    assert "No Number" in next(r.record for r in kept if r.reasons == ["no_order_number"])
    run_incremental(spark, src, root, f"{tmp_dir}/ck2")  # a lost checkpoint: nothing doubles
    assert read_rejects(spark, root).count() == 3 and read_fact(spark, root).count() == 1
    assert {r.customer_name for r in read_table(spark, root, "dim_cust").collect()} == {"Asha Rao"}
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        run_incremental(spark, src, f"{tmp_dir}/strict", f"{tmp_dir}/ck3", csv_mode="FAILFAST")


def test_rows_that_break_rules_are_set_aside_on_request(spark, make_raw, tmp_dir):
    rows = make_raw([raw_row(1.0), raw_row(2.0, date="31/02/2024", quantity=0.0), raw_row(3.0, total_sales=1.0, total_cost=9.0),
                     raw_row(None)])
    assert process_batch(rows, 0, f"{tmp_dir}/a", on_violation="quarantine") == {"read": 4, "loaded": 1, "rejected": 3}
    assert [r.order_number for r in read_fact(spark, f"{tmp_dir}/a").collect()] == [1]
    broken = {r.record.split('"order_number":')[1].split(",")[0]: sorted(r.reasons)
              for r in read_rejects(spark, f"{tmp_dir}/a").collect() if "no_order_number" not in r.reasons}
    assert broken == {"2": ["check_quantity_positive", "not_null:order_date"], "3": ["check_profit_margin"]}
    assert process_batch(rows, 0, f"{tmp_dir}/b")["loaded"] == 3
    only_bad = make_raw([raw_row(5.0, quantity=0.0)])
    assert process_batch(only_bad, 1, f"{tmp_dir}/a", on_violation="quarantine") == {"read": 1, "loaded": 0, "rejected": 1}
    assert read_fact(spark, f"{tmp_dir}/a").count() == 1
    with pytest.raises(ValueError):
        process_batch(rows, 2, f"{tmp_dir}/a", on_violation="drop")


# ------------------------------------------------------------------ products, bookmarks

def test_update_date_moves_for_changed_products_only(spark, make_raw, tmp_dir):
    def load(k, *rows):
        process_batch(make_raw(list(rows)), k, tmp_dir, run_ts=TS + timedelta(days=k))
        return {r.product_name: (r.product_id, r.standard_cost, (r.create_date - TS.replace(tzinfo=None)).days,
                                 (r.update_date - TS.replace(tzinfo=None)).days)
                for r in read_dim_prod(spark, tmp_dir).collect()}

    one = load(0, raw_row(1.0, product="Pen", cost=10.0), raw_row(2.0, product="Cup", cost=None))
    assert one == {"Cup": (1, 0.0, 0, 0), "Pen": (2, 10.0, 0, 0)}
    two = load(1, raw_row(3.0, product="Pen", cost=10.0), raw_row(4.0, product="Cup", cost=3.0), raw_row(5.0, product="Ink", cost=1.0))
    assert two == {"Cup": (1, 3.0, 0, 1), "Pen": (2, 10.0, 0, 0), "Ink": (3, 1.0, 1, 1)}
    three = load(2, raw_row(6.0, product="Pen", cost=11.0), raw_row(7.0, product="Ink", cost=None))
    assert three == {"Cup": (1, 3.0, 0, 1), "Pen": (2, 0.0, 0, 2), "Ink": (3, 1.0, 1, 1)}
    before = bag(read_dim_prod(spark, tmp_dir))
    compact(spark, tmp_dir, "prod_cost")
    assert len(StarLog(spark, tmp_dir).latest().parts("prod_cost")) == 1
    four = load(3, raw_row(8.0, product="Pen", cost=10.0))  # still two costs
    assert four == three and bag(read_dim_prod(spark, tmp_dir)) == before


def test_table_partitions_are_loaded_once(spark, make_raw, tmp_dir, monkeypatch):
    spark.sql("DROP TABLE IF EXISTS extract_by_day")
    a = make_raw([raw_row(1.0), raw_row(2.0)]).withColumn("day", F.lit("2024-01-01")).withColumn("part", F.lit(None).cast("string"))
    b = make_raw([raw_row(3.0)]).withColumn("day", F.lit("a/b=c d")).withColumn("part", F.lit("x"))
    a.write.partitionBy("day", "part").saveAsTable("extract_by_day")
    assert load_table(spark, "extract_by_day", tmp_dir) == {"read": 2, "loaded": 2, "rejected": 0}
    b.write.mode("append").partitionBy("day", "part").saveAsTable("extract_by_day")
    plain = incremental.build_fact_orders
    monkeypatch.setattr(incremental, "build_fact_orders", lambda *x, **k: 1 / 0)
    with pytest.raises(ZeroDivisionError):  # a run that fails has loaded nothing
        load_table(spark, "extract_by_day", tmp_dir)
    monkeypatch.setattr(incremental, "build_fact_orders", plain)
    assert load_table(spark, "extract_by_day", tmp_dir) == {"read": 1, "loaded": 1, "rejected": 0}
    assert load_table(spark, "extract_by_day", tmp_dir)["read"] == 0
    assert sorted(r.order_number for r in read_fact(spark, tmp_dir).collect()) == [1, 2, 3]
    spark.sql("DROP TABLE extract_by_day")


# ------------------------------------------------------------------ publication

def test_a_run_killed_after_the_third_table_leaves_the_old_star(spark, make_raw, tmp_dir, monkeypatch):
    old = build_star(make_raw([raw_row(1.0)]), run_ts=TS)
    new = build_star(make_raw([raw_row(2.0, customer="New One"), raw_row(3.0)]), run_ts=TS)
    first = publish_star(spark, old, tmp_dir)
    before = {n: bag(df) for n, df in read_star(spark, tmp_dir).items()}
    assert first.keys["customer_id"] == 1 and before["fact_orders"][0][0] == 1
    written, plain = [], StarLog.write_part

    def dying(self, df, table, **k):
        if len(written) == 3:
            raise KeyboardInterrupt
        written.append(table)
        return plain(self, df, table, **k)

    monkeypatch.setattr(StarLog, "write_part", dying)
    monkeypatch.setattr(StarLog, "discard", lambda self, *paths: None)  # killed: nothing tidies up
    with pytest.raises(KeyboardInterrupt):
        publish_star(spark, new, tmp_dir)
    monkeypatch.undo()
    assert len(written) == 3 and len(folders(tmp_dir, written[0])) == 2
    assert {n: bag(df) for n, df in read_star(spark, tmp_dir).items()} == before
    assert expire(spark, tmp_dir) == 0  # too young: a writer might be at work
    assert expire(spark, tmp_dir, older_than_hours=-1) == 3
    second = publish_star(spark, new, tmp_dir, expect=first.version)
    assert bag(read_star(spark, tmp_dir)["dim_cust"]) == bag(new["dim_cust"])
    assert {n: bag(df) for n, df in read_star(spark, tmp_dir, first.version).items()} == before
    with pytest.raises(ConcurrentChange):
        publish_star(spark, old, tmp_dir, expect=first.version)
    assert StarLog(spark, tmp_dir).latest() == second and len(folders(tmp_dir, "fact_orders")) == 2
    # a load goes on from the published keys and costs
    process_batch(make_raw([raw_row(9.0, customer="Zed Z")]), 0, tmp_dir)
    assert [r.standard_cost for r in read_dim_prod(spark, tmp_dir).collect()] == [10.0]
    assert completeness_so_far(spark, tmp_dir).where("column_name = 'customer_name'").first().total_records == 3
    assert {(r.customer_name, r.customer_id) for r in read_table(spark, tmp_dir, "dim_cust").collect()} == {
        ("Asha Rao", 1), ("New One", 2), ("Zed Z", 3)}
    assert sorted(r.order_number for r in read_fact(spark, tmp_dir).collect()) == [2, 3, 9]
    assert expire(spark, tmp_dir, keep=1, older_than_hours=-1) > 0 and read_fact(spark, tmp_dir).count() == 3
    assert len(StarLog(spark, tmp_dir).versions()) == 1


def test_job_publishes_and_keeps_rejects(spark, tmp_dir):
    from starloom.plans.job import run
    write_csv(f"{tmp_dir}/src/a.csv", [raw_row(1.0), raw_row("7y"), raw_row(2.0)])
    done = run(spark, f"{tmp_dir}/src", f"{tmp_dir}/star", target_format="snapshot")
    assert (done["raw_rows"], done["rejected_rows"], done["fact_rows"]) == (3, 1, 2)
    kept = spark.read.parquet(done["rejects"]).collect()
    assert len(kept) == 1 and "7y" in kept[0].record and kept[0].file.endswith("a.csv")
    assert read_star(spark, f"{tmp_dir}/star")["fact_orders"].count() == 2 and os.path.isdir(f"{done['reports']}/checks")


def test_costs_go_on_after_a_publication(spark, make_raw, tmp_dir):
    from starloom.plans.job import run
    rows = [raw_row(1.0, product="One", cost=5.0), raw_row(2.0, product="Two", cost=5.0), raw_row(3.0, product="Two", cost=6.0),
            raw_row(4.0, product="None", cost=None)]
    make_raw(rows).write.parquet(f"{tmp_dir}/src")
    more = make_raw([raw_row(9.0 + i, product=p, cost=7.0) for i, p in enumerate(("One", "Two", "None", "New"))])

    def costs(root):
        return {r.product_name: r.standard_cost for r in read_dim_prod(spark, root).collect()}

    run(spark, f"{tmp_dir}/src", f"{tmp_dir}/job", source_format="parquet", target_format="snapshot", reports=False)
    publish_star(spark, build_star(make_raw(rows), run_ts=TS), f"{tmp_dir}/plain")
    for root in ("job", "plain"):
        assert costs(f"{tmp_dir}/{root}") == {"One": 5.0, "Two": 0.0, "None": 0.0}
        process_batch(more, 0, f"{tmp_dir}/{root}")
    assert costs(f"{tmp_dir}/job") == {"One": 0.0, "Two": 0.0, "None": 7.0, "New": 7.0}
    assert costs(f"{tmp_dir}/plain") == {"One": 0.0, "Two": 0.0, "None": 0.0, "New": 7.0}  # no costs were given


# ------------------------------------------------------------------ compaction, clustering

def some_fact(spark, n, products=50, days=40):
    row = {"order_number": F.col("id").cast("int"), "order_date": F.date_add(F.lit(date(2024, 1, 1)), (F.xxhash64("id") % days).cast("int")),
           "customer_id": F.lit(1), "state_id": F.lit("s"), "product_id": (F.abs(F.xxhash64("id", F.lit(1))) % products).cast("int"),
           "status_id": F.lit(1), "employee_id": F.lit(1), "quantity": F.lit(2)}
    row |= {c.name: F.rand(5) for c in C.FACT_ORDERS.columns if c.name not in row}
    return spark.range(n).select(*[row[c].alias(c) for c in C.FACT_ORDERS.names])


def test_hundred_loads_become_files_of_the_target_size(spark, tmp_dir):
    log = StarLog(spark, tmp_dir)
    whole = some_fact(spark, 20_000).repartition(100).cache()
    # what a hundred loads leave, made in one go: a folder of one small file each
    load = F.lpad(F.hex(F.col("order_number") % 100), 2, "0")
    whole.withColumn("part", F.concat(F.lit("a"), F.lower(load))).repartition(50, "part").write.partitionBy("part").parquet(
        f"{tmp_dir}/fact_orders")
    parts = [snapshots.Part(os.path.relpath(f, tmp_dir), 200, sum(os.path.getsize(x) for x in glob.glob(f"{f}/*.parquet")), 1)
             for f in folders(tmp_dir, "fact_orders")]
    for k in range(0, 100, 10):
        log.update("load", lambda now, k=k: now.with_parts({"fact_orders": parts[k:k + 10]}))
    before = log.latest().parts("fact_orders")
    assert len(before) == sum(p.files for p in before) == 100
    total = sum(p.bytes for p in before)
    target = total // 5
    after = compact(spark, tmp_dir, "fact_orders", target_bytes=target)
    (part,) = after.parts("fact_orders")
    sizes = [os.path.getsize(f) for f in glob.glob(f"{tmp_dir}/{part.path}/part-*")]
    assert part.rows == 20_000 and part.files == len(sizes) <= 7 and part.missing == dict.fromkeys(C.FACT_ORDERS.names, 0)
    assert max(sizes) <= target * 1.1 and sorted(sizes)[1] >= target * 0.4  # all but one are near the target
    assert bag(read_fact(spark, tmp_dir)) == bag(whole)
    assert compact(spark, tmp_dir, "fact_orders", target_bytes=target) == after  # nothing is left to do
    assert bag(log.read("fact_orders", C.FACT_ORDERS.schema, log.at(10))) == bag(whole)  # earlier readers go on
    whole.unpersist()


def test_compaction_gives_way(spark, tmp_dir, monkeypatch):
    log = StarLog(spark, tmp_dir)
    for k in range(3):
        part = log.write_part(some_fact(spark, 10).coalesce(1), "fact_orders")
        log.update("load", lambda now, p=part: now.with_parts({"fact_orders": [p]}))
    plain = StarLog.write_part

    def overtaken(self, df, table, **k):
        gone = [self.latest().parts(table)[0]]
        self.update("drop", lambda now: now.with_parts({}, {table: gone}))
        return plain(self, df, table, **k)

    monkeypatch.setattr(StarLog, "write_part", overtaken)
    after = compact(spark, tmp_dir, "fact_orders")
    assert after.action == "drop" and len(after.parts("fact_orders")) == 2
    monkeypatch.undo()

    def appended(self, df, table, **k):  # a load in between is no hindrance
        more = plain(self, some_fact(spark, 5).coalesce(1), table)
        self.update("load", lambda now: now.with_parts({table: [more]}))
        return plain(self, df, table, **k)

    monkeypatch.setattr(StarLog, "write_part", appended)
    after = compact(spark, tmp_dir, "fact_orders")
    assert [p.rows for p in after.parts("fact_orders")] == [5, 20]


def row_groups(folder):
    """(least, most) of order_date and product_id, and the rows, of each row group."""
    out = []
    for f in glob.glob(f"{folder}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = {meta.schema.column(i).name: i for i in range(meta.num_columns)}
        for g in range(meta.num_row_groups):
            stats = [meta.row_group(g).column(at[c]).statistics for c in ("order_date", "product_id")]
            out.append((*[(s.min, s.max) for s in stats], meta.row_group(g).num_rows))
    return out


def share_read(groups, which, value):
    return sum(g[which][0] <= value <= g[which][1] for g in groups) / len(groups)


def test_point_filters_read_few_row_groups(spark, tmp_dir):
    fact = some_fact(spark, 40_000, products=64, days=64)
    fact.repartition(64).write.parquet(f"{tmp_dir}/plain")
    clustered(fact, ["order_date", "product_id"], 64).write.parquet(f"{tmp_dir}/range")
    clustered(fact, ["order_date", "product_id"], 64, interleave=True).write.parquet(f"{tmp_dir}/z")
    day, groups = date(2024, 1, 20), {k: row_groups(f"{tmp_dir}/{k}") for k in ("plain", "range", "z")}
    assert share_read(groups["plain"], 0, day) == share_read(groups["plain"], 1, 20) == 1
    assert share_read(groups["range"], 0, day) <= 0.08      # one day of 64
    assert share_read(groups["range"], 1, 20) > 0.5         # a product is on every day
    assert share_read(groups["z"], 0, day) <= 0.35 and share_read(groups["z"], 1, 20) <= 0.35
    both = [g for g in groups["z"] if g[0][0] <= day <= g[0][1] and g[1][0] <= 20 <= g[1][1]]
    assert len(both) / len(groups["z"]) <= 0.08


def test_a_hot_value_is_cut_into_several_ranges(spark):
    hot = (F.col("order_number") % 3 == 0)
    fact = some_fact(spark, 30_000).withColumn("product_id", F.when(hot, F.lit(7)).otherwise(F.col("product_id")))
    fact = fact.withColumn("order_date", F.when(hot, F.lit(date(2024, 1, 5))).otherwise(F.col("order_date")))
    for interleave in (False, True):
        out = clustered(fact, ["order_date", "product_id"], 12, interleave=interleave)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 12 and max(sizes) < 2 * 30_000 / 12
        assert out.columns == fact.columns


def test_rows_move_without_the_columns_that_place_them(spark):
    fact = some_fact(spark, 2_000)
    for interleave in (False, True):
        out = clustered(fact, ["order_date", "product_id"], 4, interleave=interleave)
        plan, moved = out._jdf.queryExecution().optimizedPlan(), []
        while plan.children().size():
            if plan.nodeName() == "RepartitionByExpression":
                moved = [plan.output().apply(i).name() for i in range(plan.output().size())]
            plan = plan.children().apply(0)
        assert moved and set(moved) <= set(fact.columns)
        assert bag(out) == bag(fact)


def test_interleaved_bits(spark):
    df = spark.createDataFrame([(0, 0), (3, 0), (0, 3), (3, 3), (None, 3), (1, 2)], "a int, b int")
    got = [r[0] for r in df.select(z_value(df, ["a", "b"], bits=2)).collect()]
    assert got == [0b0000, 0b0101, 0b1010, 0b1111, 0b1010, 0b1001]
    flat = spark.createDataFrame([(None, 5), (None, 5)], "a int, b int")
    assert [r[0] for r in flat.select(z_value(flat, ["a", "b"])).collect()] == [0, 0]
    with pytest.raises(TypeError):
        text = spark.createDataFrame([("x",)], "a string")
        z_value(text, ["a"])


def test_completeness_without_a_scan(spark, make_raw, tmp_dir):
    process_batch(make_raw([raw_row(1.0, date="bad"), raw_row(2.0)]), 0, tmp_dir)
    process_batch(make_raw([raw_row(3.0, quantity=None, product="Cup"), raw_row(4.0)]), 1, tmp_dir)
    columns = DIM_COMPLETENESS_COLUMNS + FACT_COMPLETENESS_COLUMNS
    whole = bag(completeness({t: read_table(spark, tmp_dir, t) for t in C.STAR}, columns))
    assert bag(completeness_so_far(spark, tmp_dir)) == whole
    compact(spark, tmp_dir, "fact_orders")
    compact(spark, tmp_dir, "dim_prod", cluster_by=["product_id"])
    assert len(StarLog(spark, tmp_dir).latest().parts("fact_orders")) == 1
    assert bag(completeness_so_far(spark, tmp_dir)) == whole
    plan = completeness_so_far(spark, tmp_dir)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan


def test_a_batch_is_cached_once(spark, make_raw, tmp_dir, monkeypatch):
    kept, batch = [], make_raw([raw_row(1.0), raw_row(2.0, customer="Al Bo"), raw_row(None)])
    persist = type(batch).persist
    monkeypatch.setattr(type(batch), "persist", lambda df, *a: kept.append(df) or persist(df, *a))
    assert process_batch(batch, 0, tmp_dir) == {"read": 3, "loaded": 2, "rejected": 1}
    assert len(kept) == 1 and read_fact(spark, tmp_dir).count() == 2


def test_distinct_keys_are_counted_load_by_load(spark, make_raw, tmp_dir, monkeypatch):
    read, plain = [], incremental.new_keys
    monkeypatch.setattr(incremental, "new_keys", lambda log, before, own: (
        read.append(sum(p.may_share_keys(o) for p in before for o in own)), plain(log, before, own))[1])

    def load(k, *numbers, **options):
        process_batch(make_raw([raw_row(float(n), customer=f"C {n}") for n in numbers]), k, tmp_dir, **options)

    load(0, 1, 2, 2, 9, track_keys=True)
    load(1, 100, 101, 100, track_keys=True)   # its range meets no other's: no key is looked up
    load(2, 9, 50, 101, 1, track_keys=True)
    got = {r.table_name: (r.row_count, r.distinct_keys) for r in key_uniqueness_so_far(spark, tmp_dir).collect()}
    assert got["fact_orders"] == (11, 6) and got["dim_cust"] == (6, 6) and got["dim_prod"] == (1, 1)
    assert read == [0, 0, 2]
    assert got == {t: (df.count(), df.select(C.STAR[t].primary_key).distinct().count())
                   for t, df in ((t, read_table(spark, tmp_dir, t)) for t in C.STAR)}
    compact(spark, tmp_dir, "fact_orders")
    load(3, 9, 200, track_keys=True)
    assert key_uniqueness_so_far(spark, tmp_dir).where("table_name = 'fact_orders'").first().distinct_keys == 7
    load(4, 7)  # not counted
    with pytest.raises(ValueError, match="fact_orders"):
        key_uniqueness_so_far(spark, tmp_dir)
    publish_star(spark, read_star(spark, tmp_dir), f"{tmp_dir}/b", track_keys=True)
    assert key_uniqueness_so_far(spark, f"{tmp_dir}/b").where("table_name = 'fact_orders'").first()[2:] == (14, 8)
