"""Data-quality reports over the star: completeness and the declared rules.

Every report is a small DataFrame built from aggregations, one scan per table
(all columns of a table in the same pass), never a loop of per-column jobs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import contracts as C
from ..functions.missing import is_missing

# The columns of the completeness report, (column, table).
DIM_COMPLETENESS_COLUMNS = [
    ("customer_id", "dim_cust"), ("customer_name", "dim_cust"),
    ("date_full", "dim_date"), ("employee_id", "dim_emp"),
    ("employee_name", "dim_emp"), ("state_id", "dim_geo"),
    ("state_code", "dim_geo"), ("country", "dim_geo"),
    ("state_name", "dim_geo"), ("iso_code", "dim_geo"),
    ("status_id", "dim_ostatus"), ("status_name", "dim_ostatus"),
    ("product_id", "dim_prod"), ("product_name", "dim_prod"),
    ("category", "dim_prod"), ("brand", "dim_prod"),
    ("standard_cost", "dim_prod"),
]
FACT_COMPLETENESS_COLUMNS = [
    (c, "fact_orders") for c in [
        "order_number", "order_date", "customer_id", "state_id", "product_id",
        "status_id", "employee_id", "unit_cost", "unit_sales", "quantity",
        "total_cost", "total_sales", "profit"]
]

CHECK_SCHEMA = "table_name string, rule string, column_name string, violations bigint"


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _stack(agg_row: DataFrame, labels: list[str], fields: list[list[str]],
           out_names: list[str]) -> DataFrame:
    """Unpivot one aggregate row into one row per label."""
    parts = []
    for label, cols in zip(labels, fields):
        parts.append("'" + label.replace("'", "\\'") + "'")
        parts.extend(f"`{c}`" for c in cols)
    expr = f"stack({len(labels)}, {', '.join(parts)}) as ({', '.join(out_names)})"
    return agg_row.selectExpr(expr)


def completeness(tables: dict[str, DataFrame], columns: list[tuple[str, str]]) -> DataFrame:
    """Per (column, table): non-missing count (``total_records``), missing count,
    ``null_percentage`` = round-half-even(100 * missing / non-missing, 2) (the
    report's own denominator, which can exceed 100) and ``null_share`` =
    the same over all rows. NaN counts as missing on floating columns."""
    by_table: dict[str, list[str]] = {}
    for col, table in columns:
        by_table.setdefault(table, []).append(col)
    frames = []
    for table, cols in by_table.items():
        df = tables[table]
        aggs = []
        for i, c in enumerate(cols):
            miss = is_missing(c, df.schema[c].dataType)
            aggs += [F.count_if(~miss).alias(f"t{i}"), F.count_if(miss).alias(f"n{i}")]
        row = df.agg(*aggs)
        stacked = _stack(row, cols, [[f"t{i}", f"n{i}"] for i in range(len(cols))],
                         ["column_name", "total_records", "null_count"])
        frames.append(stacked.withColumn("table_name", F.lit(table)))
    return _with_shares(_union(frames))


def completeness_of_parts(spark: SparkSession, parts: dict[str, list], columns: list[tuple[str, str]]) -> DataFrame:
    """:func:`completeness` from what was counted when each part of a table was
    written (``rows`` and ``missing`` by column): sums of a few numbers a part,
    and no scan of any table. A column that some part has no count of raises."""
    rows = []
    for col, table in columns:
        unknown = [p.path for p in parts[table] if col not in p.missing]
        if unknown:
            raise ValueError(f"no count of {table}.{col} in {unknown[:3]}")
        gone = sum(p.missing[col] for p in parts[table])
        rows.append((col, table, sum(p.rows for p in parts[table]) - gone, gone))
    return _with_shares(spark.createDataFrame(
        rows, "column_name string, table_name string, total_records long, null_count long"))


def _with_shares(out: DataFrame) -> DataFrame:
    pct = F.bround(F.try_divide(F.col("null_count") * 100.0, F.col("total_records")), 2)
    share = F.bround(F.try_divide(F.col("null_count") * 100.0,
                                  F.col("null_count") + F.col("total_records")), 2)
    return out.select("column_name", "table_name", "total_records", "null_count",
                      pct.alias("null_percentage"), share.alias("null_share"))


def _rule_rows(table: str, rule: str, row: DataFrame, cols: list[str]) -> DataFrame:
    stacked = _stack(row, cols, [[f"v{i}"] for i in range(len(cols))],
                     ["column_name", "violations"])
    return stacked.select(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"),
                          "column_name", F.col("violations").cast("bigint"))


def _row_rules(contract: C.Contract, columns: list[str], kinds: tuple[str, ...]) -> list[tuple]:
    """(rule, column, condition of a violation) of the rules that look at one row."""
    out = []
    if "not_null" in kinds:
        out += [("not_null", c.name, F.col(c.name).isNull()) for c in contract.columns
                if c.not_null and c.name in columns]
    if "range" in kinds:  # a NULL outcome passes, as in SQL
        out += [(rule, None, ~F.expr(pred)) for rule, pred in contract.checks]
    if "max_length" in kinds:  # in bytes, the warehouse's unit
        out += [("max_length", c.name, F.octet_length(c.name) > c.max_bytes) for c in contract.columns
                if c.max_bytes and c.name in columns]
    return out


def rule_name(rule: str, column: str | None) -> str:
    return f"{rule}:{column}" if column else rule


def row_violations(contract: C.Contract, columns: list[str],
                   kinds: tuple[str, ...] = ("not_null", "range", "max_length")) -> Column:
    """The names of the rules that a row breaks, as an array: of a column's rule
    ``rule:column``, of a CHECK its own name. All rules in one projection."""
    return F.array_compact(F.array(*[
        F.when(bad, F.lit(rule_name(rule, column))) for rule, column, bad in _row_rules(contract, columns, kinds)]))


def check_rows(tables: dict[str, DataFrame], contracts: dict[str, C.Contract] = C.STAR,
               kinds: tuple[str, ...] = ("not_null", "range", "max_length")) -> DataFrame:
    """Violations of all rules of the given kinds, in one aggregation per table."""
    frames = []
    for name, df in tables.items():
        rules = _row_rules(contracts[name], df.columns, kinds)
        if not rules:
            continue
        row = df.agg(*[F.count_if(bad).alias(f"v{i}") for i, (_, _, bad) in enumerate(rules)])
        each = F.explode(F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(column).cast("string").alias("column_name"),
                     F.col(f"v{i}").cast("bigint").alias("violations"))
            for i, (rule, column, _) in enumerate(rules)])).alias("r")
        frames.append(row.select(F.lit(name).alias("table_name"), each).select("table_name", "r.*"))
    return _union(frames)


def check_not_null(tables: dict[str, DataFrame],
                   contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """NULLs in NOT NULL columns, one pass per table."""
    return check_rows(tables, contracts, ("not_null",))


def check_primary_key(tables: dict[str, DataFrame],
                      contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """Rows beyond the first for every repeated key value (0 = unique key).
    Partial counts are combined map-side, so a hot key costs one row per task."""
    frames = []
    for name, df in tables.items():
        pk = contracts[name].primary_key
        counts = df.groupBy(pk).agg(F.count(F.lit(1)).alias("n"))
        row = counts.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)),
                                    F.lit(0)).alias("v0"))
        frames.append(_rule_rows(name, "primary_key", row, [pk]))
    return _union(frames)


def check_foreign_keys(tables: dict[str, DataFrame], fact: str = "fact_orders",
                       contracts: dict[str, C.Contract] = C.STAR,
                       sentinel: str = "-1") -> DataFrame:
    """Fact rows whose key has no dimension row.

    ``foreign_key`` counts orphans, ``foreign_key_unassigned`` the sentinel
    rows; NULL keys pass (as in SQL) and are counted by ``not_null``. All six
    keys come from one scan of the fact: each row is unpivoted to (key,
    value), aggregated to distinct values with their row counts (map-side),
    and only those distinct values are anti-joined with the dimension keys.
    """
    fks = contracts[fact].foreign_keys
    names = list(fks)
    pairs = F.explode(F.array(*[
        F.struct(F.lit(k).alias("column_name"), F.col(k).cast("string").alias("value"))
        for k in names]))
    values = (tables[fact].select(pairs.alias("p")).select("p.*")
              .filter(F.col("value").isNotNull())
              .groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n")))
    dim_keys = _union([
        tables[dt].select(F.lit(k).alias("column_name"), F.col(dc).cast("string").alias("value"))
        for k, (dt, dc) in fks.items()])  # an anti-join needs no distinct right side
    orphans = values.join(dim_keys, ["column_name", "value"], "left_anti")
    per_key = orphans.groupBy("column_name").agg(
        F.sum(F.when(F.col("value") != sentinel, F.col("n")).otherwise(0)).alias("foreign_key"),
        F.sum(F.when(F.col("value") == sentinel, F.col("n")).otherwise(0)).alias(
            "foreign_key_unassigned"))
    # every declared key gets a row, also when it has no orphan at all
    spark = tables[fact].sparkSession
    declared = spark.createDataFrame([(k,) for k in names], "column_name string")
    full = declared.join(per_key, "column_name", "left")
    return full.select(
        F.lit(fact).alias("table_name"),
        F.explode(F.array(
            F.struct(F.lit("foreign_key").alias("rule"),
                     F.coalesce("foreign_key", F.lit(0)).cast("bigint").alias("violations")),
            F.struct(F.lit("foreign_key_unassigned").alias("rule"),
                     F.coalesce("foreign_key_unassigned", F.lit(0)).cast("bigint").alias(
                         "violations")))).alias("r"),
        "column_name",
    ).select("table_name", "r.rule", "column_name", "r.violations")


def check_ranges(tables: dict[str, DataFrame],
                 contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """Rows failing each CHECK rule (a NULL outcome passes, as in SQL)."""
    return check_rows(tables, contracts, ("range",))


def check_lengths(tables: dict[str, DataFrame],
                  contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """Values longer than their VARCHAR(n), in bytes (the warehouse's unit)."""
    return check_rows(tables, contracts, ("max_length",))


def check_all(tables: dict[str, DataFrame],
              contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """Every declared rule, one report: three passes of each table (the rules
    that look at one row, primary keys, foreign keys)."""
    return _union([check_rows(tables, contracts), check_primary_key(tables, contracts),
                   check_foreign_keys(tables, contracts=contracts)])


def key_uniqueness(tables: dict[str, DataFrame],
                   contracts: dict[str, C.Contract] = C.STAR) -> DataFrame:
    """Rows and distinct key values per table (equal when the key is unique)."""
    frames = []
    for name, df in tables.items():
        pk = contracts[name].primary_key
        frames.append(df.agg(F.count(F.lit(1)).alias("row_count"),
                             F.count_distinct(pk).alias("distinct_keys"))
                      .select(F.lit(name).alias("table_name"), F.lit(pk).alias("key_column"),
                              "row_count", "distinct_keys"))
    return _union(frames)
