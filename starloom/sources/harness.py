"""Adapter: the driver's TPC-H-style tables -> the 14-column raw order extract.

The test tables hold no nulls and no orphan keys, so defects are injected by
arithmetic on the line key, identically in Spark and in the SQL oracle:

clean adapter
  * Order_Number is NULL when (l_orderkey + l_linenumber) % 97 = 0
dirty adapter (adds, with h = l_orderkey * 7 + l_linenumber)
  * h % 89 = 0  -> NULL Customer_Name
  * h % 103 = 0 -> Order_Date '31/02/2024' (impossible date)
  * h % 107 = 0 -> NULL Order_Date
  * h % 83 = 0  -> Status 'Returned' (no description)
  * h % 79 = 0  -> NULL Cost
  * h % 113 = 0 -> Quantity 0
  * h % 101 = 0 -> Total_Sales 0; h % 109 = 0 -> NULL; h % 127 = 0 -> negative

Every input row is kept; nothing here filters or samples.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import RAW_COLUMNS

# State code by c_nationkey % 5 (TN and GA are also US codes,
# TX is not an Indian code and so never resolves).
STATE_CODES = ["AP", "TN", "MH", "GA", "TX"]


# The columns the adapter reads, with their types. A reader given the schema
# skips the footer-reading inference job and reads only these columns.
SOURCE_SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, "
                "l_linestatus string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int",
    "part": "p_partkey bigint, p_name string, p_type string, p_brand string, "
            "p_retailprice double",
    "supplier": "s_suppkey bigint, s_name string",
}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the extract before any defect: the line's key and the raw columns but the order number."""
    li = _read(spark, sf_dir, "lineitem")
    o = _read(spark, sf_dir, "orders")
    c = _read(spark, sf_dir, "customer")
    p = _read(spark, sf_dir, "part")
    s = _read(spark, sf_dir, "supplier")
    # A small file with one row group is one scan task; everything up to the
    # next shuffle would run on one core. Spread it round-robin (immune to key
    # skew) only then: a large input already has many more splits than cores.
    cores = spark.sparkContext.defaultParallelism
    if li.rdd.getNumPartitions() < cores:
        li = li.repartition(cores)

    # What depends on one table alone is computed there, before the joins repeat its rows.
    o = o.select("o_orderkey", "o_custkey", "o_orderstatus",
                 F.date_format(F.col("o_orderdate").cast("date"), "dd/MM/yyyy").alias("order_date"))
    c = c.select("c_custkey", F.regexp_replace("c_name", "#", " ").alias("customer_name"),
                 F.element_at(F.array(*[F.lit(x) for x in STATE_CODES]),
                              (F.col("c_nationkey") % 5 + 1).cast("int")).alias("state_code"))
    s = s.select("s_suppkey", F.regexp_replace("s_name", "#", " ").alias("supervisor"))

    # Plain inner equi-joins; Catalyst picks broadcast or sort-merge from the
    # scan statistics and AQE re-plans at runtime. Customers join the orders, of
    # which there are fewer than lines; parts, whose texts are the widest, come late.
    base = (li.join(o.join(c, o.o_custkey == c.c_custkey), li.l_orderkey == o.o_orderkey)
              .join(s, li.l_suppkey == s.s_suppkey)
              .join(p, li.l_partkey == p.p_partkey))

    status = (F.when(F.col("o_orderstatus") == "O", "Order")
               .when(F.col("o_orderstatus") == "P", "Processing")
               .when(F.col("l_linestatus") == "O", "Shipped")
               .otherwise("Delivered"))
    total_sales = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    cols = {
        "State_Code": F.col("state_code"),
        "Customer_Name": F.col("customer_name"),
        "Order_Date": F.col("order_date"),
        "Status": status,
        "Product": F.col("p_name"),
        "Category": F.col("p_type"),
        "Brand": F.col("p_brand"),
        "Cost": F.col("p_retailprice"),
        "Sales": F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")),
        "Quantity": F.col("l_quantity"),
        "Total_Cost": F.col("p_retailprice") * F.col("l_quantity"),
        "Total_Sales": total_sales,
        "Assigned Supervisor": F.col("supervisor"),
    }
    return base.select("l_orderkey", "l_linenumber", *[c.alias(name) for name, c in cols.items()])


def with_defects(lines: DataFrame, dirty: bool = False) -> DataFrame:
    """The extract made of :func:`joined_lines`. A projection, so that rows stored once serve both extracts."""
    cols = {name: F.col(f"`{name}`") for name in RAW_COLUMNS if name != "Order_Number"}
    cols["Order_Number"] = F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 97 != 0,
                                  F.col("l_orderkey").cast("double"))
    if dirty:
        total_sales = cols["Total_Sales"]
        h = F.col("l_orderkey") * 7 + F.col("l_linenumber")
        cols["Customer_Name"] = F.when(h % 89 != 0, cols["Customer_Name"])
        cols["Order_Date"] = (F.when(h % 103 == 0, F.lit("31/02/2024"))
                               .when(h % 107 == 0, F.lit(None).cast("string"))
                               .otherwise(cols["Order_Date"]))
        cols["Status"] = F.when(h % 83 == 0, F.lit("Returned")).otherwise(cols["Status"])
        cols["Cost"] = F.when(h % 79 != 0, cols["Cost"])
        cols["Quantity"] = F.when(h % 113 == 0, F.lit(0.0)).otherwise(cols["Quantity"])
        cols["Total_Sales"] = (F.when(h % 101 == 0, F.lit(0.0))
                                .when(h % 109 == 0, F.lit(None).cast("double"))
                                .when(h % 127 == 0, -total_sales)
                                .otherwise(total_sales))
    return lines.select(*[cols[name].alias(name) for name in RAW_COLUMNS])


def orders_from_tables(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return with_defects(joined_lines(spark, sf_dir), dirty)
