"""Binding of the driver's TPC-H-style tables to the raw flight fact.

The reference reads one wide CSV; the driver ships a star schema instead, so
the fact is assembled by joins (the same expressions, word for word, are used
by the DuckDB oracle in ``plans/oracle.py``):

* RowKey              order, line, part, supplier, price in cents and ship date: one row each
* ScheduledRoute      supplier nation name ``-`` customer nation name
* AircraftTypeGroup   p_type (three of them as NG, Max, Airbus); Carrier = c_mktsegment; AOCDescription = l_returnflag
* DepartureScheduled  l_shipdate + (l_partkey % 24) hours
* Burnoff             (l_extendedprice - 1000) / 10
* Freight             nullif(l_discount, 0)
* passengers          l_quantity adults, l_linenumber children, 0 infants; capacity p_size + 10
* times               BlockTimeScheduled 60 + l_partkey % 180 min; PlannedTripTime (block - 20) * 60 s
* weights             TOW 40000 + p_retailprice * l_quantity / 10;
                      ZFW TOW - 3000 - l_quantity * 100; ramp TOW + l_tax * 10000

Scale notes: lineitem, orders, part, supplier and customer all grow with the
scale factor. Each dimension is broadcast only if its files are small
(``file_broadcast`` looks at the listing and runs no job); above the bound it
is a shuffle join, which is what a 100 TB run gets. orders is first reduced to
the two columns needed and joined to customer (orders is 4x smaller than
lineitem), so lineitem is shuffled at most once per dimension key, in
partitions whose number follows lineitem's bytes. nation
(25 rows by definition) goes through the same check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..operators.sizing import BROADCAST_BYTES, file_broadcast, scan_bytes
from ..session import ensure_parallelism

RAW_COLUMNS = [
    "RowKey", "OrderKey", "ScheduledRoute", "DepartureScheduled", "ArrivalScheduled",
    "AircraftTypeGroup", "Carrier", "AOCDescription", "AircraftCapacity",
    "Adults", "Children", "Infants", "Freight", "BlockTimeScheduled",
    "PlannedTripTime", "PlannedTOW", "PlannedZeroFuelWeight",
    "TeledyneRampWeight", "Burnoff",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def aircraft_type(p_type: Column) -> Column:
    out = p_type
    for part, name in C.TYPE_NAMES.items():
        out = F.when(p_type == part, name).otherwise(out)
    return out


#: Columns of the driver tables that a flight is made of, beside its type and nations.
SOURCE_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_shipdate", "p_size", "p_retailprice", "c_mktsegment",
]

# File bytes of lineitem in a partition that is joined by order: its rows are sorted in memory there.
JOIN_BYTES = 6 * 1024 * 1024


def raw_columns() -> dict[str, Column]:
    """The raw fact's columns over the joined tables, in their order."""
    block = (F.lit(60) + F.col("l_partkey") % 180).cast("double")
    tow = F.lit(40000.0) + F.col("p_retailprice") * F.col("l_quantity") / 10
    dep = F.col("l_shipdate") + F.make_interval(hours=(F.col("l_partkey") % 24).cast("int"))
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    return {
        "RowKey": F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", cents, F.date_format("l_shipdate", "yyyy-MM-dd")),
        "OrderKey": F.col("l_orderkey"),
        "ScheduledRoute": F.concat(F.col("sn_name"), F.lit("-"), F.col("cn_name")),
        "DepartureScheduled": dep,
        "ArrivalScheduled": dep + F.make_interval(mins=block.cast("int")),
        "AircraftTypeGroup": aircraft_type(F.col("p_type")),
        "Carrier": F.col("c_mktsegment"),
        "AOCDescription": F.col("l_returnflag"),
        "AircraftCapacity": F.col("p_size") + 10,
        "Adults": F.col("l_quantity").cast("int"),
        "Children": F.col("l_linenumber"),
        "Infants": F.lit(0),
        "Freight": F.when(F.col("l_discount") != 0, F.col("l_discount")),
        "BlockTimeScheduled": block,
        "PlannedTripTime": (block - 20) * 60,
        "PlannedTOW": tow,
        "PlannedZeroFuelWeight": tow - 3000 - F.col("l_quantity") * 100,
        "TeledyneRampWeight": tow + F.col("l_tax") * 10000,
        "Burnoff": (F.col("l_extendedprice") - 1000) / 10,
    }


def joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem with its part, supplier, order and customer: ``SOURCE_COLUMNS``, the part's
    type and both nations' names. Where the orders are too many to broadcast, both sides of their
    join are cut by order into as many partitions as lineitem's files have
    ``JOIN_BYTES``, so that a partition is sorted in memory whatever the input's size."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size", "p_retailprice")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    nation = file_broadcast(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))

    small_oc = scan_bytes(orders) + scan_bytes(cust) <= BROADCAST_BYTES
    cust = file_broadcast(cust)
    oc = orders.join(cust, orders.o_custkey == cust.c_custkey).select("o_orderkey", "c_mktsegment", "c_nationkey")
    part = file_broadcast(part)
    supp = file_broadcast(supp)
    if small_oc:
        li = ensure_parallelism(li, "l_orderkey")
        oc = F.broadcast(oc)  # one row per order
    else:
        n = max(2 * spark.sparkContext.defaultParallelism, -(-scan_bytes(li, None) // JOIN_BYTES))
        li, oc = li.repartition(n, "l_orderkey"), oc.repartition(n, "o_orderkey")
    return (
        li.join(oc, li.l_orderkey == oc.o_orderkey)
        .join(part, F.col("l_partkey") == part.p_partkey)
        .join(supp, F.col("l_suppkey") == supp.s_suppkey)
        .join(sn, F.col("s_nationkey") == sn.sn_key)
        .join(cn, F.col("c_nationkey") == cn.cn_key)
        .select(*SOURCE_COLUMNS, "p_type", "sn_name", "cn_name")
    )


def raw_fact(spark: SparkSession, sf_dir: str, with_source: bool = False) -> DataFrame:
    """The flight fact; ``with_source`` keeps the source columns beside it."""
    keep = SOURCE_COLUMNS if with_source else []
    return joined(spark, sf_dir).select(*[e.alias(c) for c, e in raw_columns().items()], *keep)
