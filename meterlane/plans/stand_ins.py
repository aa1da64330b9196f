"""Trip, zone and event tables built from the tables at hand.

A trip is an order line: ordered = picked up, shipped = dropped off, the nations of
customer and supplier are the zones. Only the tables that hold a requested column
are joined. The ``*_SQL`` texts say the same for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = {
    "order_key": lambda: F.col("l_orderkey"),
    "vendor_id": lambda: F.col("l_linestatus"),
    "vendor_code": lambda: F.nullif(F.col("l_linenumber") % 5, F.lit(0)),
    "dropoff": lambda: F.col("l_shipdate"),
    "passenger_count": lambda: F.col("l_linenumber"),
    "distance": lambda: F.col("l_quantity"),
    "fare": lambda: F.col("l_extendedprice"),
    "tip": lambda: F.col("l_extendedprice") * F.col("l_discount"),
    "tax": lambda: F.col("l_tax"),
    "extra": lambda: F.col("l_discount"),
    "tolls": lambda: F.col("l_extendedprice") * F.col("l_tax"),
    "surcharge": lambda: F.col("l_quantity") * F.col("l_discount"),
    "total": lambda: F.col("l_extendedprice") + F.col("l_extendedprice") * F.col("l_discount"),
    "payment_type": lambda: F.col("l_returnflag"),
    "payment_code": lambda: F.when(F.col("l_returnflag") == "A", 1).when(F.col("l_returnflag") == "N", 2),
    "part_key": lambda: F.col("l_partkey"),
    "supp_key": lambda: F.col("l_suppkey"),
}
ORDER = {
    "pickup": lambda: F.col("o_orderdate"),
    "service_type": lambda: F.col("o_orderstatus"),
    "priority": lambda: F.col("o_orderpriority"),
}
CUSTOMER = {"pickup_id": lambda: F.nullif(F.col("c_nationkey"), F.lit(0))}
SUPPLIER = {"dropoff_id": lambda: F.nullif(F.col("s_nationkey"), F.lit(0))}

TRIPS_SQL = """trips AS (
  SELECT l_orderkey AS order_key, l_linestatus AS vendor_id,
         nullif(l_linenumber % 5, 0) AS vendor_code, l_shipdate AS dropoff,
         l_linenumber AS passenger_count, l_quantity AS distance,
         l_extendedprice AS fare, l_extendedprice * l_discount AS tip, l_tax AS tax,
         l_discount AS extra, l_extendedprice * l_tax AS tolls, l_quantity * l_discount AS surcharge,
         l_extendedprice + l_extendedprice * l_discount AS total,
         l_returnflag AS payment_type,
         CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS payment_code,
         l_partkey AS part_key, l_suppkey AS supp_key,
         o_orderdate AS pickup, o_orderstatus AS service_type, o_orderpriority AS priority,
         nullif(c_nationkey, 0) AS pickup_id, nullif(s_nationkey, 0) AS dropoff_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey)"""
ZONES_SQL = """zones AS (
  SELECT n_nationkey AS location_id, n_name AS zone, r_name AS borough
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""
YELLOW = ("1-URGENT", "2-HIGH", "3-MEDIUM")
IS_YELLOW_SQL = "priority IN ('1-URGENT','2-HIGH','3-MEDIUM')"


class Data:
    """The tables of one folder and the stand-ins over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    def trips(self, *columns: str) -> DataFrame:
        """Trips with the requested columns and no join beyond what they need."""
        wanted = columns or (*LINE, *ORDER, *CUSTOMER, *SUPPLIER)
        rows = self.table("lineitem")
        if any(c in ORDER or c in CUSTOMER for c in wanted):
            # The smaller tables are joined first, so lines are shuffled once for them.
            orders = self.table("orders")
            if any(c in CUSTOMER for c in wanted):
                customers = self.table("customer").select("c_custkey", "c_nationkey")
                orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if any(c in SUPPLIER for c in wanted):
            suppliers = self.table("supplier").select("s_suppkey", "s_nationkey")
            rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        return rows.select(*[_column(c) for c in wanted])

    def zones(self) -> DataFrame:
        return (self.table("nation").join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
                .select(F.col("n_nationkey").alias("location_id"), F.col("n_name").alias("zone"),
                        F.col("r_name").alias("borough")))

    def yellow(self, *columns: str) -> DataFrame:
        return self._service(True, columns)

    def green(self, *columns: str) -> DataFrame:
        """As yellow, with two more columns."""
        extra = [F.lit(2).alias("trip_type"), F.col("tax").alias("ehail_fee")]
        wanted = tuple(dict.fromkeys((*columns, "tax")))
        return self._service(False, wanted).select(*columns, *extra)

    def _service(self, yellow: bool, columns: tuple[str, ...]) -> DataFrame:
        wanted = tuple(dict.fromkeys((*columns, "priority")))
        mine = F.col("priority").isin(*YELLOW)
        return self.trips(*wanted).filter(mine if yellow else ~mine).select(*columns)

    def events(self) -> DataFrame:
        return self.table("events")

    def stream(self, table: str) -> DataFrame:
        """The same table as a file stream; the pattern also matches a single file."""
        from meterlane.streaming import sources

        return sources.folder(self.spark, f"{self.path(table)}*", self.table(table).schema)


def _column(name: str) -> Column:
    for group in (LINE, ORDER, CUSTOMER, SUPPLIER):
        if name in group:
            return group[name]().alias(name)
    raise KeyError(name)
