"""Writers and write strategies, read back after writing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.functions import keys, numbers
from meterlane.functions.times import within
from meterlane.operators import merging, unions
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.stand_ins import Data
from meterlane.session import new_path
from meterlane.sinks import tables, versioned
from meterlane.sources import cursor, files


def table_name(data: Data, label: str) -> str:
    return f"{label}_{new_path(data.spark, 't').rsplit('-', 1)[1]}"


def file_count(frame: DataFrame) -> DataFrame:
    counted = files.rows_per_file(frame)
    return counted.agg(F.count("*").alias("files"), F.sum("n").alias("n"))


@query("repartition_write", "SELECT CAST(6 AS BIGINT) AS files, count(*) AS n FROM lineitem")
def repartition_write(data: Data):
    path = new_path(data.spark, "six-files")
    tables.write_files(data.table("lineitem"), path, 6)
    return file_count(data.spark.read.parquet(path))


@query("coalesce_write", "SELECT CAST(1 AS BIGINT) AS files, CAST(count(DISTINCT o_orderpriority) AS BIGINT) AS n FROM orders")
def coalesce_write(data: Data):
    path = new_path(data.spark, "report")
    tables.write_report(data.table("orders").groupBy("o_orderpriority").count(), path)
    return file_count(data.spark.read.parquet(path))


@query("partitioned_write_readback", """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2
 ELSE o_totalprice END AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS year,
 CAST(month(o_orderdate) AS INTEGER) AS month FROM orders""")
def partitioned_write_readback(data: Data):
    path = new_path(data.spark, "lake")
    orders = data.table("orders").select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                                         F.month("o_orderdate").alias("month"))
    tables.write_partitioned(orders, path, ["year", "month"])
    # A second run for one year replaces that year's partitions and no others.
    again = orders.filter("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    tables.write_partitioned(again, path, ["year", "month"])
    return data.spark.read.parquet(path)


@query("csv_to_parquet", "SELECT event_id, ts, event_type FROM events")
def csv_to_parquet(data: Data):
    landed, lake = new_path(data.spark, "landed"), new_path(data.spark, "lake")
    events = data.events().select("event_id", "ts", "event_type")
    events.write.options(header=True, **files.EXACT_TIMES).csv(landed)
    typed = files.typed_csv(data.spark, landed, "event_id bigint, ts timestamp_ntz, event_type string",
                            **files.EXACT_TIMES)
    tables.write_files(typed, lake, 4)
    return data.spark.read.parquet(lake)


@query("ctas", "SELECT o_orderkey, o_orderdate, o_totalprice FROM orders")
def ctas(data: Data):
    name = table_name(data, "ctas")
    tables.create_table(data.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice"), name,
                        new_path(data.spark, "ctas"))
    return data.spark.table(name)


@query("daily_partition_prune", "SELECT count(*) AS n, count(DISTINCT user_id) AS users FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'")
def daily_partition_prune(data: Data):
    path = new_path(data.spark, "daily")
    tables.write_partitioned(data.events().withColumn("day", F.to_date("ts")), path, ["day"])
    day = data.spark.read.parquet(path).filter(F.col("day") == F.lit("2024-01-10").cast("date"))
    return day.agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("partition_cluster_count", """SELECT count(*) AS n FROM events WHERE ts >= '2024-01-05' AND ts < '2024-01-20' AND user_id = 17""")
def partition_cluster_count(data: Data):
    path = new_path(data.spark, "clustered")
    days = data.events().withColumn("day", F.to_date("ts"))
    tables.write_partitioned(days, path, ["day"], cluster=["user_id"])
    read = data.spark.read.parquet(path).filter("day >= DATE '2024-01-05' AND day < DATE '2024-01-20'")
    return read.filter("user_id = 17").agg(F.count("*").alias("n"))


@query("bucketed_join", f"""SELECT o_orderstatus, count(*) AS n, {sqltext.total('l_extendedprice', 2)} AS revenue
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""")
def bucketed_join(data: Data):
    # Both tables are stored in buckets of the join key, so the join itself moves nothing.
    lines, orders = table_name(data, "lines"), table_name(data, "orders")
    buckets = int(data.spark.conf.get("spark.sql.shuffle.partitions"))
    for name, key, frame in ((lines, "l_orderkey", data.table("lineitem").select("l_orderkey", "l_extendedprice")),
                             (orders, "o_orderkey", data.table("orders").select("o_orderkey", "o_orderstatus"))):
        tables.create_bucketed(frame, name, new_path(data.spark, "bucketed"), key, buckets)
    joined = data.spark.table(lines).join(data.spark.table(orders).hint("merge"),
                                          F.col("l_orderkey") == F.col("o_orderkey"))
    grouped = joined.groupBy("o_orderstatus").agg(F.count("*").alias("n"), numbers.total("l_extendedprice").alias("revenue"))
    return numbers.rounded(grouped, 2, "revenue")


@query("create_if_absent", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def create_if_absent(data: Data):
    name, path = table_name(data, "staging"), new_path(data.spark, "staging")
    columns = "event_id BIGINT, event_type STRING, value DOUBLE"
    tables.create_if_absent(data.spark, name, columns, path)
    data.events().select("event_id", "event_type", "value").write.insertInto(name)
    # The second call finds the table and leaves its rows alone.
    return tables.create_if_absent(data.spark, name, columns, path).groupBy("event_type").agg(F.count("*").alias("n"))


@query("lake_to_table_load", "SELECT count(*) AS n_source, count(*) AS n_table, true AS verified FROM orders")
def lake_to_table_load(data: Data):
    lake, name = new_path(data.spark, "lake"), table_name(data, "loaded")
    data.table("orders").write.partitionBy("o_orderstatus").parquet(lake)
    source = data.spark.read.parquet(f"{lake}/*")
    tables.create_table(source, name, new_path(data.spark, "loaded"))
    wanted = source.agg(F.count("*").alias("n_source"))
    loaded = data.spark.table(name).agg(F.count("*").alias("n_table"))
    return wanted.withColumn("n_table", loaded.scalar()).withColumn("verified", F.expr("n_source = n_table"))


CUSTOMER = "SELECT c_custkey, c_name, c_mktsegment FROM customer"


def customers(data: Data) -> DataFrame:
    return data.table("customer").select("c_custkey", "c_name", "c_mktsegment")


@query("load_replace", CUSTOMER)
def load_replace(data: Data):
    path = new_path(data.spark, "replace")
    versioned.load(customers(data), path)
    return versioned.load(customers(data), path)


@query("load_append", f"{CUSTOMER} UNION ALL {CUSTOMER} WHERE c_nationkey < 12")
def load_append(data: Data):
    path = new_path(data.spark, "append")
    versioned.load(customers(data), path)
    again = data.table("customer").filter("c_nationkey < 12").select("c_custkey", "c_name", "c_mktsegment")
    return versioned.load(again, path, "append")


LINE_KEY = ("l_orderkey", "l_linenumber", "l_shipdate")
HASHED = """h AS (SELECT md5(coalesce(CAST(l_orderkey AS VARCHAR), '') || coalesce(CAST(l_linenumber AS VARCHAR), '')
 || coalesce(strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), '')) AS unique_row_id, l_returnflag, l_linestatus, l_quantity FROM lineitem)"""


@query("merge_insert_only", f"""WITH {HASHED}, t AS (SELECT * FROM h WHERE l_returnflag <> 'R'),
 s AS (SELECT * FROM h WHERE l_returnflag <> 'A')
 SELECT * FROM t UNION ALL SELECT * FROM s WHERE unique_row_id NOT IN (SELECT unique_row_id FROM t)""")
def merge_insert_only(data: Data):
    hashed = data.table("lineitem").select(keys.row_hash(*LINE_KEY).alias("unique_row_id"),
                                           "l_returnflag", "l_linestatus", "l_quantity")
    path = new_path(data.spark, "insert-only")
    versioned.load(hashed.filter("l_returnflag <> 'R'"), path)
    return versioned.load(hashed.filter("l_returnflag <> 'A'"), path, "insert_only", ["unique_row_id"])


def versions(data: Data) -> tuple[DataFrame, DataFrame]:
    """Old rows without one segment; new rows with a changed name and one more column."""
    old = customers(data).filter("c_mktsegment <> 'MACHINERY'")
    changed = F.when(F.col("c_mktsegment") == "BUILDING", F.upper("c_name")).otherwise(F.col("c_name"))
    new = (customers(data).filter("c_mktsegment IN ('BUILDING', 'MACHINERY')").withColumn("c_name", changed)
           .withColumn("occupation", F.lower("c_mktsegment")))
    return old, new


@query("merge_upsert", """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name,
 c_mktsegment, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN lower(c_mktsegment) END AS occupation FROM customer""")
def merge_upsert(data: Data):
    old, new = versions(data)
    path = new_path(data.spark, "merge")
    versioned.load(old, path)
    versioned.load(new, path, "merge", ["c_custkey"])
    return versioned.load(new, path, "merge", ["c_custkey"])


@query("merge_by_partition", """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 1997 THEN 'merged' ELSE o_orderstatus END AS status,
 CAST(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def merge_by_partition(data: Data):
    path = new_path(data.spark, "merge-partitions")
    orders = data.table("orders").select("o_orderkey", F.col("o_orderstatus").alias("status"),
                                         F.year("o_orderdate").alias("year"))
    tables.write_partitioned(orders.filter("NOT (year = 1997 AND status = 'P')"), path, ["year"])
    fresh = orders.filter("year = 1997").withColumn("status", F.lit("merged"))
    return tables.merge_partitions(fresh, path, ["o_orderkey", "year"], "year")


INTERVAL_SQL = """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate >= '1997-03-01' AND o_orderdate < '1997-04-01'
 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders
 WHERE NOT (o_orderdate >= '1997-03-01' AND o_orderdate < '1997-04-01' AND o_orderstatus = 'P')"""


@query("load_time_interval", INTERVAL_SQL)
def load_time_interval(data: Data):
    # The month is run again: prices changed, and one status is no longer delivered.
    target = data.table("orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    rerun = (data.table("orders").filter("o_orderstatus <> 'P'").select("o_orderkey", "o_orderdate", "o_totalprice")
             .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    path = new_path(data.spark, "interval")
    # Sorted by time, so that an interval lies in few files.
    versioned.load(target.repartitionByRange(8, "o_orderdate"), path)
    inside = within("o_orderdate", "1997-03-01", "1997-04-01")
    for _ in range(2):
        table = versioned.replace_where(rerun, path, inside)
    return table


@query("load_replace_days", """SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, event_type FROM events
 WHERE NOT (CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-12'
            AND (event_type = 'error' OR CAST(ts AS DATE) = DATE '2024-01-11'))""")
def load_replace_days(data: Data):
    path = new_path(data.spark, "days")
    events = data.events().select("event_id", "event_type", F.to_date("ts").alias("day"))
    tables.write_partitioned(events, path, ["day"])
    rerun = events.filter("event_type <> 'error' AND day <> DATE '2024-01-11'")
    replaced = tables.replace_days(rerun, path, "day", "2024-01-08", "2024-01-12")
    return replaced.withColumn("day", F.col("day").cast("string"))


@query("load_delete_insert", """SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_orderkey NOT IN
 (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
 UNION ALL SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag = 'R'""")
def load_delete_insert(data: Data):
    path = new_path(data.spark, "delete-insert")
    lines = data.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    versioned.load(lines, path)
    for _ in range(2):
        table = versioned.delete_insert(lines.filter("l_returnflag = 'R'"), path, ["l_orderkey"])
    return table


@query("incremental_hwm", """SELECT o_orderkey, o_orderdate, CASE WHEN o_orderdate > (SELECT max(o_orderdate) FROM orders
 WHERE o_orderdate < '1999-01-01') THEN 'second' ELSE 'first' END AS load_run FROM orders""")
def incremental_hwm(data: Data):
    path = new_path(data.spark, "hwm")
    orders = data.table("orders").select("o_orderkey", "o_orderdate")
    early = orders.filter(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz"))
    versioned.load(early.withColumn("load_run", F.lit("first")), path)
    return versioned.load_newer(orders.withColumn("load_run", F.lit("second")), path, "o_orderdate", ["o_orderkey"])


@query("incremental_cursor", """SELECT 1 AS run, count(*) AS loaded FROM events WHERE ts >= '2024-01-10'
 UNION ALL SELECT 2, CAST(0 AS BIGINT)""")
def incremental_cursor(data: Data):
    target, state = new_path(data.spark, "cursor-target"), new_path(data.spark, "cursor-state")
    runs = [cursor.load_since_cursor(data.events(), target, state, "events", "ts", ["event_id"], "2024-01-10")
            for _ in range(2)]
    stored = data.spark.read.parquet(target)
    counts = [(1, runs[0] if stored.count() == sum(runs) else -1), (2, runs[1])]
    return data.spark.createDataFrame(counts, "run int, loaded long")


@query("evolve_columns", """SELECT event_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS value FROM events""")
def evolve_columns(data: Data):
    events = data.events()
    first = events.filter("event_type <> 'purchase'").select("event_id", "event_type")
    second = events.filter("event_type = 'purchase'").select("event_id", "event_type", "value")
    path = new_path(data.spark, "evolve")
    versioned.load(first, path)
    return versioned.load(second, path, "append")


@query("full_refresh", f"{CUSTOMER} WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def full_refresh(data: Data):
    path = new_path(data.spark, "refresh")
    versioned.load(customers(data), path)
    some = customers(data).filter("c_mktsegment IN ('BUILDING', 'MACHINERY')")
    return versioned.load(some, path, "merge", ["c_custkey"], full_refresh=True)


@query("backfill_missing_months", """SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n,
 CASE WHEN year(o_orderdate) = 1996 THEN 'old' ELSE 'backfill' END AS written_by FROM orders GROUP BY 1, 3""")
def backfill_missing_months(data: Data):
    path = new_path(data.spark, "backfill")
    orders = data.table("orders").select("o_orderkey", "o_orderdate",
                                         F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    old = orders.filter(within("o_orderdate", "1996-01-01", "1997-01-01")).withColumn("written_by", F.lit("old"))
    tables.write_partitioned(old, path, ["month"])
    read = data.spark.read.option("partitionInference", False).parquet(path)
    done = read.select(F.col("month").cast("string").alias("month"))
    everything = tables.backfill(orders.withColumn("written_by", F.lit("backfill")), path, "month", done)
    return everything.groupBy(F.col("month").cast("string").alias("month"), "written_by").agg(F.count("*").alias("n"))


SCD_SQL = """WITH d AS (SELECT unnest([1, 2, 3]) AS n),
 s AS (SELECT c_custkey, c_name, n, CASE WHEN n > 1 AND c_mktsegment = 'BUILDING' AND (n = 2 OR c_nationkey < 12) THEN 'HOUSING'
 ELSE c_mktsegment END AS c_mktsegment, NOT (n = 1 AND c_mktsegment = 'MACHINERY' OR n = 2 AND c_mktsegment = 'FURNITURE') AS here
 FROM customer, d),
 c AS (SELECT *, make_timestamp(2024, n, 1, 0, 0, 0) AS at, here AND NOT coalesce(lag(here) OVER w AND lag(c_mktsegment) OVER w = c_mktsegment, false) AS opened,
 NOT here OR lag(c_mktsegment) OVER w IS DISTINCT FROM c_mktsegment AS differs FROM s WINDOW w AS (PARTITION BY c_custkey ORDER BY n))
 SELECT a.c_custkey, any_value(a.c_name) AS c_name, any_value(a.c_mktsegment) AS c_mktsegment, a.at AS valid_from, min(b.at) AS valid_to
 FROM c AS a LEFT JOIN c AS b ON a.c_custkey = b.c_custkey AND b.n > a.n AND b.differs WHERE a.opened GROUP BY a.c_custkey, a.at"""


@query("scd2_snapshot", SCD_SQL)
def scd2_snapshot(data: Data):
    path = new_path(data.spark, "history")
    source = data.table("customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    housing = F.when(F.col("c_mktsegment") == "BUILDING", "HOUSING").otherwise(F.col("c_mktsegment"))
    partly = F.when(F.col("c_nationkey") < 12, housing).otherwise(F.col("c_mktsegment"))
    deliveries = (source.filter("c_mktsegment <> 'MACHINERY'"),
                  source.filter("c_mktsegment <> 'FURNITURE'").withColumn("c_mktsegment", housing),
                  source.withColumn("c_mktsegment", partly))
    for month, delivery in enumerate(deliveries, 1):
        at = F.lit(f"2024-{month:02}-01").cast("timestamp_ntz")
        table = versioned.load_history(delivery, path, "c_custkey", ["c_name", "c_mktsegment"], at)
    return table


@query("materialize_view_table", "SELECT 'view' AS kind, count(*) AS n FROM orders UNION ALL SELECT 'table', count(*) FROM orders")
def materialize_view_table(data: Data):
    view, table = table_name(data, "v"), table_name(data, "t")
    data.table("orders").createOrReplaceTempView(view)
    tables.create_table(data.spark.table(view), table, new_path(data.spark, "materialized"))
    counts = [data.spark.table(name).agg(F.lit(kind).alias("kind"), F.count("*").alias("n"))
              for kind, name in (("view", view), ("table", table))]
    return reduce(unions.stacked, counts)
