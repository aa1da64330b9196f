"""Readers, each over files that Spark first writes from the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.functions.numbers import half_up, mean
from meterlane.functions.times import within
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.stand_ins import Data
from meterlane.session import new_path
from meterlane.sinks import tables
from meterlane.sources import files
from meterlane.sources.paged import PagedSource

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()), T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()), T.StructField("o_orderpriority", T.StringType())])


def csv(data: Data, frame: DataFrame, label: str, **options) -> str:
    path = new_path(data.spark, label)
    frame.write.options(header=True, **options).csv(path)
    return path


@query("csv_typed_scan", "SELECT * FROM orders")
def csv_typed_scan(data: Data):
    return files.typed_csv(data.spark, csv(data, data.table("orders"), "csv"), ORDERS)


@query("csv_string_scan", """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name,
 CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer""")
def csv_string_scan(data: Data):
    return files.text_csv(data.spark, csv(data, data.table("customer").drop("c_acctbal"), "csv"))


@query("csv_infer_scan", "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def csv_infer_scan(data: Data):
    return files.inferred_csv(data.spark, csv(data, data.table("supplier"), "csv"))


@query("sampled_schema_scan", "SELECT * FROM part")
def sampled_schema_scan(data: Data):
    path = csv(data, data.table("part"), "csv")
    return files.typed_csv(data.spark, path, files.sampled_schema(data.spark, path))


@query("csv_gz_scan", "SELECT * FROM orders")
def csv_gz_scan(data: Data):
    stamp = "dd.MM.yyyy HH:mm"
    path = csv(data, data.table("orders"), "csv-gz", compression="gzip", timestampNTZFormat=stamp)
    return files.typed_csv(data.spark, path, ORDERS, timestampNTZFormat=stamp)


@query("multi_month_scan", """SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, o_orderdate, o_orderpriority FROM orders""")
def multi_month_scan(data: Data):
    path = new_path(data.spark, "months")
    monthly = data.table("orders").select("o_orderkey", "o_orderdate", "o_orderpriority",
                                          F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    tables.rebalanced(monthly, "month").write.partitionBy("month").option("header", True).csv(path)
    schema = "o_orderkey bigint, o_orderdate timestamp_ntz, o_orderpriority string"
    return files.typed_csv(data.spark, f"{path}/month=*", schema)


@query("parquet_scan", """SELECT l_orderkey, l_extendedprice FROM lineitem
 WHERE l_shipdate >= '1997-01-01' AND l_shipdate < '1998-01-01'""")
def parquet_scan(data: Data):
    lines = data.table("lineitem").filter(within("l_shipdate", "1997-01-01", "1998-01-01"))
    return lines.select("l_orderkey", "l_extendedprice")


@query("scan_union_by_name", """SELECT l_orderkey, l_linenumber, CASE WHEN l_linestatus = 'O' THEN l_tax END AS l_tax,
 CASE WHEN l_linestatus = 'F' THEN l_discount END AS l_discount FROM lineitem""")
def scan_union_by_name(data: Data):
    lines, paths = data.table("lineitem"), []
    for status, extra in (("O", "l_tax"), ("F", "l_discount")):
        paths.append(new_path(data.spark, "by-name"))
        lines.filter(F.col("l_linestatus") == status).select("l_orderkey", "l_linenumber", extra).write.parquet(paths[-1])
    return files.parquet_by_name(data.spark, *paths)


@query("json_scan_avg", f"""SELECT p_brand, {sqltext.mean('p_retailprice', 2)} AS avg_price FROM part GROUP BY 1""")
def json_scan_avg(data: Data):
    path = new_path(data.spark, "json")
    data.table("part").select("p_brand", "p_retailprice").write.json(path)
    products = files.json_documents(data.spark, path)
    return products.groupBy("p_brand").agg(half_up(mean("p_retailprice")).alias("avg_price"))


@query("jsonl_scan", "SELECT event_id, ts, user_id, event_type, value FROM events")
def jsonl_scan(data: Data):
    path = new_path(data.spark, "jsonl")
    data.events().drop("props").write.options(**files.EXACT_TIMES).json(path)
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"
    return files.json_documents(data.spark, path, schema, **files.EXACT_TIMES)


PAGE_ROWS = 1000


@query("paged_source", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def paged_source(data: Data):
    orders = data.table("orders").select("o_orderkey", "o_custkey", "o_totalprice")
    pages = orders.count() // PAGE_ROWS + 1
    path = new_path(data.spark, "pages")
    page = (F.pmod(F.xxhash64("o_orderkey"), F.lit(pages)) + 1).cast("int")
    tables.rebalanced(orders.withColumn("page", page), "page").write.partitionBy("page").json(path)
    data.spark.dataSource.register(PagedSource)
    readers = data.spark.sparkContext.defaultParallelism
    return data.spark.read.format("pages").schema(orders.schema).option("readers", readers).load(path)


@query("external_vs_native_counts", """SELECT 'external' AS source, count(*) AS n FROM lineitem UNION ALL
 SELECT 'native', count(*) FROM lineitem""")
def external_vs_native_counts(data: Data):
    name = new_path(data.spark, "t").rsplit("-", 1)[1]
    stored = new_path(data.spark, "lake")
    data.table("lineitem").write.parquet(stored)
    external = tables.external_table(data.spark, f"external_{name}", stored)
    tables.create_table(external, f"native_{name}", new_path(data.spark, "native"))
    counts = [frame.agg(F.count("*").alias("n")).select(F.lit(tag).alias("source"), "n")
              for tag, frame in (("external", external), ("native", data.spark.table(f"native_{name}")))]
    return reduce(DataFrame.unionAll, counts)


@query("csv_extra_columns", "SELECT o_orderkey, o_orderpriority FROM orders")
def csv_extra_columns(data: Data):
    path = csv(data, data.table("orders"), "csv")
    wanted = T.StructType.fromDDL("o_orderkey bigint, o_orderpriority string")
    return files.csv_known_columns(data.spark, path, wanted)


@query("filename_lineage", """SELECT 'month=' || strftime(o_orderdate, '%Y-%m') AS folder, count(*) AS n FROM orders GROUP BY 1""")
def filename_lineage(data: Data):
    path = new_path(data.spark, "lineage")
    orders = data.table("orders").withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    tables.rebalanced(orders, "month").write.partitionBy("month").parquet(path)
    read = data.spark.read.parquet(path)
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return read.groupBy(folder.alias("folder")).agg(F.count("*").alias("n"))


@query("schema_listing", """SELECT CAST(row_number() OVER () AS INTEGER) AS ordinal, column_name,
 CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double'
 WHEN 'TIMESTAMP' THEN 'timestamp_ntz' END AS data_type, (SELECT count(*) FROM orders) AS n_rows FROM (DESCRIBE orders)""")
def schema_listing(data: Data):
    orders = data.table("orders")
    listing = files.schema_listing(orders).drop("is_nullable")
    return listing.withColumn("n_rows", orders.agg(F.count("*").alias("n")).scalar())


@query("partition_stats", """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, min(event_id) AS least,
 max(event_id) AS greatest FROM events GROUP BY 1""")
def partition_stats(data: Data):
    path = new_path(data.spark, "days")
    days = data.events().withColumn("day", F.to_date("ts").cast("string"))
    tables.write_partitioned(days, path, ["day"])
    # Read from the files' footers, no data page is opened.
    return files.partition_stats(data.spark.read.parquet(path), "day", "event_id").drop("files", "bytes")


@query("preview_rows", "SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_rows(data: Data):
    return files.preview(data.table("orders"), ["o_orderkey"], 10)
