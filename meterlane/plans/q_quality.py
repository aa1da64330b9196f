"""Data checks with planted and real violations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.operators import quality
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import TRIPS
from meterlane.plans.stand_ins import Data


def check_sql(check: str, target: str, failures: str, prefix: str = "") -> str:
    return f"""{prefix} SELECT '{check}' AS "check", '{target}' AS target, failures,
 CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({failures})"""


@query("dq_not_null", f"""{TRIPS} SELECT 'not_null' AS "check", target, failures,
 CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
 SELECT 'order_key' AS target, count(*) FILTER (order_key IS NULL) AS failures FROM trips UNION ALL
 SELECT 'pickup_id', count(*) FILTER (pickup_id IS NULL) FROM trips UNION ALL
 SELECT 'vendor_code', count(*) FILTER (vendor_code IS NULL) FROM trips)""")
def dq_not_null(data: Data):
    columns = ["order_key", "pickup_id", "vendor_code"]
    return quality.not_null(data.trips(*columns), columns)


@query("dq_unique", check_sql("unique", "o_orderkey", "SELECT count(*) AS failures FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)")
       + " UNION ALL " + check_sql("unique", "l_orderkey", "SELECT count(*) AS failures FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)"))
def dq_unique(data: Data):
    return quality.report(quality.unique(data.table("orders"), "o_orderkey"),
                          quality.unique(data.table("lineitem"), "l_orderkey"))


@query("dq_accepted_values", check_sql("accepted_values", "l_returnflag", "SELECT count(*) AS failures FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"))
def dq_accepted_values(data: Data):
    return quality.accepted_values(data.table("lineitem"), "l_returnflag", ["A", "N"])


@query("dq_relationships", check_sql("relationships", "pickup_id", "SELECT count(*) AS failures FROM trips WHERE pickup_id IS NOT NULL AND pickup_id NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)", TRIPS))
def dq_relationships(data: Data):
    known = data.table("nation").filter("n_regionkey <> 2")
    return quality.relationships(data.trips("pickup_id"), "pickup_id", known, "n_nationkey")


@query("dq_unique_combo", check_sql("unique_combination", "l_orderkey,l_linenumber", "SELECT count(*) AS failures FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)"))
def dq_unique_combo(data: Data):
    return quality.unique_combination(data.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_singular", check_sql("singular", "c_acctbal", "SELECT count(*) AS failures FROM customer WHERE c_acctbal <= 0"))
def dq_singular(data: Data):
    return quality.violations(data.table("customer").filter("c_acctbal <= 0"), "c_acctbal")


@query("dq_non_negative", check_sql("non_negative", "c_acctbal", "SELECT count(*) AS failures FROM customer WHERE c_acctbal < 0")
       + " UNION ALL " + check_sql("positive", "l_discount", "SELECT count(*) AS failures FROM lineitem WHERE l_discount <= 0"))
def dq_non_negative(data: Data):
    return quality.report(quality.non_negative(data.table("customer"), "c_acctbal"),
                          quality.positive(data.table("lineitem"), "l_discount"))


@query("dq_row_count", check_sql("row_count", "events", "SELECT CASE WHEN count(*) > 0 THEN 0 ELSE 1 END::BIGINT AS failures FROM events"))
def dq_row_count(data: Data):
    return quality.has_rows(data.events(), "events")


@query("dq_freshness", """SELECT 'freshness' AS "check", 'ts' AS target, failures, CASE WHEN failures > 48 THEN 'error'
 WHEN failures > 24 THEN 'warn' ELSE 'pass' END AS status FROM (SELECT datesub('hour', max(ts), TIMESTAMP '2024-02-01 06:00:00')
 AS failures FROM events)""")
def dq_freshness(data: Data):
    return quality.freshness(data.events(), "ts", "2024-02-01 06:00:00")


@query("dq_contract", f"{TRIPS} SELECT order_key, pickup, total FROM trips")
def dq_contract(data: Data):
    declared = T.StructType.fromDDL("order_key bigint, pickup timestamp_ntz, total double")
    return quality.contracted(data.trips("order_key", "pickup", "total"), declared)


@query("dq_assertions", """SELECT * , CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM (
 SELECT 'not_empty' AS "check", 'table' AS target, CASE WHEN count(*) = 0 THEN 1 ELSE 0 END::BIGINT AS failures FROM lineitem
 UNION ALL SELECT 'columns_present', 'l_orderkey,l_quantity,vendor_id', 1::BIGINT
 UNION ALL SELECT 'minimum', 'l_linenumber', count(*) FILTER (l_linenumber < 1) FROM lineitem
 UNION ALL SELECT 'minimum', 'l_quantity', count(*) FILTER (l_quantity < 2) FROM lineitem)""")
def dq_assertions(data: Data):
    return quality.assertions(data.table("lineitem"), ["l_orderkey", "l_quantity", "vendor_id"],
                              {"l_linenumber": 1, "l_quantity": 2})


@query("dq_compare_models", """WITH new AS (SELECT c_custkey, c_name,
 CASE c_mktsegment WHEN 'BUILDING' THEN 'HOUSING' ELSE c_mktsegment END AS c_mktsegment,
 CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal FROM customer WHERE c_nationkey <> 4),
 old AS (SELECT * FROM customer WHERE c_nationkey <> 5)
 SELECT count(*) FILTER (n.c_custkey IS NULL) AS only_old, count(*) FILTER (o.c_custkey IS NULL) AS only_new,
 count(*) FILTER (n.c_custkey IS NOT NULL AND o.c_custkey IS NOT NULL) AS in_both,
 count(*) FILTER (n.c_custkey IS NOT NULL AND o.c_custkey IS NOT NULL AND n.c_mktsegment IS DISTINCT FROM o.c_mktsegment) AS diff_c_mktsegment,
 count(*) FILTER (n.c_custkey IS NOT NULL AND o.c_custkey IS NOT NULL AND n.c_acctbal IS DISTINCT FROM o.c_acctbal) AS diff_c_acctbal
 FROM old o FULL JOIN new n ON o.c_custkey = n.c_custkey""")
def dq_compare_models(data: Data):
    customers = data.table("customer")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "HOUSING").otherwise(F.col("c_mktsegment"))
    newer = (customers.filter("c_nationkey <> 4").withColumn("c_mktsegment", segment)
             .withColumn("c_acctbal", F.greatest("c_acctbal", F.lit(0.0))))
    return quality.compare_models(customers.filter("c_nationkey <> 5"), newer, ["c_custkey"],
                                  ["c_mktsegment", "c_acctbal"])


@query("dq_report", check_sql("not_null", "l_orderkey", "SELECT count(*) FILTER (l_orderkey IS NULL) AS failures FROM lineitem")
       + " UNION ALL " + check_sql("non_negative", "l_extendedprice", "SELECT count(*) AS failures FROM lineitem WHERE l_extendedprice < 0")
       + " UNION ALL " + check_sql("relationships", "l_orderkey", "SELECT count(*) AS failures FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)"))
def dq_report(data: Data):
    lines = data.table("lineitem")
    return quality.report(quality.not_null(lines, ["l_orderkey"]), quality.non_negative(lines, "l_extendedprice"),
                          quality.relationships(lines, "l_orderkey", data.table("orders"), "o_orderkey"))
