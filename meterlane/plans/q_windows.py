"""Window functions, de-duplication, percentiles and top-k per group."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from meterlane.functions import labels, times
from meterlane.functions.numbers import half_up, rounded
from meterlane.operators import cleaning, joins, ordered, reports
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import BOTH, TRIPS
from meterlane.plans.stand_ins import Data


@query("row_number_global", """SELECT o_orderkey, o_totalprice,
 row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS ranking FROM orders""")
def row_number_global(data: Data):
    orders = data.table("orders").select("o_orderkey", "o_totalprice")
    return ordered.row_number(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], name="ranking")


@query("row_number_zone", """SELECT o_orderkey, o_totalprice, c_nationkey AS zone,
 row_number() OVER (PARTITION BY c_nationkey ORDER BY o_totalprice DESC, o_orderkey) AS ranking
 FROM orders JOIN customer ON o_custkey = c_custkey""")
def row_number_zone(data: Data):
    orders = data.table("orders").join(data.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    zoned = orders.select("o_orderkey", "o_totalprice", F.col("c_nationkey").alias("zone"))
    return ordered.row_number(zoned, [F.desc("o_totalprice"), F.asc("o_orderkey")], ["zone"], "ranking")


@query("rank_dense_rank", """SELECT event_id, event_type, value,
 rank() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST) AS rank,
 dense_rank() OVER (PARTITION BY event_type ORDER BY value DESC NULLS LAST) AS dense_rank FROM events""")
def rank_dense_rank(data: Data):
    return ordered.ranks(data.events().select("event_id", "event_type", "value"), ["event_type"], "value")


IN_TIME = "PARTITION BY event_type ORDER BY ts, event_id"


def in_time():
    return [F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")]


@query("lag_lead", f"""SELECT event_id, event_type, value, lag(value, 1) OVER ({IN_TIME}) AS prev_amount,
 lead(value, 1) OVER ({IN_TIME}) AS next_amount, lag(value, 2) OVER ({IN_TIME}) AS before_prev FROM events""")
def lag_lead(data: Data):
    events = data.events().select("event_id", "event_type", "ts", "value")
    framed = ordered.framed(events, ["event_type"], in_time(), {
        "prev_amount": lambda w: F.lag("value", 1).over(w),
        "next_amount": lambda w: F.lead("value", 1).over(w),
        "before_prev": lambda w: F.lag("value", 2).over(w)}, before=2, after=1)
    return framed.drop("ts")


@query("running_sum", f"""SELECT event_id, event_type,
 {sqltext.half_up(f'sum(value) OVER ({IN_TIME} ROWS UNBOUNDED PRECEDING)', 4)} AS running FROM events""")
def running_sum(data: Data):
    events = data.events().select("event_id", "event_type", "ts", "value")
    summed = ordered.running_sum(events, ["event_type"], in_time(), F.col("value"), "running")
    return summed.select("event_id", "event_type", half_up(F.col("running"), 4).alias("running"))


@query("moving_avg", f"""SELECT event_id, event_type,
 {sqltext.half_up(f'avg(value) OVER ({IN_TIME} ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)', 4)} AS moving FROM events""")
def moving_avg(data: Data):
    events = data.events().select("event_id", "event_type", "ts", "value")
    framed = ordered.framed(events, ["event_type"], in_time(),
                            {"moving": lambda w: F.avg("value").over(w.rowsBetween(-2, 0))}, before=2)
    return framed.select("event_id", "event_type", half_up(F.col("moving"), 4).alias("moving"))


@query("p90_per_zone", f"""{TRIPS} SELECT order_key, pickup_id, total,
 round(quantile_cont(total, 0.9) OVER (PARTITION BY pickup_id), 4) AS p90
 FROM trips WHERE pickup_id IS NOT NULL""")
def p90_per_zone(data: Data):
    trips = data.trips("order_key", "pickup_id", "total").filter("pickup_id IS NOT NULL")
    p90 = ordered.percentiles(trips, ["pickup_id"], "total", {"p90": 0.9})
    zones = p90.select(F.col("pickup_id").alias("zone"), F.round("p90", 4).alias("p90"))
    return joins.lookup(trips, zones, F.col("pickup_id") == F.col("zone")).drop("zone")


@query("duration_p90", f"""{TRIPS} SELECT pickup_id,
 round(quantile_cont(CAST(date_diff('second', pickup, dropoff) AS DOUBLE), 0.9), 4) AS trip_duration_p90
 FROM trips GROUP BY 1""")
def duration_p90(data: Data):
    timed = data.trips("pickup_id", "pickup", "dropoff").select(
        "pickup_id", times.seconds_between("pickup", "dropoff").alias("seconds"))
    p90 = ordered.percentiles(timed, ["pickup_id"], "seconds", {"trip_duration_p90": 0.9})
    return p90.withColumn("trip_duration_p90", F.round("trip_duration_p90", 4))


@query("dedup_first", """SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice FROM lineitem
 QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
 ORDER BY l_shipdate NULLS LAST, l_partkey, l_suppkey, l_extendedprice) = 1""")
def dedup_first(data: Data):
    lines = data.table("lineitem").select("l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
                                          "l_extendedprice")
    order = [F.asc_nulls_last(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice")]
    return cleaning.first_per_key(lines, ["l_orderkey", "l_linenumber"], order).drop("l_suppkey")


QUARTERS = f"""WITH q AS (SELECT o_orderstatus AS service_type, CAST(year(o_orderdate) AS INTEGER) AS year,
 CAST(quarter(o_orderdate) AS INTEGER) AS quarter, {sqltext.total('o_totalprice', 2)} AS revenue
 FROM orders GROUP BY 1, 2, 3),
 g AS (SELECT a.*, b.revenue AS previous, round((a.revenue - b.revenue) / b.revenue * 100, 6) AS yoy_pct
 FROM q a LEFT JOIN q b ON a.service_type = b.service_type AND a.quarter = b.quarter AND a.year = b.year + 1)"""


@query("quarterly_yoy", f"{QUARTERS} SELECT * FROM g")
def quarterly_yoy(data: Data):
    growth = reports.quarterly_growth(data.table("orders"), "o_orderdate", "o_orderstatus", "o_totalprice")
    return rounded(growth, 2, "revenue", "previous")


@query("quarterly_extremes", f"""{QUARTERS} SELECT service_type, arg_max(quarter, yoy_pct) AS best_quarter,
 arg_min(quarter, yoy_pct) AS worst_quarter FROM g WHERE year = 1998 GROUP BY 1""")
def quarterly_extremes(data: Data):
    growth = quarterly_yoy(data).filter("year = 1998")
    return growth.groupBy("service_type").agg(F.max_by("quarter", "yoy_pct").alias("best_quarter"),
                                              F.min_by("quarter", "yoy_pct").alias("worst_quarter"))


@query("monthly_fare_percentiles", f"""{TRIPS} SELECT service_type, CAST(year(pickup) AS INTEGER) AS year,
 CAST(month(pickup) AS INTEGER) AS month, round(quantile_cont(fare, 0.97), 4) AS p97,
 round(quantile_cont(fare, 0.95), 4) AS p95, round(quantile_cont(fare, 0.9), 4) AS p90
 FROM trips WHERE fare > 0 AND distance > 0 AND payment_code IN (1, 2) GROUP BY 1, 2, 3""")
def monthly_fare_percentiles(data: Data):
    label = labels.labelled("payment_code", labels.PAYMENT_LABELS, labels.PAYMENT_DEFAULT)
    valid = data.trips("service_type", "pickup", "fare", "distance", "payment_code").filter(
        (F.col("fare") > 0) & (F.col("distance") > 0) & label.isin("Cash", "Credit card"))
    keyed = valid.select("service_type", F.year("pickup").alias("year"), F.month("pickup").alias("month"),
                         "fare")
    result = ordered.percentiles(keyed, ["service_type", "year", "month"], "fare",
                                 {"p97": 0.97, "p95": 0.95, "p90": 0.9})
    return result.withColumns({p: F.round(p, 4) for p in ("p97", "p95", "p90")})


@query("nth_longest_p90", f"""{BOTH}, p AS (SELECT pickup_id, dropoff_id,
 round(quantile_cont(CAST(date_diff('second', pickup, dropoff) AS DOUBLE), 0.9), 4) AS p90
 FROM trips WHERE pickup >= '1997-11-01' AND pickup < '1997-12-01' AND pickup_id IS NOT NULL
 AND dropoff_id IS NOT NULL GROUP BY 1, 2),
 r AS (SELECT *, dense_rank() OVER (PARTITION BY pickup_id ORDER BY p90 DESC) AS place FROM p)
 SELECT zpu.zone AS pickup_zone, zdo.zone AS dropoff_zone, p90 FROM r JOIN zones zpu ON pickup_id = zpu.location_id
 JOIN zones zdo ON dropoff_id = zdo.location_id WHERE place = 2""")
def nth_longest_p90(data: Data):
    trips = data.trips("pickup_id", "dropoff_id", "pickup", "dropoff").filter(
        times.within("pickup", "1997-11-01", "1997-12-01")
        & F.col("pickup_id").isNotNull() & F.col("dropoff_id").isNotNull())
    timed = trips.withColumn("seconds", times.seconds_between("pickup", "dropoff"))
    p90 = ordered.percentiles(timed, ["pickup_id", "dropoff_id"], "seconds", {"p90": 0.9})
    # One row per zone pair from here on, so a plain window does.
    place = F.dense_rank().over(Window.partitionBy("pickup_id").orderBy(F.desc("p90")))
    second = p90.withColumn("p90", F.round("p90", 4)).withColumn("place", place).filter("place = 2")
    named = joins.with_roles(second, data.zones().select("location_id", "zone"), "location_id",
                             {"pickup": "pickup_id", "dropoff": "dropoff_id"}, "inner")
    return named.select("pickup_zone", "dropoff_zone", "p90")


@query("topk_per_group", """SELECT event_type, user_id, n FROM (SELECT event_type, user_id, count(*) AS n,
 row_number() OVER (PARTITION BY event_type ORDER BY count(*) DESC, user_id) AS rn FROM events GROUP BY 1, 2)
 WHERE rn <= 3""")
def topk_per_group(data: Data):
    counted = reports.counts_by(data.events(), "event_type", "user_id", name="n")
    return cleaning.first_per_key(counted, ["event_type"], [F.desc("n"), F.asc("user_id")], 3)
