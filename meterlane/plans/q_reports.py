"""Grouped reports and marts."""

from __future__ import annotations


from pyspark.sql import functions as F

from meterlane.functions import keys, labels, times
from meterlane.functions.numbers import half_up, mean, rounded, total
from meterlane.functions.times import truncated
from meterlane.operators import joins, reports, unions
from meterlane.plans import models, sqltext
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import BOTH, TRIPS
from meterlane.plans.stand_ins import IS_YELLOW_SQL, Data
from meterlane.session import materialize

MODEL_COLUMNS = ("order_key", "vendor_code", "pickup", "dropoff", "pickup_id", "dropoff_id", "passenger_count",
                 "distance", "fare", "extra", "tip", "tax", "tolls", "surcharge", "total", "payment_code")


def facts(data: Data, start: str | None = None, end: str | None = None):
    """All layers below the mart, composed into one plan; of a range of pick-up times, if one is given.

    The pick-up time is part of the trip's key, so a range never parts copies of a trip.
    """
    services = [data.green(*MODEL_COLUMNS), data.yellow(*MODEL_COLUMNS)]
    if start:
        services = [service.filter(times.within("pickup", start, end)) for service in services]
    unioned = models.trips_unioned(*services)
    return models.fact_trips(models.trips_enriched(unioned, models.payment_types(data.spark)), data.zones())


FACTS = f"""{BOTH}, unioned AS (SELECT *, CASE WHEN {IS_YELLOW_SQL} THEN 'Yellow' ELSE 'Green' END AS service,
 CASE WHEN {IS_YELLOW_SQL} THEN 1 ELSE 2 END AS trip_type,
 CASE WHEN {IS_YELLOW_SQL} THEN 0 ELSE tax END AS ehail_fee FROM trips),
 deduped AS (SELECT *, md5(coalesce(CAST(vendor_code AS VARCHAR), '{keys.NULL_PART}') || '-'
 || strftime(pickup, '%Y-%m-%d %H:%M:%S') || '-' || coalesce(CAST(pickup_id AS VARCHAR), '{keys.NULL_PART}')
 || '-' || service) AS trip_id, row_number() OVER (PARTITION BY vendor_code, pickup, pickup_id, service
 ORDER BY dropoff NULLS LAST, order_key, distance, fare) AS rn FROM unioned),
 facts AS (SELECT d.*, zpu.zone AS pickup_zone, zpu.borough AS pickup_borough, zdo.zone AS dropoff_zone,
 zdo.borough AS dropoff_borough, date_diff('minute', pickup, dropoff) AS trip_duration_minutes
 FROM (SELECT * FROM deduped WHERE rn = 1) d
 LEFT JOIN zones zpu ON pickup_id = zpu.location_id LEFT JOIN zones zdo ON dropoff_id = zdo.location_id)"""
MART_SUMS_SQL = ", ".join(f"{sqltext.total(column)} AS {name}" for name, column in models.MART_SUMS.items())
MART = f"""{FACTS}, mart AS (SELECT coalesce(pickup_zone, 'Unknown Zone') AS zone,
 CAST(date_trunc('month', pickup) AS TIMESTAMP) AS revenue_month, service AS service_type,
 {MART_SUMS_SQL}, count(trip_id) AS total_monthly_trips,
 {sqltext.mean('passenger_count')} AS avg_monthly_passenger_count,
 {sqltext.mean('distance')} AS avg_monthly_trip_distance FROM facts GROUP BY 1, 2, 3)"""


@query("monthly_zone_revenue", f"{MART} SELECT * FROM mart")
def monthly_zone_revenue(data: Data):
    return rounded(models.monthly_zone_revenue(facts(data)), 4, *models.MART_SUMS, *models.MART_AVERAGES)


@query("fact_trips", f"""{FACTS} SELECT trip_id, vendor_code, service AS service_type, pickup_zone, dropoff_zone,
 pickup_borough, dropoff_borough, pickup, dropoff, trip_type, trip_duration_minutes,
 total, coalesce(payment_code, 0) AS payment_type,
 CASE coalesce(payment_code, 0) WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' ELSE 'Unknown' END
 AS payment_type_description FROM facts""")
def fact_trips(data: Data):
    return facts(data).select(
        "trip_id", "vendor_code", "service_type", "pickup_zone", "dropoff_zone", "pickup_borough",
        "dropoff_borough", "pickup", "dropoff", "trip_type", "trip_duration_minutes",
        "total", "payment_type", "payment_type_description")


@query("monthly_zone_revenue_by_id", f"""{TRIPS} SELECT pickup_id AS zone, CAST(date_trunc('month', pickup) AS TIMESTAMP)
 AS revenue_month, service_type, {MART_SUMS_SQL.replace('(ehail_fee)', '(tax)')}, count(order_key) AS total_monthly_trips,
 {sqltext.mean('passenger_count')} AS avg_monthly_passenger_count,
 {sqltext.mean('distance')} AS avg_monthly_trip_distance FROM trips GROUP BY 1, 2, 3""")
def monthly_zone_revenue_by_id(data: Data):
    # Grouped by the id instead of the name; the hailing fee of the stand-in is its tax.
    sums = {**models.MART_SUMS, "revenue_monthly_ehail_fee": "tax"}
    trips = data.trips("order_key", "pickup_id", "pickup", "service_type", *dict.fromkeys(sums.values()),
                       *models.MART_AVERAGES.values())
    mart = reports.monthly_zone_mart(trips, F.col("pickup_id"), "pickup", "service_type", sums, "order_key",
                                     models.MART_AVERAGES)
    return rounded(mart, 4, *sums, *models.MART_AVERAGES)


@query("best_zone_year", f"""{MART} SELECT zone, {sqltext.total('revenue_monthly_total_amount')} AS revenue
 FROM mart WHERE service_type = 'Green' AND year(revenue_month) = 1997 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def best_zone_year(data: Data):
    year = models.monthly_zone_revenue(facts(data, "1997-01-01", "1998-01-01")).filter("service_type = 'Green'")
    zones = year.groupBy("zone").agg(half_up(total("revenue_monthly_total_amount"), 4).alias("revenue"))
    return reports.top(zones, [F.desc("revenue"), F.col("zone")], 1)


@query("month_trip_total", f"""{MART} SELECT CAST(sum(total_monthly_trips) AS BIGINT) AS trips FROM mart
 WHERE service_type = 'Green' AND revenue_month = '1997-10-01'""")
def month_trip_total(data: Data):
    october = models.monthly_zone_revenue(facts(data, "1997-10-01", "1997-11-01"))
    return october.filter("service_type = 'Green'").agg(F.sum("total_monthly_trips").alias("trips"))


@query("count_rows", "SELECT count(*) AS n FROM lineitem")
def count_rows(data: Data):
    return data.table("lineitem").agg(F.count("*").alias("n"))


@query("count_distinct_base", "SELECT count(DISTINCT l_partkey) AS parts, count(DISTINCT l_suppkey) AS suppliers FROM lineitem")
def count_distinct_base(data: Data):
    return data.table("lineitem").agg(F.count_distinct("l_partkey").alias("parts"),
                                      F.count_distinct("l_suppkey").alias("suppliers"))


@query("trips_per_day", """SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day, count(*) AS trips FROM lineitem
 GROUP BY 1 ORDER BY trips DESC, day""")
def trips_per_day(data: Data):
    lines = data.table("lineitem")
    return reports.counts_by(lines, truncated("day", "l_shipdate").alias("day")).orderBy(F.desc("trips"), "day")


@query("day_maxima", """SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day, count(*) AS trips,
 max(l_extendedprice) AS max_amount, max(l_linenumber) AS max_passengers FROM lineitem GROUP BY 1""")
def day_maxima(data: Data):
    return data.table("lineitem").groupBy(truncated("day", "l_shipdate").alias("day")).agg(
        F.count("*").alias("trips"), F.max("l_extendedprice").alias("max_amount"),
        F.max("l_linenumber").alias("max_passengers"))


@query("day_zone_maxima", f"""{TRIPS} SELECT CAST(date_trunc('day', dropoff) AS TIMESTAMP) AS day, dropoff_id,
 count(*) AS trips, max(total) AS max_amount, max(passenger_count) AS max_passengers
 FROM trips GROUP BY 1, 2 ORDER BY day, dropoff_id""")
def day_zone_maxima(data: Data):
    return data.trips("dropoff", "dropoff_id", "total", "passenger_count").groupBy(
        truncated("day", "dropoff").alias("day"), "dropoff_id").agg(
        F.count("*").alias("trips"), F.max("total").alias("max_amount"),
        F.max("passenger_count").alias("max_passengers")).orderBy("day", "dropoff_id")


@query("monthly_revenue", f"""SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS month, count(*) AS trips,
 {sqltext.total('l_extendedprice', 2)} AS revenue, {sqltext.mean('l_extendedprice', 2)} AS avg_amount,
 {sqltext.mean('l_quantity', 2)} AS avg_distance FROM lineitem GROUP BY 1""")
def monthly_revenue(data: Data):
    monthly = reports.monthly_revenue(data.table("lineitem"), "l_shipdate", "l_extendedprice", "l_quantity")
    return rounded(monthly, 2, "revenue")


@query("monthly_revenue_ym", f"""SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
 count(*) AS trips, {sqltext.total('l_extendedprice', 2)} AS revenue,
 {sqltext.mean('l_extendedprice', 2)} AS avg_amount FROM lineitem GROUP BY 1, 2 ORDER BY 1, 2""")
def monthly_revenue_ym(data: Data):
    return data.table("lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("month")).agg(
        F.count("*").alias("trips"), half_up(total("l_extendedprice")).alias("revenue"),
        half_up(mean("l_extendedprice")).alias("avg_amount")).orderBy("year", "month")


@query("peak_hours", """SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS trips FROM events
 GROUP BY 1 ORDER BY trips DESC, hour""")
def peak_hours(data: Data):
    return reports.counts_by(data.events(), F.hour("ts").alias("hour")).orderBy(F.desc("trips"), "hour")


@query("top_pairs", f"""{TRIPS} SELECT pickup_id, dropoff_id, count(*) AS trips FROM trips GROUP BY 1, 2
 ORDER BY trips DESC, pickup_id NULLS LAST, dropoff_id NULLS LAST LIMIT 10""")
def top_pairs(data: Data):
    pairs = reports.counts_by(data.trips("pickup_id", "dropoff_id"), "pickup_id", "dropoff_id")
    return reports.top(pairs, [F.desc("trips"), F.col("pickup_id").asc_nulls_last(),
                               F.col("dropoff_id").asc_nulls_last()], 10)


@query("revenue_by_payment", f"""SELECT l_linenumber AS payment_type, CASE l_linenumber WHEN 1 THEN 'Credit card'
 WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 6 THEN 'Voided trip' ELSE 'Unknown' END
 AS payment_method, count(*) AS trips, {sqltext.total('l_extendedprice', 2)} AS total_revenue FROM lineitem GROUP BY 1""")
def revenue_by_payment(data: Data):
    grouped = data.table("lineitem").groupBy(F.col("l_linenumber").alias("payment_type")).agg(
        F.count("*").alias("trips"), half_up(total("l_extendedprice")).alias("total_revenue"))
    return grouped.withColumn("payment_method", labels.labelled(
        "payment_type", labels.PAYMENT_LABELS, labels.PAYMENT_DEFAULT))


HOUR_ZONE = f"""SELECT date_trunc('hour', ts) AS hour, user_id AS zone,
 {sqltext.total('value')} AS amount, count(*) AS number_records
 FROM events WHERE ts >= '2024-01-05' GROUP BY 1, 2"""


@query("hour_zone_revenue", HOUR_ZONE)
def hour_zone_revenue(data: Data):
    since = data.events().filter(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
    return since.groupBy(truncated("hour", "ts").alias("hour"), F.col("user_id").alias("zone")).agg(
        half_up(total("value"), 4).alias("amount"), F.count("*").alias("number_records"))


@query("rdd_revenue", HOUR_ZONE)
def rdd_revenue(data: Data):
    # The same report as a map and a key-wise reduce, kept to show the equivalence.
    since = data.events().filter(F.col("ts") >= F.lit("2024-01-05").cast("timestamp_ntz"))
    keyed = since.select(truncated("hour", "ts").alias("hour"), "user_id", "value").rdd.map(
        lambda r: ((r["hour"], r["user_id"]), (r["value"], 1)))
    reduced = keyed.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1]))
    rows = reduced.map(lambda kv: (kv[0][0], kv[0][1], kv[1][0], kv[1][1]))
    frame = data.spark.createDataFrame(rows, "hour timestamp_ntz, zone long, amount double, number_records long")
    return rounded(frame, 4, "amount")


@query("vendor_tip_pct", f"""{TRIPS} SELECT CAST(year(pickup) AS INTEGER) AS year, CAST(month(pickup) AS INTEGER) AS month,
 vendor_id, count(*) AS trips, {sqltext.total('total')} AS revenue,
 round(avg(CAST(tip AS DOUBLE) / nullif(CAST(fare AS DOUBLE), 0) * 100), 6) AS avg_tip_pct FROM trips GROUP BY 1, 2, 3""")
def vendor_tip_pct(data: Data):
    trips = data.trips("pickup", "vendor_id", "tip", "fare", "total")
    keys = [F.year("pickup").alias("year"), F.month("pickup").alias("month"), F.col("vendor_id")]
    return rounded(reports.tip_percent(trips, keys, "tip", "fare", "total"), 4, "revenue")


@query("longest_trip_day", """SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS day, max(l_extendedprice) AS largest
 FROM lineitem WHERE l_quantity <= 40 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def longest_trip_day(data: Data):
    return reports.best_day(data.table("lineitem").filter("l_quantity <= 40"), "l_shipdate", "l_extendedprice")


@query("max_duration_hours", f"{TRIPS} SELECT max(date_diff('second', pickup, dropoff)) / 3600.0 AS hours FROM trips")
def max_duration_hours(data: Data):
    longest = F.max(times.seconds_between("pickup", "dropoff"))
    return data.trips("pickup", "dropoff").agg((longest.cast("double") / 3600).alias("hours"))


def zone_counts(data: Data):
    counted = reports.counts_by(data.trips("pickup_id"), "pickup_id")
    return joins.lookup(counted, data.zones(), F.col("pickup_id") == F.col("location_id"), "inner")


@query("zone_frequency_extremes", f"""{BOTH}, c AS (SELECT zone, count(*) AS trips FROM trips JOIN zones
 ON pickup_id = location_id GROUP BY 1) (SELECT 'most' AS extreme, * FROM c ORDER BY trips DESC, zone LIMIT 1)
 UNION ALL (SELECT 'least', * FROM c ORDER BY trips, zone LIMIT 1)""")
def zone_frequency_extremes(data: Data):
    counted = materialize(zone_counts(data).select("zone", "trips"), "zone-counts")
    most = reports.top(counted, [F.desc("trips"), F.col("zone")], 1)
    least = reports.top(counted, [F.asc("trips"), F.col("zone")], 1)
    return unions.stacked(most.select(F.lit("most").alias("extreme"), "*"),
                          least.select(F.lit("least").alias("extreme"), "*"))


@query("top_dispatch_base", """SELECT l_suppkey AS base, count(*) AS trips FROM lineitem GROUP BY 1
 ORDER BY 2 DESC, 1 LIMIT 5""")
def top_dispatch_base(data: Data):
    counted = reports.counts_by(data.table("lineitem"), F.col("l_suppkey").alias("base"))
    return reports.top(counted, [F.desc("trips"), F.col("base")], 5)


@query("zone_pair_text", f"""{BOTH} SELECT coalesce(zpu.zone, 'Unknown') || ' / ' || coalesce(zdo.zone, 'Unknown') AS pair,
 count(*) AS trips FROM trips LEFT JOIN zones zpu ON pickup_id = zpu.location_id
 LEFT JOIN zones zdo ON dropoff_id = zdo.location_id GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def zone_pair_text(data: Data):
    # Counted by id first: the zone names join a few hundred pairs instead of every trip.
    pairs = reports.counts_by(data.trips("pickup_id", "dropoff_id"), "pickup_id", "dropoff_id")
    named = joins.with_roles(pairs, data.zones(), "location_id", {"pickup": "pickup_id", "dropoff": "dropoff_id"})
    text = F.concat(F.coalesce("pickup_zone", F.lit("Unknown")), F.lit(" / "),
                    F.coalesce("dropoff_zone", F.lit("Unknown")))
    summed = named.groupBy(text.alias("pair")).agg(F.sum("trips").alias("trips"))
    return reports.top(summed, [F.desc("trips"), F.col("pair")], 1)


@query("largest_tip_dropoff", f"""{BOTH} SELECT zdo.zone AS dropoff_zone, max(tip) AS largest_tip
 FROM trips JOIN zones zpu ON pickup_id = zpu.location_id JOIN zones zdo ON dropoff_id = zdo.location_id
 WHERE zpu.zone = 'NATION_3' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def largest_tip_dropoff(data: Data):
    trips = from_zone(data, "NATION_3", "tip")
    grouped = trips.groupBy("dropoff_zone").agg(F.max("tip").alias("largest_tip"))
    return reports.top(grouped, [F.desc("largest_tip"), F.col("dropoff_zone")], 1)


def from_zone(data: Data, zone: str, *columns: str):
    trips = data.trips("pickup_id", "dropoff_id", *columns)
    roles = {"pickup": "pickup_id", "dropoff": "dropoff_id"}
    joined = joins.with_roles(trips, data.zones().select("location_id", "zone"), "location_id", roles, "inner")
    return joined.filter(F.col("pickup_zone") == zone)


@query("popular_destination", f"""{BOTH} SELECT zdo.zone AS dropoff_zone, count(*) AS trips
 FROM trips JOIN zones zpu ON pickup_id = zpu.location_id JOIN zones zdo ON dropoff_id = zdo.location_id
 WHERE zpu.zone = 'NATION_3' AND pickup >= '1996-01-01' AND pickup < '1997-01-01'
 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1""")
def popular_destination(data: Data):
    trips = from_zone(data, "NATION_3", "pickup").filter(times.within("pickup", "1996-01-01", "1997-01-01"))
    return reports.top(reports.counts_by(trips, "dropoff_zone"), [F.desc("trips"), F.col("dropoff_zone")], 1)


@query("expensive_routes", f"""{BOTH} SELECT zpu.zone AS pickup_zone, zdo.zone AS dropoff_zone,
 {sqltext.mean('total')} AS avg_total, count(*) AS trips FROM trips JOIN zones zpu ON pickup_id = zpu.location_id
 JOIN zones zdo ON dropoff_id = zdo.location_id GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 5""")
def expensive_routes(data: Data):
    pairs = data.trips("pickup_id", "dropoff_id", "total").groupBy("pickup_id", "dropoff_id").agg(
        half_up(mean("total"), 4).alias("avg_total"), F.count("*").alias("trips"))
    named = joins.with_roles(pairs, data.zones().select("location_id", "zone"), "location_id",
                             {"pickup": "pickup_id", "dropoff": "dropoff_id"}, "inner")
    rows = named.select("pickup_zone", "dropoff_zone", "avg_total", "trips")
    return reports.top(rows, [F.desc("avg_total"), F.col("pickup_zone"), F.col("dropoff_zone")], 5)


@query("zones_over_threshold", f"""{BOTH} SELECT zone, {sqltext.total('total')} AS revenue FROM trips
 JOIN zones ON pickup_id = location_id WHERE pickup >= '1996-06-01' AND pickup < '1996-07-01'
 GROUP BY 1 HAVING sum(total) > 13000 ORDER BY 2 DESC, 1""")
def zones_over_threshold(data: Data):
    day = data.trips("pickup_id", "pickup", "total").filter(times.within("pickup", "1996-06-01", "1996-07-01"))
    sums = day.groupBy("pickup_id").agg(total("total").alias("revenue")).filter("revenue > 13000")
    sums = rounded(sums, 4, "revenue")
    named = joins.lookup(sums, data.zones(), F.col("pickup_id") == F.col("location_id"), "inner")
    return named.select("zone", "revenue").orderBy(F.desc("revenue"), "zone")


@query("passenger_counts", """SELECT l_linenumber AS passenger_count, count(*) AS trips FROM lineitem
 WHERE l_linenumber IN (2, 3) AND l_shipdate >= '1997-01-01' AND l_shipdate < '1997-01-02' GROUP BY 1""")
def passenger_counts(data: Data):
    day = data.table("lineitem").filter(times.on_date("l_shipdate", "1997-01-01"))
    return reports.counts_by(day.filter(F.col("l_linenumber").isin(2, 3)),
                             F.col("l_linenumber").alias("passenger_count"))


@query("category_share", """SELECT o_orderstatus, count(*) AS n,
 round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS share_pct FROM orders GROUP BY 1""")
def category_share(data: Data):
    return reports.share_of_total(data.table("orders"), "o_orderstatus")


@query("sign_composition", """SELECT 'l_discount' AS column_name, count(*) FILTER (l_discount - 0.05 > 0) AS positive,
 count(*) FILTER (l_discount - 0.05 = 0) AS zero, count(*) FILTER (l_discount - 0.05 < 0) AS negative,
 count(*) FILTER (l_discount IS NULL) AS missing FROM lineitem UNION ALL
 SELECT 'l_tax', count(*) FILTER (l_tax > 0), count(*) FILTER (l_tax = 0), count(*) FILTER (l_tax < 0),
 count(*) FILTER (l_tax IS NULL) FROM lineitem""")
def sign_composition(data: Data):
    lines = data.table("lineitem").withColumn("l_discount", F.col("l_discount") - 0.05)
    return reports.sign_composition(lines, ["l_discount", "l_tax"])


PROFILE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, round(AVG({c}), 6) AS mean, round(stddev_samp({c}), 4) AS stddev,
 CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, {sqltext.total(c, 2)} AS sum FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_linenumber"))


@query("numeric_profile", PROFILE_SQL)
def numeric_profile(data: Data):
    profile = reports.numeric_profile(data.table("lineitem"), ["l_quantity", "l_extendedprice", "l_linenumber"])
    return rounded(profile, 2, "sum")


@query("data_window", "SELECT min(ts) AS first_at, max(ts) AS last_at FROM events")
def data_window(data: Data):
    return data.events().agg(F.min("ts").alias("first_at"), F.max("ts").alias("last_at"))


@query("total_tips", f"SELECT {sqltext.total('l_extendedprice * l_discount', 2)} AS tips FROM lineitem")
def total_tips(data: Data):
    return data.trips("tip").agg(half_up(total("tip"), 2).alias("tips"))


@query("avg_minutes", f"{TRIPS} SELECT CAST(sum(date_diff('minute', pickup, dropoff)) AS DOUBLE) / count(*) AS avg_minutes FROM trips")
def avg_minutes(data: Data):
    minutes = times.minutes_crossed("pickup", "dropoff")
    return data.trips("pickup", "dropoff").agg((F.sum(minutes).cast("double") / F.count(minutes)).alias("avg_minutes"))


PAIR_SQL = f"""{TRIPS}, pairs AS (SELECT pickup_id, dropoff_id, count(*) AS trips,
 CAST(sum(date_diff('second', pickup, dropoff)) AS DOUBLE) / count(*) AS avg_seconds,
 min(date_diff('second', pickup, dropoff)) AS min_seconds, max(date_diff('second', pickup, dropoff)) AS max_seconds
 FROM trips WHERE dropoff > pickup GROUP BY 1, 2)"""


def pairs(data: Data):
    trips = data.trips("pickup_id", "dropoff_id", "pickup", "dropoff").filter("dropoff > pickup")
    timed = trips.withColumn("seconds", times.seconds_between("pickup", "dropoff"))
    return reports.duration_by_pair(timed, "pickup_id", "dropoff_id", "seconds")


@query("pair_trip_time", f"{PAIR_SQL} SELECT * FROM pairs")
def pair_trip_time(data: Data):
    return pairs(data)


@query("slowest_pair", f"""{PAIR_SQL} SELECT * FROM pairs ORDER BY avg_seconds DESC, pickup_id NULLS LAST,
 dropoff_id NULLS LAST LIMIT 1""")
def slowest_pair(data: Data):
    return reports.top(pairs(data), [F.desc("avg_seconds"), F.col("pickup_id").asc_nulls_last(),
                                     F.col("dropoff_id").asc_nulls_last()], 1)


@query("pair_time_anomalies", f"{PAIR_SQL} SELECT * FROM pairs WHERE max_seconds >= 3 * avg_seconds")
def pair_time_anomalies(data: Data):
    return pairs(data).filter("max_seconds >= 3 * avg_seconds")


@query("demand_heatmap", """SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour,
 count(*) AS trips FROM events GROUP BY 1, 2""")
def demand_heatmap(data: Data):
    return reports.counts_by(data.events(), F.dayofweek("ts").alias("weekday"), F.hour("ts").alias("hour"))


@query("month_over_month", f"""WITH m AS (SELECT CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS month,
 {sqltext.total('o_totalprice', 2)} AS revenue FROM orders GROUP BY 1)
 SELECT month, revenue, lag(revenue) OVER (ORDER BY month) AS previous,
 round((revenue - lag(revenue) OVER (ORDER BY month)) / lag(revenue) OVER (ORDER BY month) * 100, 6) AS change_pct FROM m""")
def month_over_month(data: Data):
    monthly = data.table("orders").groupBy(truncated("month", "o_orderdate").alias("month")).agg(
        total("o_totalprice").alias("revenue"))
    return rounded(reports.month_over_month(monthly, "month", "revenue"), 2, "revenue", "previous")


@query("vendor_compare", f"""SELECT l_linestatus AS vendor_id, count(*) AS trips, {sqltext.total('l_extendedprice', 2)} AS revenue,
 {sqltext.mean('l_quantity')} AS avg_distance, {sqltext.mean('l_extendedprice')} AS avg_fare FROM lineitem GROUP BY 1""")
def vendor_compare(data: Data):
    return data.table("lineitem").groupBy(F.col("l_linestatus").alias("vendor_id")).agg(
        F.count("*").alias("trips"), half_up(total("l_extendedprice")).alias("revenue"),
        half_up(mean("l_quantity"), 4).alias("avg_distance"), half_up(mean("l_extendedprice"), 4).alias("avg_fare"))


@query("daily_payment_report", f"""SELECT CAST(date_trunc('day', l_shipdate) AS TIMESTAMP) AS trip_date,
 l_linestatus AS taxi_type, l_returnflag AS payment_type, count(*) AS trip_count,
 {sqltext.total('l_extendedprice', 2)} AS total_fare, {sqltext.mean('l_extendedprice')} AS avg_fare
 FROM lineitem WHERE l_shipdate >= '1996-01-01' AND l_shipdate < '1997-01-01' GROUP BY 1, 2, 3""")
def daily_payment_report(data: Data):
    lines = data.table("lineitem").filter(times.within("l_shipdate", "1996-01-01", "1997-01-01"))
    return lines.groupBy(truncated("day", "l_shipdate").alias("trip_date"), F.col("l_linestatus").alias("taxi_type"),
                         F.col("l_returnflag").alias("payment_type")).agg(
        F.count("*").alias("trip_count"), half_up(total("l_extendedprice")).alias("total_fare"),
        half_up(mean("l_extendedprice"), 4).alias("avg_fare"))


@query("exploded_value_counts", """WITH w AS (SELECT unnest(string_split(p_name, ' ')) AS author FROM part)
 SELECT author, CASE author WHEN 'red' THEN 'colour' WHEN 'blue' THEN 'colour' ELSE 'other' END AS kind,
 count(*) AS n FROM w GROUP BY 1 ORDER BY n DESC, author LIMIT 10""")
def exploded_value_counts(data: Data):
    words = data.table("part").select(F.explode(F.split("p_name", " ")).alias("author"))
    counted = reports.top(reports.counts_by(words, "author", name="n"), [F.desc("n"), F.col("author")], 10)
    return counted.withColumn("kind", labels.labelled("author", {"red": "colour", "blue": "colour"}, "other"))


@query("yearly_counts", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n FROM orders
 WHERE year(o_orderdate) BETWEEN 1996 AND 1999 GROUP BY 1""")
def yearly_counts(data: Data):
    orders = data.table("orders").filter(times.within("o_orderdate", "1996-01-01", "2000-01-01"))
    return reports.counts_by(orders, F.year("o_orderdate").alias("year"), name="n")


@query("summary_counts", """SELECT count(*) AS n_rows, count(DISTINCT o_custkey) AS customers,
 CAST(min(year(o_orderdate)) AS INTEGER) AS first_year, CAST(max(year(o_orderdate)) AS INTEGER) AS last_year FROM orders""")
def summary_counts(data: Data):
    return data.table("orders").agg(
        F.count("*").alias("n_rows"), F.count_distinct("o_custkey").alias("customers"),
        F.min(F.year("o_orderdate")).alias("first_year"), F.max(F.year("o_orderdate")).alias("last_year"))


@query("rows_per_service", f"""{TRIPS} SELECT CASE WHEN {IS_YELLOW_SQL} THEN 'yellow' ELSE 'green' END AS service_type,
 count(*) AS n FROM trips GROUP BY 1""")
def rows_per_service(data: Data):
    tagged = unions.stacked(data.yellow("order_key").select(F.lit("yellow").alias("service_type")),
                            data.green("order_key").select(F.lit("green").alias("service_type")))
    return reports.counts_by(tagged, "service_type", name="n")


@query("rows_per_year", """SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderstatus AS service, count(*) AS n
 FROM orders GROUP BY 1, 2""")
def rows_per_year(data: Data):
    return reports.counts_by(data.table("orders"), F.year("o_orderdate").alias("year"),
                             F.col("o_orderstatus").alias("service"), name="n")


@query("union_all_services", f"""{TRIPS} SELECT order_key, pickup, fare,
 CASE WHEN {IS_YELLOW_SQL} THEN 'yellow' ELSE 'green' END AS service_type FROM trips""")
def union_all_services(data: Data):
    wanted = ("order_key", "pickup", "fare")
    both = unions.stacked(data.yellow(*wanted).withColumn("service_type", F.lit("yellow")),
                          data.green(*wanted).select(*wanted).withColumn("service_type", F.lit("green")))
    return both


@query("union_aligned", f"""{TRIPS} SELECT order_key, total,
 CASE WHEN {IS_YELLOW_SQL} THEN 1 ELSE 2 END AS trip_type,
 CAST(CASE WHEN {IS_YELLOW_SQL} THEN 0 ELSE tax END AS DOUBLE) AS ehail_fee,
 CASE WHEN {IS_YELLOW_SQL} THEN 'Yellow' ELSE 'Green' END AS service_type FROM trips""")
def union_aligned(data: Data):
    both = models.trips_unioned(data.green("order_key", "total"), data.yellow("order_key", "total"))
    return both


@query("topk_orders", """SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""")
def topk_orders(data: Data):
    orders = data.table("orders").select("o_orderkey", "o_totalprice")
    return reports.top(orders, [F.desc("o_totalprice"), F.col("o_orderkey")], 20)


@query("sql_vs_df_same", """SELECT o_orderstatus, o_orderpriority, count(*) AS sql_n, count(*) AS df_n FROM orders GROUP BY 1, 2""")
def sql_vs_df_same(data: Data):
    orders = data.table("orders")
    orders.createOrReplaceTempView("meterlane_orders")
    from_sql = data.spark.sql("""SELECT o_orderstatus, o_orderpriority, count(*) AS sql_n
                                 FROM meterlane_orders GROUP BY o_orderstatus, o_orderpriority""")
    from_frame = reports.counts_by(orders, "o_orderstatus", "o_orderpriority", name="df_n")
    return from_sql.join(from_frame, ["o_orderstatus", "o_orderpriority"])


