"""Projection, filters and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlane.functions import keys, labels, numbers, text, times
from meterlane.operators import cleaning
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import TRIPS
from meterlane.plans.stand_ins import IS_YELLOW_SQL, Data
from meterlane.session import new_path
from meterlane.sinks import versioned

RAW_COMMON = {"VendorID": "vendor_code", "PULocationID": "pickup_id", "DOLocationID": "dropoff_id",
              "passenger_count": "passenger_count", "trip_distance": "distance",
              "payment_type": "payment_code", "fare_amount": "fare", "tip_amount": "tip",
              "total_amount": "total"}
STAGED_COMMON = {
    "vendor_id": ("VendorID", "int"), "pickup_location_id": ("PULocationID", "int"),
    "dropoff_location_id": ("DOLocationID", "int"), "passenger_count": ("passenger_count", "int"),
    "trip_distance": ("trip_distance", "double"), "payment_type": ("payment_type", "int"),
    "fare_amount": ("fare_amount", "decimal(18,4)"), "tip_amount": ("tip_amount", "decimal(18,4)"),
    "total_amount": ("total_amount", "decimal(18,4)")}
MONEY = ("fare_amount", "tip_amount", "total_amount")


def raw(frame, prefix: str):
    """Trips under the names and types of the delivered files."""
    columns = [F.col(src).alias(name) for name, src in RAW_COMMON.items()]
    return frame.select(*columns, F.col("pickup").alias(f"{prefix}_pickup_datetime"),
                        F.col("dropoff").alias(f"{prefix}_dropoff_datetime"),
                        *[F.col(c) for c in frame.columns if c in ("trip_type", "ehail_fee")])


def raw_yellow(data: Data):
    return raw(data.yellow(*RAW_COMMON.values(), "pickup", "dropoff"), "tpep")


def raw_green(data: Data):
    return raw(data.green(*RAW_COMMON.values(), "pickup", "dropoff"), "lpep")


def stage(frame, prefix: str):
    spec = dict(STAGED_COMMON)
    spec["pickup_datetime"] = (f"{prefix}_pickup_datetime", "timestamp_ntz")
    spec["dropoff_datetime"] = (f"{prefix}_dropoff_datetime", "timestamp_ntz")
    if "trip_type" in frame.columns:
        spec["trip_type"] = ("trip_type", "int")
        spec["ehail_fee"] = ("ehail_fee", "decimal(18,4)")
    return cleaning.staged(cleaning.not_null(frame, "VendorID"), spec)


def as_doubles(frame, *columns):
    return frame.withColumns({c: F.col(c).cast("double") for c in columns})


STAGED_SQL = """SELECT CAST(vendor_code AS INTEGER) AS vendor_id, pickup_id AS pickup_location_id,
 dropoff_id AS dropoff_location_id, passenger_count, distance AS trip_distance,
 payment_code AS payment_type, CAST(CAST(fare AS DECIMAL(18,4)) AS DOUBLE) AS fare_amount,
 CAST(CAST(tip AS DECIMAL(18,4)) AS DOUBLE) AS tip_amount,
 CAST(CAST(total AS DECIMAL(18,4)) AS DOUBLE) AS total_amount,
 pickup AS pickup_datetime, dropoff AS dropoff_datetime"""


@query("stg_green", f"""{TRIPS} {STAGED_SQL}, 2 AS trip_type,
 CAST(CAST(tax AS DECIMAL(18,4)) AS DOUBLE) AS ehail_fee
 FROM trips WHERE NOT ({IS_YELLOW_SQL}) AND vendor_code IS NOT NULL""")
def stg_green(data: Data):
    return as_doubles(stage(raw_green(data), "lpep"), *MONEY, "ehail_fee")


@query("stg_yellow", f"{TRIPS} {STAGED_SQL} FROM trips WHERE {IS_YELLOW_SQL} AND vendor_code IS NOT NULL")
def stg_yellow(data: Data):
    return as_doubles(stage(raw_yellow(data), "tpep"), *MONEY)


@query("stg_fhv_not_null", """SELECT event_id, nullif(event_type, 'error') AS dispatching_base_num,
 ts AS pickup_datetime, user_id AS pickup_location_id FROM events WHERE nullif(event_type, 'error') IS NOT NULL""")
def stg_fhv_not_null(data: Data):
    fhv = data.events().select("event_id", F.nullif("event_type", F.lit("error")).alias("dispatching_base_num"),
                               F.col("ts").alias("pickup_datetime"),
                               F.col("user_id").alias("pickup_location_id"))
    return cleaning.not_null(fhv, "dispatching_base_num")


@query("common_columns", f"""{TRIPS} SELECT vendor_code, pickup, distance, fare,
 CASE WHEN {IS_YELLOW_SQL} THEN 'yellow' ELSE 'green' END AS service FROM trips""")
def common_columns(data: Data):
    wanted = ("vendor_code", "pickup", "distance", "fare")
    yellow, green = data.yellow(*wanted), data.green(*wanted)
    shared = cleaning.common_columns(yellow, green)
    both = (yellow.select(*shared).withColumn("service", F.lit("yellow"))
            .unionByName(green.select(*shared).withColumn("service", F.lit("green"))))
    return both


@query("snake_case_columns", f"""{TRIPS} SELECT vendor_code AS vendor_id, pickup_id AS pu_location_id,
 dropoff_id AS do_location_id, pickup AS tpep_pickup_datetime FROM trips WHERE {IS_YELLOW_SQL}""")
def snake_case_columns(data: Data):
    frame = raw_yellow(data).select("VendorID", "PULocationID", "DOLocationID", "tpep_pickup_datetime")
    return text.with_snake_case(frame)


def with_speed(data: Data, *columns: str):
    """Trips with minutes and distance per day (the stand-in's trips last for days)."""
    minutes = times.minutes_elapsed("pickup", "dropoff")
    return (data.trips(*dict.fromkeys(("order_key", "pickup", "dropoff", "distance", *columns)))
            .withColumn("minutes", minutes)
            .withColumn("speed", numbers.ratio(F.col("distance"), F.col("minutes") / F.lit(1440.0))))


def clean_conditions() -> dict:
    return {"has passengers": F.col("passenger_count") > 1,
            "has distance": F.col("distance") > 2,
            "has fare": F.col("fare") > 1000,
            "positive duration": F.col("minutes") > 0,
            "not too long": F.col("minutes") < 180 * 1440,
            "not too fast": F.coalesce(F.col("speed"), F.lit(0.0)) < 2}


SPEED_SQL = f"""{TRIPS}, timed AS (SELECT *, date_diff('minute', pickup, dropoff) AS minutes,
 distance / nullif(date_diff('minute', pickup, dropoff) / 1440.0, 0) AS speed FROM trips)"""


@query("clean_trips", f"""{SPEED_SQL} SELECT order_key, pickup, dropoff, distance, minutes, speed FROM timed
 WHERE passenger_count > 1 AND distance > 2 AND fare > 1000 AND minutes > 0 AND minutes < 180 * 1440
 AND coalesce(speed, 0) < 2""")
def clean_trips(data: Data):
    kept = cleaning.keep_all(with_speed(data, "passenger_count", "fare"), clean_conditions())
    return kept.select("order_key", "pickup", "dropoff", "distance", "minutes", "speed")


@query("clean_step_counts", f"""{SPEED_SQL}, c AS (SELECT count(*) AS n0,
 count(*) FILTER (passenger_count > 1) AS n1,
 count(*) FILTER (passenger_count > 1 AND distance > 2) AS n2,
 count(*) FILTER (passenger_count > 1 AND distance > 2 AND fare > 1000) AS n3,
 count(*) FILTER (passenger_count > 1 AND distance > 2 AND fare > 1000 AND minutes > 0) AS n4,
 count(*) FILTER (passenger_count > 1 AND distance > 2 AND fare > 1000 AND minutes > 0 AND minutes < 259200) AS n5,
 count(*) FILTER (passenger_count > 1 AND distance > 2 AND fare > 1000 AND minutes > 0 AND minutes < 259200
                  AND coalesce(speed, 0) < 2) AS n6 FROM timed),
 s AS (SELECT 1 AS step_no, 'has passengers' AS step, n0 AS rows_before, n1 AS rows_after FROM c
 UNION ALL SELECT 2, 'has distance', n1, n2 FROM c UNION ALL SELECT 3, 'has fare', n2, n3 FROM c
 UNION ALL SELECT 4, 'positive duration', n3, n4 FROM c UNION ALL SELECT 5, 'not too long', n4, n5 FROM c
 UNION ALL SELECT 6, 'not too fast', n5, n6 FROM c)
 SELECT *, round((rows_before - rows_after) * 100.0::DOUBLE / nullif(rows_before, 0), 6) AS dropped_pct FROM s""")
def clean_step_counts(data: Data):
    steps = cleaning.step_counts(with_speed(data, "passenger_count", "fare"), clean_conditions())
    return steps.withColumn("dropped_pct", F.round(F.col("dropped_pct").cast("double"), 6))


@query("duration_speed", f"{SPEED_SQL} SELECT order_key, pickup, dropoff, distance, minutes, speed FROM timed")
def duration_speed(data: Data):
    return with_speed(data).select("order_key", "pickup", "dropoff", "distance", "minutes", "speed")


@query("speed_default_zero", f"""{SPEED_SQL} SELECT order_key, minutes,
 CASE WHEN minutes > 0 THEN distance / (minutes / 1440.0) ELSE 0.0 END AS speed FROM timed""")
def speed_default_zero(data: Data):
    speed = numbers.ratio_or_zero(F.col("distance"), F.col("minutes") / F.lit(1440.0))
    return with_speed(data).select("order_key", "minutes", speed.alias("speed"))


@query("count_on_date", "SELECT count(*) AS n FROM orders WHERE CAST(o_orderdate AS DATE) = DATE '1996-06-15'")
def count_on_date(data: Data):
    return data.table("orders").filter(times.on_date("o_orderdate", "1996-06-15")).agg(F.count("*").alias("n"))


@query("count_start_end_date", """SELECT count(*) AS n FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'
 AND CAST(l_shipdate AS DATE) BETWEEN DATE '1996-06-01' AND DATE '1996-06-30'""")
def count_start_end_date(data: Data):
    trips = data.trips("pickup", "dropoff")
    return trips.filter(times.within("pickup", "1996-06-01", "1996-07-01")
                        & times.within("dropoff", "1996-06-01", "1996-07-01")).agg(F.count("*").alias("n"))


@query("count_date_range", """SELECT count(*) FILTER (o_orderdate BETWEEN '1996-06-01' AND '1996-06-30') AS inclusive,
 count(*) FILTER (o_orderdate >= '1996-06-01' AND o_orderdate < '1996-06-30') AS half_open FROM orders""")
def count_date_range(data: Data):
    first, last = (F.lit(d).cast("timestamp_ntz") for d in ("1996-06-01", "1996-06-30"))
    orders = data.table("orders").filter(F.col("o_orderdate").between(first, last))
    return orders.agg(F.count("*").alias("inclusive"),
                      F.count_if(times.within("o_orderdate", "1996-06-01", "1996-06-30")).alias("half_open"))


@query("count_in_list", "SELECT count(*) AS n FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')")
def count_in_list(data: Data):
    return data.table("orders").filter(F.col("o_orderpriority").isin("1-URGENT", "5-LOW")).agg(
        F.count("*").alias("n"))


@query("null_location_rows", f"""{TRIPS} SELECT order_key, pickup_id, dropoff_id,
 pickup_id IS NULL AND dropoff_id IS NULL AS both_missing FROM trips
 WHERE pickup_id IS NULL OR dropoff_id IS NULL""")
def null_location_rows(data: Data):
    missing = [F.col(c).isNull() for c in ("pickup_id", "dropoff_id")]
    return (data.trips("order_key", "pickup_id", "dropoff_id").filter(missing[0] | missing[1])
            .withColumn("both_missing", missing[0] & missing[1]))


@query("row_hash", f"""{TRIPS} SELECT order_key, md5(coalesce(CAST(vendor_code AS VARCHAR), '')
 || coalesce(strftime(pickup, '%Y-%m-%d %H:%M:%S'), '') || coalesce(strftime(dropoff, '%Y-%m-%d %H:%M:%S'), '')
 || coalesce(CAST(pickup_id AS VARCHAR), '') || coalesce(CAST(dropoff_id AS VARCHAR), '')
 || coalesce(CAST(CAST(fare AS DECIMAL(18,2)) AS VARCHAR), '')
 || coalesce(CAST(CAST(distance AS DECIMAL(18,2)) AS VARCHAR), '')) AS unique_row_id FROM trips""")
def row_hash(data: Data):
    trips = data.trips("order_key", "vendor_code", "pickup", "dropoff", "pickup_id", "dropoff_id", "fare", "distance")
    key = keys.row_hash("vendor_code", "pickup", "dropoff", "pickup_id", "dropoff_id",
                        numbers.money("fare"), numbers.money("distance"))
    return trips.select("order_key", key.alias("unique_row_id"))


@query("surrogate_key", f"""{TRIPS} SELECT order_key,
 md5(coalesce(CAST(vendor_code AS VARCHAR), '{keys.NULL_PART}') || '-'
 || coalesce(strftime(pickup, '%Y-%m-%d %H:%M:%S'), '{keys.NULL_PART}') || '-'
 || coalesce(CAST(pickup_id AS VARCHAR), '{keys.NULL_PART}') || '-' || coalesce(service_type, '{keys.NULL_PART}'))
 AS trip_id FROM trips""")
def surrogate_key(data: Data):
    parts = ("vendor_code", "pickup", "pickup_id", "service_type")
    return data.trips("order_key", *parts).select("order_key", keys.surrogate_key(*parts).alias("trip_id"))


@query("case_payment_label", """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Credit card'
 WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge' WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided trip'
 ELSE 'Unknown' END AS payment_description FROM lineitem""")
def case_payment_label(data: Data):
    label = labels.labelled("l_linenumber", labels.PAYMENT_LABELS, labels.PAYMENT_DEFAULT)
    return data.table("lineitem").select("l_orderkey", "l_linenumber", label.alias("payment_description"))


@query("case_from_dict", """SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN 'Creative Mobile Technologies'
 WHEN 2 THEN 'VeriFone Inc.' WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM lineitem""")
def case_from_dict(data: Data):
    name = labels.labelled("l_linenumber", labels.VENDOR_NAMES)
    return data.table("lineitem").select("l_orderkey", "l_linenumber", name.alias("vendor_name"))


@query("distance_buckets", """SELECT CASE WHEN l_quantity < 1 THEN '< 1 mile' WHEN l_quantity < 3 THEN '1–3 miles'
 WHEN l_quantity < 10 THEN '3–10 miles' ELSE '10+ miles' END AS distance_bucket, count(*) AS trips
 FROM lineitem GROUP BY 1""")
def distance_buckets(data: Data):
    bucket = labels.bucketed("l_quantity", labels.DISTANCE_EDGES, labels.DISTANCE_LABELS)
    return data.table("lineitem").groupBy(bucket.alias("distance_bucket")).agg(F.count("*").alias("trips"))


@query("trip_segments", """SELECT CASE WHEN l_quantity <= 1 THEN 'up to 1' WHEN l_quantity <= 3 THEN '1 to 3'
 WHEN l_quantity <= 7 THEN '3 to 7' WHEN l_quantity <= 10 THEN '7 to 10' ELSE 'over 10' END AS segment,
 count(*) AS trips FROM lineitem GROUP BY 1""")
def trip_segments(data: Data):
    segment = labels.bucketed("l_quantity", labels.SEGMENT_EDGES, labels.SEGMENT_LABELS, upper_inclusive=True)
    return data.table("lineitem").groupBy(segment.alias("segment")).agg(F.count("*").alias("trips"))


@query("safe_cast", """SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS as_number,
 TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS first_digit FROM orders""")
def safe_cast(data: Data):
    return data.table("orders").select(
        "o_orderkey", numbers.safe_cast("o_orderpriority", "int").alias("as_number"),
        numbers.safe_cast(F.substring("o_orderpriority", 1, 1), "int").alias("first_digit"))


@query("distinct_vendors_in_range", f"""{TRIPS} SELECT DISTINCT vendor_code FROM trips
 WHERE pickup >= '1996-06-01' AND pickup < '1996-07-01'""")
def distinct_vendors_in_range(data: Data):
    trips = data.trips("vendor_code", "pickup")
    return trips.filter(times.within("pickup", "1996-06-01", "1996-07-01")).select("vendor_code").distinct()


@query("dim_vendors", """SELECT DISTINCT nullif(l_linenumber % 5, 0) AS vendor_id,
 CASE nullif(l_linenumber % 5, 0) WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc.'
 WHEN 4 THEN 'Unknown/Other' END AS vendor_name FROM lineitem""")
def dim_vendors(data: Data):
    return (data.trips("vendor_code").distinct().withColumnRenamed("vendor_code", "vendor_id")
            .withColumn("vendor_name", labels.labelled("vendor_id", labels.VENDOR_NAMES)))


@query("drop_any_null", f"""{TRIPS} SELECT order_key, vendor_code, pickup_id, dropoff_id, payment_code FROM trips
 WHERE vendor_code IS NOT NULL AND pickup_id IS NOT NULL AND dropoff_id IS NOT NULL AND payment_code IS NOT NULL""")
def drop_any_null(data: Data):
    return data.trips("order_key", "vendor_code", "pickup_id", "dropoff_id", "payment_code").na.drop()


@query("dev_sample", f"""{TRIPS} SELECT order_key, pickup, fare FROM trips
 WHERE pickup >= '1996-01-01' AND pickup < '1996-02-01'""")
def dev_sample(data: Data):
    trips = data.trips("order_key", "pickup", "fare")
    return cleaning.sample_in_dev(trips, "pickup", "1996-01-01", "1996-02-01", "dev")


@query("last_n_days", """SELECT o_orderkey, o_orderdate FROM orders
 WHERE o_orderdate >= (SELECT max(CAST(o_orderdate AS DATE)) - 30 FROM orders)""")
def last_n_days(data: Data):
    orders = data.table("orders").select("o_orderkey", "o_orderdate")
    return cleaning.last_days(orders, "o_orderdate", cleaning.days_back(30))


@query("mask_columns", "SELECT c_custkey, sha256(c_name) AS c_name, c_mktsegment FROM customer")
def mask_columns(data: Data):
    return cleaning.masked(data.table("customer").select("c_custkey", "c_name", "c_mktsegment"), "c_name")


@query("cte_second_largest", """WITH r AS (SELECT o_orderkey, o_orderdate, o_totalprice,
 rank() OVER (ORDER BY o_totalprice DESC) AS rnk FROM orders)
 SELECT o_orderkey, o_orderdate, o_totalprice FROM r WHERE rnk = 2""")
def cte_second_largest(data: Data):
    # Rank 2 exists only if the largest value is unique; it is then the largest of the rest.
    data.table("orders").createOrReplaceTempView("meterlane_orders")
    return data.spark.sql("""
        WITH largest AS (SELECT max(o_totalprice) AS top FROM meterlane_orders),
             holders AS (SELECT count(*) AS n FROM meterlane_orders
                         WHERE o_totalprice = (SELECT top FROM largest)),
             second AS (SELECT max(o_totalprice) AS value FROM meterlane_orders
                        WHERE o_totalprice < (SELECT top FROM largest))
        SELECT o_orderkey, o_orderdate, o_totalprice FROM meterlane_orders
        WHERE o_totalprice = (SELECT value FROM second) AND (SELECT n FROM holders) = 1""")


@query("count_zero_values", """SELECT count(*) FILTER (l_discount = 0) AS zero_discount,
 count(*) FILTER (l_discount = 0 AND l_tax = 0) AS both_zero FROM lineitem""")
def count_zero_values(data: Data):
    zero = F.col("l_discount") == 0
    return data.table("lineitem").agg(F.count_if(zero).alias("zero_discount"),
                                      F.count_if(zero & (F.col("l_tax") == 0)).alias("both_zero"))


@query("delete_where", f"""{TRIPS} SELECT order_key, pickup_id, fare FROM trips
 WHERE NOT coalesce(pickup_id = 3 AND fare > 50000, false)""")
def delete_where(data: Data):
    path = new_path(data.spark, "delete-where")
    versioned.load(data.trips("order_key", "pickup_id", "fare"), path)
    for _ in range(2):
        table = versioned.delete_where(data.spark, path, (F.col("pickup_id") == 3) & (F.col("fare") > 50000))
    return table
