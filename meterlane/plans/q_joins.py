"""Joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.functions import labels
from meterlane.functions.numbers import rounded, total
from meterlane.functions.times import truncated
from meterlane.operators import joins
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.sqltext import BOTH
from meterlane.plans.stand_ins import IS_YELLOW_SQL, Data

ROLES = {"pickup": "pickup_id", "dropoff": "dropoff_id"}


def zone_label(prefix: str):
    return F.concat(F.col(f"{prefix}_borough"), F.lit(" / "), F.col(f"{prefix}_zone"))


LABELS_SQL = """zpu.borough || ' / ' || zpu.zone AS pickup_loc, zdo.borough || ' / ' || zdo.zone AS dropoff_loc"""


def labelled_trips(data: Data, how: str):
    trips = data.trips("order_key", "pickup_id", "dropoff_id")
    joined = joins.with_roles(trips, data.zones(), "location_id", ROLES, how)
    return joined.select("order_key", zone_label("pickup").alias("pickup_loc"),
                         zone_label("dropoff").alias("dropoff_loc"))


@query("join_implicit", f"""{BOTH} SELECT order_key, {LABELS_SQL} FROM trips t, zones zpu, zones zdo
 WHERE t.pickup_id = zpu.location_id AND t.dropoff_id = zdo.location_id""")
def join_implicit(data: Data):
    data.trips("order_key", "pickup_id", "dropoff_id").createOrReplaceTempView("meterlane_trips")
    data.zones().createOrReplaceTempView("meterlane_zones")
    return data.spark.sql("""
        SELECT t.order_key, concat(zpu.borough, ' / ', zpu.zone) AS pickup_loc,
               concat(zdo.borough, ' / ', zdo.zone) AS dropoff_loc
        FROM meterlane_trips t, meterlane_zones zpu, meterlane_zones zdo
        WHERE t.pickup_id = zpu.location_id AND t.dropoff_id = zdo.location_id""")


@query("join_roleplay_inner", f"""{BOTH} SELECT order_key, {LABELS_SQL} FROM trips t
 JOIN zones zpu ON t.pickup_id = zpu.location_id JOIN zones zdo ON t.dropoff_id = zdo.location_id""")
def join_roleplay_inner(data: Data):
    return labelled_trips(data, "inner")


@query("join_left_roleplay", f"""{BOTH} SELECT order_key, {LABELS_SQL} FROM trips t
 LEFT JOIN zones zpu ON t.pickup_id = zpu.location_id LEFT JOIN zones zdo ON t.dropoff_id = zdo.location_id""")
def join_left_roleplay(data: Data):
    return labelled_trips(data, "left")


def zone_months(frame: DataFrame, name: str) -> DataFrame:
    return frame.groupBy(truncated("month", "pickup").alias("month"), "pickup_id").agg(
        total("total").alias(f"{name}_amount"), F.count("*").alias(f"{name}_trips"))


@query("green_yellow_outer", f"""{BOTH}, g AS (SELECT date_trunc('month', pickup) AS month, pickup_id,
 {sqltext.total('total')} AS green_amount, count(*) AS green_trips FROM trips WHERE NOT ({IS_YELLOW_SQL})
 AND pickup >= '1996-01-01' GROUP BY 1, 2), y AS (SELECT date_trunc('month', pickup) AS month, pickup_id,
 {sqltext.total('total')} AS yellow_amount, count(*) AS yellow_trips FROM trips WHERE {IS_YELLOW_SQL}
 AND pickup >= '1996-01-01' GROUP BY 1, 2)
 SELECT CAST(month AS TIMESTAMP) AS month, green_amount, green_trips, yellow_amount, yellow_trips, borough, zone
 FROM g FULL JOIN y USING (month, pickup_id) JOIN zones ON pickup_id = location_id""")
def green_yellow_outer(data: Data):
    since = F.col("pickup") >= F.lit("1996-01-01").cast("timestamp_ntz")
    green = zone_months(data.green("pickup", "pickup_id", "total").filter(since), "green")
    yellow = zone_months(data.yellow("pickup", "pickup_id", "total").filter(since), "yellow")
    both = joins.outer_on_keys(green, yellow, ["month", "pickup_id"])
    named = joins.lookup(both, data.zones(), F.col("pickup_id") == F.col("location_id"), "inner")
    return rounded(named.drop("location_id", "pickup_id"), 4, "green_amount", "yellow_amount")


@query("join_right", f"""{BOTH} SELECT order_key, {LABELS_SQL} FROM trips t
 RIGHT JOIN zones zpu ON t.pickup_id = zpu.location_id JOIN zones zdo ON t.dropoff_id = zdo.location_id""")
def join_right(data: Data):
    trips, zones = data.trips("order_key", "pickup_id", "dropoff_id"), data.zones()
    pickup = zones.toDF("location_id", "pickup_zone", "pickup_borough")
    dropoff = zones.toDF("dropoff_location", "dropoff_zone", "dropoff_borough")
    kept = trips.join(pickup, F.col("pickup_id") == F.col("location_id"), "right")
    both = joins.lookup(kept, dropoff, F.col("dropoff_id") == F.col("dropoff_location"), "inner")
    return both.select("order_key", zone_label("pickup").alias("pickup_loc"),
                       zone_label("dropoff").alias("dropoff_loc"))


@query("join_coalesce_key", """SELECT l_orderkey AS order_key, coalesce(pc, 0) AS payment_type,
 coalesce(CASE coalesce(pc, 0) WHEN 0 THEN 'Unknown' WHEN 1 THEN 'Credit card' END, 'Unknown')
 AS payment_type_description FROM (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 END AS pc FROM lineitem)""")
def join_coalesce_key(data: Data):
    # The lookup leaves code 2 out, so those trips fall back to the default.
    lookup = data.spark.createDataFrame([(0, "Unknown"), (1, "Credit card")], "code int, description string")
    key = F.coalesce("payment_code", F.lit(0))
    joined = joins.lookup(data.trips("order_key", "payment_code"), lookup, key == F.col("code"))
    return joined.select("order_key", key.alias("payment_type"),
                         F.coalesce("description", F.lit(labels.PAYMENT_DEFAULT)).alias("payment_type_description"))


@query("seed_lookup", """SELECT l_orderkey AS order_key, l_returnflag AS payment_type,
 CASE l_returnflag WHEN 'A' THEN 'Credit card' WHEN 'N' THEN 'Cash' END AS description FROM lineitem""")
def seed_lookup(data: Data):
    seed = data.spark.createDataFrame([("A", "Credit card"), ("N", "Cash")], "code string, description string")
    joined = joins.lookup(data.trips("order_key", "payment_type"), seed, F.col("payment_type") == F.col("code"))
    return joined.drop("code")


@query("join_left_then_inner", f"""{BOTH} SELECT order_key, concat(zpu.borough, ' / ', zpu.zone) AS pickup_loc,
 concat(zdo.borough, ' / ', zdo.zone) AS dropoff_loc FROM trips t LEFT JOIN zones zpu ON t.pickup_id = zpu.location_id
 JOIN zones zdo ON t.dropoff_id = zdo.location_id""")
def join_left_then_inner(data: Data):
    trips = data.trips("order_key", "pickup_id", "dropoff_id")
    left = joins.with_roles(trips, data.zones(), "location_id", {"pickup": "pickup_id"}, "left")
    both = joins.with_roles(left, data.zones(), "location_id", {"dropoff": "dropoff_id"}, "inner")
    parts = {p: F.concat_ws("", f"{p}_borough", F.lit(" / "), f"{p}_zone") for p in ROLES}
    return both.select("order_key", parts["pickup"].alias("pickup_loc"), parts["dropoff"].alias("dropoff_loc"))


@query("join_outer_then_inner", f"""{BOTH} SELECT zpu.zone AS pickup_zone, zdo.zone AS dropoff_zone, count(*) AS trips
 FROM trips t FULL JOIN zones zpu ON t.pickup_id = zpu.location_id JOIN zones zdo ON t.dropoff_id = zdo.location_id
 GROUP BY 1, 2""")
def join_outer_then_inner(data: Data):
    # Counting pairs of ids first leaves one small row per pair for the full join.
    pairs = data.trips("pickup_id", "dropoff_id").groupBy("pickup_id", "dropoff_id").agg(F.count("*").alias("trips"))
    pickup = data.zones().select(F.col("location_id").alias("p_id"), F.col("zone").alias("pickup_zone"))
    dropoff = data.zones().select(F.col("location_id").alias("d_id"), F.col("zone").alias("dropoff_zone"))
    full = pairs.join(pickup, F.col("pickup_id") == F.col("p_id"), "full")
    both = joins.lookup(full, dropoff, F.col("dropoff_id") == F.col("d_id"), "inner")
    return both.groupBy("pickup_zone", "dropoff_zone").agg(F.sum("trips").alias("trips"))


@query("not_in_zones", f"""{BOTH} SELECT order_key, pickup_id, dropoff_id FROM trips
 WHERE pickup_id NOT IN (SELECT location_id FROM zones WHERE borough <> 'ASIA')
    OR dropoff_id NOT IN (SELECT location_id FROM zones WHERE borough <> 'ASIA')""")
def not_in_zones(data: Data):
    known = data.zones().filter(F.col("borough") != "ASIA")
    trips = data.trips("order_key", "pickup_id", "dropoff_id")
    return joins.not_in_either(trips, known, "location_id", ["pickup_id", "dropoff_id"])


@query("known_zones_only", f"""{BOTH} SELECT order_key, pickup_id, dropoff_id FROM trips t
 JOIN zones zpu ON t.pickup_id = zpu.location_id JOIN zones zdo ON t.dropoff_id = zdo.location_id
 WHERE zpu.borough <> 'ASIA' AND zdo.borough <> 'ASIA'""")
def known_zones_only(data: Data):
    known = data.zones().filter(F.col("borough") != "ASIA")
    trips = data.trips("order_key", "pickup_id", "dropoff_id")
    return joins.only_known(trips, known, "location_id", ["pickup_id", "dropoff_id"])


@query("latest_dropoff_zone", f"""{BOTH}, t AS (SELECT max(dropoff) AS latest_dropoff_time FROM trips
 WHERE dropoff_id IS NOT NULL) SELECT DISTINCT zone AS taxi_zone, latest_dropoff_time FROM t, trips
 JOIN zones ON dropoff_id = location_id WHERE dropoff = latest_dropoff_time""")
def latest_dropoff_zone(data: Data):
    trips = data.trips("dropoff", "dropoff_id").filter(F.col("dropoff_id").isNotNull())
    zoned = joins.lookup(joins.at_latest(trips, "dropoff"), data.zones(),
                         F.col("dropoff_id") == F.col("location_id"), "inner")
    return zoned.select(F.col("zone").alias("taxi_zone"),
                        F.col("dropoff").alias("latest_dropoff_time")).distinct()


@query("busiest_last_17h", """SELECT user_id, count(*) AS n FROM events
 WHERE ts >= (SELECT max(ts) - INTERVAL 17 HOURS FROM events) GROUP BY 1 ORDER BY n DESC, user_id LIMIT 3""")
def busiest_last_17h(data: Data):
    recent = joins.since_latest(data.events().select("ts", "user_id"), "ts", "INTERVAL 17 HOURS")
    return recent.groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(3)


@query("join_strategy_hints", f"""WITH s AS (SELECT s_nationkey, count(*) AS trips,
 {sqltext.total('l_extendedprice', 2)} AS revenue FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1)
 SELECT h.hint, s.* FROM s CROSS JOIN (VALUES ('broadcast'), ('merge'), ('shuffle_hash')) h(hint)""")
def join_strategy_hints(data: Data):
    lines = data.table("lineitem").select("l_suppkey", "l_extendedprice")
    suppliers = data.table("supplier").select("s_suppkey", "s_nationkey")
    results = []
    for hint in ("broadcast", "merge", "shuffle_hash"):
        # Too many suppliers for a broadcast leave that choice to the optimizer.
        hinted = suppliers if hint == "broadcast" else suppliers.hint(hint)
        joined = lines.join(hinted, F.col("l_suppkey") == F.col("s_suppkey"))
        results.append(joined.groupBy(F.lit(hint).alias("hint"), "s_nationkey").agg(
            F.count("*").alias("trips"), total("l_extendedprice").alias("revenue")))
    return rounded(reduce(DataFrame.unionByName, results), 2, "revenue")


@query("interval_join", """SELECT l.event_id AS left_id, r.event_id AS right_id, l.user_id, l.ts AS dropoff_at,
 r.ts AS pickup_at FROM events l JOIN events r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL 20 MINUTES AND l.ts + INTERVAL 20 MINUTES
 WHERE l.event_type = 'click' AND r.event_type = 'purchase'
 AND abs(epoch_us(l.ts) - epoch_us(r.ts)) // 60000000 <= 10""")
def interval_join(data: Data):
    lefts, rights = interval_sides(data.events())
    pairs = joins.near_in_time(lefts, rights, "user_id", "dropoff_at", "pickup_at", 11 * 60)
    apart = F.abs(F.unix_micros(F.col("dropoff_at").cast("timestamp"))
                  - F.unix_micros(F.col("pickup_at").cast("timestamp")))
    return pairs.filter(F.floor(apart / 60_000_000) <= 10)


def interval_sides(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clicks end a ride, purchases start one."""
    lefts = events.filter("event_type = 'click'").select(
        F.col("event_id").alias("left_id"), "user_id", F.col("ts").alias("dropoff_at"))
    rights = events.filter("event_type = 'purchase'").select(
        F.col("event_id").alias("right_id"), "user_id", F.col("ts").alias("pickup_at"))
    return lefts, rights

