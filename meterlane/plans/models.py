"""The layered model: staging, intermediate, mart, report; one function per layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlane.functions import keys, labels, times
from meterlane.operators import cleaning, joins, reports, unions


# The marts' eight amounts and two averages: column of the mart -> column of the trips.
MART_SUMS = {
    "revenue_monthly_fare": "fare", "revenue_monthly_extra": "extra", "revenue_monthly_tax": "tax",
    "revenue_monthly_tip_amount": "tip", "revenue_monthly_tolls_amount": "tolls",
    "revenue_monthly_ehail_fee": "ehail_fee", "revenue_monthly_improvement_surcharge": "surcharge",
    "revenue_monthly_total_amount": "total"}
MART_AVERAGES = {"avg_monthly_passenger_count": "passenger_count", "avg_monthly_trip_distance": "distance"}


def trips_unioned(green: DataFrame, yellow: DataFrame) -> DataFrame:
    """Both services under one schema; yellow lacks two of green's columns."""
    return unions.aligned(
        {"Green": green, "Yellow": yellow},
        {"Yellow": {"trip_type": (1, "int"), "ehail_fee": (0, "double")}})


def trips_enriched(unioned: DataFrame, payment_types: DataFrame) -> DataFrame:
    """Surrogate key and payment label, then the first trip per key."""
    trip_key = ("vendor_code", "pickup", "pickup_id", "service_type")
    code = F.coalesce("payment_code", F.lit(0))
    labelled = (joins.lookup(unioned, payment_types, code == F.col("payment_type"))
                .withColumn("trip_id", keys.surrogate_key(*trip_key))
                .withColumn("payment_type", code)
                .withColumn("payment_type_description", F.coalesce("description", F.lit(labels.PAYMENT_DEFAULT)))
                .drop("description", "payment_code"))
    # Earliest drop-off first; the other columns make the choice among ties repeatable.
    order = [F.col(c).asc_nulls_last() for c in ("dropoff", "order_key", "distance", "fare")]
    return cleaning.first_per_key(labelled, trip_key, order)


def fact_trips(enriched: DataFrame, zones: DataFrame) -> DataFrame:
    """Trips with both zones and the duration; trips with unknown zones stay."""
    roles = {"pickup": "pickup_id", "dropoff": "dropoff_id"}
    return (joins.with_roles(enriched, zones, "location_id", roles, "left")
            .withColumn("trip_duration_minutes", times.minutes_crossed("pickup", "dropoff")))


def monthly_zone_revenue(facts: DataFrame) -> DataFrame:
    return reports.monthly_zone_mart(
        facts, F.coalesce("pickup_zone", F.lit("Unknown Zone")), "pickup", "service_type",
        sums=MART_SUMS, trip="trip_id", averages=MART_AVERAGES)


def payment_types(spark) -> DataFrame:
    rows = [(0, labels.PAYMENT_DEFAULT), *labels.PAYMENT_LABELS.items()]
    return spark.createDataFrame(rows, "payment_type int, description string")
