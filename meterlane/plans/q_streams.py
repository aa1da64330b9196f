"""Streams over the event table, run to the end of their input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlane.functions import times
from meterlane.functions.numbers import half_up, rounded, total
from meterlane.operators import reports, sessions
from meterlane.plans import sqltext
from meterlane.plans.catalog import query
from meterlane.plans.q_joins import interval_sides
from meterlane.plans.stand_ins import ZONES_SQL, Data
from meterlane.session import new_path
from meterlane.streaming import aggregates, decode, joins, run, sources, state

EVENT = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])
COLUMNS = EVENT.fieldNames()
WINDOW_KEY = ("window_start", "window_end", "user_id")


def stream(data: Data) -> DataFrame:
    return data.stream("events")


def as_text(frame: DataFrame) -> DataFrame:
    """Event time as text with all its digits, the way a producer sends it."""
    return frame.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("stream_source_count", "SELECT count(*) AS n FROM events")
def stream_source_count(data: Data):
    return run.complete(stream(data).agg(F.count("*").alias("n")), "source-count")


@query("stream_parse_delimited", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_parse_delimited(data: Data):
    messages = sources.as_messages(as_text(stream(data)), "user_id", COLUMNS, text="delimited")
    return run.append(decode.delimited(messages, EVENT), "delimited")


@query("stream_parse_json", "SELECT event_id, ts, user_id, event_type, value FROM events")
def stream_parse_json(data: Data):
    text_time = T.StructType([T.StructField("ts", T.StringType()) if f.name == "ts" else f for f in EVENT.fields])
    messages = sources.as_messages(as_text(stream(data)), "user_id", COLUMNS)
    decoded = decode.json(messages, text_time).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return run.append(decoded, "json")


@query("stream_pass_through", """SELECT event_id, user_id, value, epoch_ms(epoch_us(ts) // 1000) AS pickup_at FROM events""")
def stream_pass_through(data: Data):
    sent = stream(data).withColumn("millis", times.epoch_millis("ts"))
    passed = sent.select("event_id", "user_id", "value",
                         times.from_epoch_millis("millis").cast("timestamp_ntz").alias("pickup_at"))
    return run.append(passed, "pass-through")


@query("stream_filter_count", """SELECT count(*) AS n FROM events WHERE value > 50 AND event_type IN ('click', 'purchase')""")
def stream_filter_count(data: Data):
    kept = stream(data).filter((F.col("value") > 50) & F.col("event_type").isin("click", "purchase"))
    return run.complete(kept.agg(F.count("*").alias("n")), "filter-count")


@query("stream_count_by_key", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def stream_count_by_key(data: Data):
    return run.upsert(aggregates.counts_by_key(stream(data), "user_id"), "count-by-key", ["user_id"])


TUMBLE = f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR
 AS window_end, user_id, count(*) AS n, {sqltext.total('value')} AS amount
 FROM events GROUP BY 1, 2, 3"""


def hourly(frame: DataFrame) -> DataFrame:
    return aggregates.windowed(frame, "ts", "1 hour", ["user_id"], "value", late="5 seconds")


@query("stream_tumble", TUMBLE)
def stream_tumble(data: Data):
    return rounded(run.upsert(hourly(stream(data)), "tumble", WINDOW_KEY), 4, "amount")


@query("tumble_batch", TUMBLE)
def tumble_batch(data: Data):
    return rounded(hourly(data.events()), 4, "amount")


@query("window_rollup", f"""SELECT window_start, count(*) AS locations, CAST(sum(n) AS BIGINT) AS trips,
 {sqltext.total('amount')} AS revenue FROM ({TUMBLE}) GROUP BY 1""")
def window_rollup(data: Data):
    windows = run.upsert(hourly(stream(data)), "rollup", WINDOW_KEY)
    return windows.groupBy("window_start").agg(
        F.count("*").alias("locations"), F.sum("n").alias("trips"),
        half_up(total("amount"), 4).alias("revenue"))


@query("stream_proc_time_ranked")
def stream_proc_time_ranked(data: Data):
    # Three deliveries, each in the window of its own moment; the windows depend on the clock, so there is no SQL.
    path = new_path(data.spark, "proc-time")
    windows = deliver(data, feeds(data), lambda source, checkpoint: run.upsert(
        aggregates.processing_time_windows(source, "5 minutes", ["user_id"]), "proc-time", WINDOW_KEY, path, checkpoint))
    return aggregates.busiest_first(windows)


@query("stream_proc_time_window", "SELECT user_id, count(*) AS n FROM events GROUP BY 1")
def stream_proc_time_window(data: Data):
    # Which window a row falls into depends on the clock, the total per key does not.
    return stream_proc_time_ranked(data).groupBy("user_id").agg(F.sum("n").alias("n"))


HOP = """SELECT w AS window_start, w + INTERVAL 1 HOUR AS window_end, user_id, count(*) AS n FROM (
 SELECT user_id, unnest([time_bucket(INTERVAL 15 MINUTES, ts), time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 15 MINUTES,
 time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 30 MINUTES, time_bucket(INTERVAL 15 MINUTES, ts) - INTERVAL 45 MINUTES]) AS w
 FROM events) GROUP BY 1, 2, 3"""


@query("stream_hop", HOP)
def stream_hop(data: Data):
    hops = aggregates.windowed(stream(data), "ts", "1 hour", ["user_id"], slide="15 minutes", late="5 seconds")
    return run.upsert(hops, "hop", WINDOW_KEY)


@query("peak_sliding_hour", f"""SELECT window_start, CAST(sum(n) AS BIGINT) AS n FROM ({HOP}) GROUP BY 1
 ORDER BY 2 DESC, 1 LIMIT 1""")
def peak_sliding_hour(data: Data):
    hops = aggregates.windowed(data.events(), "ts", "1 hour", slide="15 minutes")
    return reports.top(hops.select("window_start", "n"), [F.desc("n"), F.asc("window_start")], 1)


def sessions_sql(minutes: int) -> str:
    return f"""WITH o AS (SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL {minutes} MINUTES
 THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o),
 g AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {minutes} MINUTES AS session_end,
 count(*) AS n_events FROM s GROUP BY user_id, sid)"""


@query("session_counts", f"{sessions_sql(60)} SELECT * FROM g")
def session_counts(data: Data):
    return sessions.sessions(data.events(), ["user_id"], "ts", 60 * 60)


@query("stream_session", f"{sessions_sql(60)} SELECT * FROM g")
def stream_session(data: Data):
    # Two halves and the mark that ends the stream: sessions are emitted once, when they are closed.
    events, path = data.events(), new_path(data.spark, "session")
    first = F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")
    parts = [events.filter(first), events.filter(~first), aggregates.end_mark(events, "ts")]
    return deliver(data, parts, lambda source, checkpoint: run.append(
        aggregates.session_windows(source, "ts", "60 minutes", ["user_id"], late="5 seconds"), "session", path, checkpoint))


@query("longest_session", f"""{sessions_sql(60)} SELECT user_id, session_start, n_events FROM g
 ORDER BY n_events DESC, session_start, user_id LIMIT 1""")
def longest_session(data: Data):
    found = session_counts(data).select("user_id", "session_start", "n_events")
    return reports.top(found, [F.desc("n_events"), F.asc("session_start"), F.asc("user_id")], 1)


HOURLY_TOTAL = f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, {sqltext.total('value')}
 AS amount, count(*) AS n FROM events GROUP BY 1"""


@query("stream_hourly_total", HOURLY_TOTAL)
def stream_hourly_total(data: Data):
    windows = aggregates.windowed(stream(data), "ts", "1 hour", amount="value", late="5 seconds")
    return rounded(run.upsert(windows, "hourly-total", ["window_start"]).drop("window_end"), 4, "amount")


@query("best_hour", f"SELECT * FROM ({HOURLY_TOTAL}) ORDER BY amount DESC, window_start LIMIT 1")
def best_hour(data: Data):
    windows = aggregates.windowed(data.events(), "ts", "1 hour", amount="value").drop("window_end")
    return reports.top(rounded(windows, 4, "amount"), [F.desc("amount"), F.asc("window_start")], 1)


@query("stream_interval_join", """SELECT l.event_id AS left_id, r.event_id AS right_id, l.user_id, l.ts AS dropoff_at,
 r.ts AS pickup_at FROM events l JOIN events r ON l.user_id = r.user_id
 AND r.ts BETWEEN l.ts - INTERVAL 20 MINUTES AND l.ts + INTERVAL 20 MINUTES
 WHERE l.event_type = 'click' AND r.event_type = 'purchase'
 AND abs(epoch_us(l.ts) - epoch_us(r.ts)) // 60000000 <= 10""")
def stream_interval_join(data: Data):
    lefts, _ = interval_sides(stream(data))
    _, rights = interval_sides(stream(data))
    pairs = joins.interval_join(lefts, rights, "user_id", "dropoff_at", "pickup_at", 20, 10, 5)
    stamps = {c: F.col(c).cast("timestamp_ntz") for c in ("dropoff_at", "pickup_at")}
    return run.append(pairs.withColumns(stamps), "interval-join")


@query("stream_static_join", f"""WITH {ZONES_SQL} SELECT event_id, user_id, zone, borough FROM events
 LEFT JOIN zones ON user_id = location_id""")
def stream_static_join(data: Data):
    enriched = joins.with_lookup(stream(data), data.zones(), "user_id", "location_id")
    return run.append(enriched.select("event_id", "user_id", "zone", "borough"), "static-join")


@query("stream_union_popularity", "SELECT user_id, count(*) AS popularity FROM events WHERE event_type IN ('click', 'view') GROUP BY 1")
def stream_union_popularity(data: Data):
    # Two topics with messages of different layout end in one stream of locations.
    clicks = sources.as_messages(stream(data).filter("event_type = 'click'"), "user_id", ["event_id", "user_id"])
    views = sources.as_messages(stream(data).filter("event_type = 'view'"), "user_id", ["user_id", "value"],
                                text="delimited")
    schema = T.StructType([T.StructField("user_id", T.LongType())])
    merged = decode.json(clicks, schema).unionByName(decode.delimited(views, schema)).na.drop()
    counted = aggregates.counts_by_key(merged, "user_id", name="popularity")
    return run.complete(counted.orderBy(F.desc("popularity"), "user_id"), "popularity")


def branches(data: Data) -> dict[str, DataFrame]:
    amount = F.col("value")
    return run.branch(stream(data).select("event_id", "value"), "branch", {"high": amount >= 40, "low": amount < 40})


@query("stream_branch_high", "SELECT event_id, value FROM events WHERE value >= 40")
def stream_branch_high(data: Data):
    return branches(data)["high"]


@query("stream_branch_low", "SELECT event_id, value FROM events WHERE value < 40")
def stream_branch_low(data: Data):
    return branches(data)["low"]


MIDDLE = "2024-01-16"


def feeds(data: Data) -> list[DataFrame]:
    """Three deliveries of the event table: the first half without purchases, the
    purchases of that half (late), the second half."""
    events, early = data.events(), F.col("ts") < F.lit(MIDDLE).cast("timestamp_ntz")
    late = F.col("event_type") == "purchase"
    return [events.filter(early & ~late), events.filter(early & late), events.filter(~early)]


def deliver(data: Data, parts: Sequence[DataFrame], work):
    """Hand ``work`` the stream of one growing folder after each delivery; same checkpoint every time."""
    folder, checkpoint = new_path(data.spark, "topic"), new_path(data.spark, "topic-state")
    result = None
    for part in parts:
        part.write.mode("append").parquet(folder)
        result = work(sources.folder(data.spark, folder, part.schema), checkpoint)
    return result


@query("late_event_policy", f"""WITH b AS (SELECT ts, time_bucket(INTERVAL 1 HOUR, ts) AS window_start,
 time_bucket(INTERVAL 1 HOUR, ts) + INTERVAL 1 HOUR AS window_end,
 event_type = 'purchase' AND ts < TIMESTAMP '{MIDDLE}' AS late FROM events)
 SELECT window_start, window_end, count(*) AS n FROM b WHERE NOT (late AND window_end <=
 (SELECT max(ts) - INTERVAL 12 HOURS FROM b WHERE NOT late AND ts < TIMESTAMP '{MIDDLE}'))
 AND window_end <= (SELECT max(ts) - INTERVAL 12 HOURS FROM b) GROUP BY 1, 2""")
def late_event_policy(data: Data):
    # Purchases arrive after the rest of their half: those of the last twelve hours are
    # still counted, older ones are dropped, and open windows are not shown.
    path = new_path(data.spark, "late")
    return deliver(data, feeds(data), lambda source, checkpoint: run.append(
        aggregates.windowed(source, "ts", "1 hour", late="12 hours"), "late", path, checkpoint))


@query("stream_upsert_windows", f"""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, user_id, count(*) AS n,
 {sqltext.total('value')} AS amount FROM events GROUP BY 1, 2""")
def stream_upsert_windows(data: Data):
    # The same deliveries under a watermark wide enough for all of them: late rows correct their window.
    # The log of changes is folded into the base after every second micro-batch.
    path = new_path(data.spark, "corrected")
    latest = deliver(data, feeds(data), lambda source, checkpoint: run.upsert(
        aggregates.windowed(source, "ts", "1 hour", ["user_id"], "value", late="60 days"), "corrected",
        ["window_start", "user_id"], path, checkpoint, fold_every=2))
    return rounded(latest.drop("window_end"), 4, "amount")


def kept_sql(size: str, late: str, keys: str) -> str:
    """Counts per window without the purchases of the first half whose window was closed when they arrived."""
    return f"""WITH b AS (SELECT *, time_bucket(INTERVAL {size}, ts) AS window_start, event_type = 'purchase'
 AND ts < TIMESTAMP '{MIDDLE}' AS late FROM events), w AS (SELECT window_start, {keys}, count(*) AS n FROM b
 WHERE NOT (late AND window_start + INTERVAL {size} <= (SELECT max(ts) - INTERVAL {late} FROM b
 WHERE NOT late AND ts < TIMESTAMP '{MIDDLE}')) GROUP BY ALL)"""


@query("stream_window_grace", f"""{kept_sql("10 SECONDS", "5 SECONDS", "user_id")}
 SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') || '@' || user_id AS windowed_key, n FROM w""")
def stream_window_grace(data: Data):
    # A row may be five seconds late: purchases that arrive after that are left out, and windows leave the state.
    path, parts = new_path(data.spark, "grace"), [*feeds(data), aggregates.end_mark(data.events(), "ts")]
    windows = deliver(data, parts, lambda source, checkpoint: run.upsert(
        aggregates.windowed(source, "ts", "10 seconds", ["user_id"], late="5 seconds"), "grace", WINDOW_KEY, path, checkpoint))
    key = F.concat(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"), F.lit("@"), F.col("user_id"))
    return windows.select(key.alias("windowed_key"), "n")


@query("stream_window_retention", f"""{kept_sql("1 MINUTE", "1 HOUR", "event_type")} SELECT * FROM w""")
def stream_window_retention(data: Data):
    # Windows are kept for an hour of event time and are then removed from the state; rows for a removed one count nowhere.
    path, parts = new_path(data.spark, "retention"), [*feeds(data), aggregates.end_mark(data.events(), "ts")]
    windows = deliver(data, parts, lambda source, checkpoint: run.upsert(
        aggregates.windowed(source, "ts", "1 minute", ["event_type"], late="1 hour"), "retention",
        ["window_start", "event_type"], path, checkpoint))
    return windows.drop("window_end")


def totals_sql(key: str) -> str:
    keyed, group = (f"{key}, ", f"GROUP BY {key}") if key else ("", "")
    return f"""SELECT {keyed}count(*) AS trips, {sqltext.total('value')} AS revenue,
 {sqltext.half_up('sum(value) / count(*)', 4)} AS avg_amount FROM events {group}"""


@query("dashboard_totals", totals_sql(""))
def dashboard_totals(data: Data):
    return rounded(run.complete(aggregates.running_totals(stream(data), [], "value"), "totals"), 4, "revenue", "avg_amount")


@query("dashboard_vendor", totals_sql("event_type"))
def dashboard_vendor(data: Data):
    totals = run.complete(aggregates.running_totals(stream(data), ["event_type"], "value"), "vendors")
    return rounded(totals, 4, "revenue", "avg_amount")


@query("dashboard_top_zones", "SELECT user_id, count(*) AS trips FROM events GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def dashboard_top_zones(data: Data):
    counted = aggregates.counts_by_key(stream(data), "user_id", name="trips")
    return run.complete(counted.orderBy(F.desc("trips"), "user_id").limit(5), "top-zones")


REPORT_EVERY = 1000


@query("dashboard_every_n", f"""WITH d AS (SELECT value, row_number() OVER w AS messages,
 sum(value) OVER (w ROWS UNBOUNDED PRECEDING) AS upto FROM events WINDOW w AS (ORDER BY CASE
 WHEN ts >= TIMESTAMP '{MIDDLE}' THEN 3 WHEN event_type = 'purchase' THEN 2 ELSE 1 END, ts, event_id))
 SELECT messages, {sqltext.half_up("upto", 4)} AS revenue, {sqltext.half_up("upto / messages", 4)} AS avg_amount
 FROM d WHERE messages % {REPORT_EVERY} = 0""")
def dashboard_every_n(data: Data):
    # Three deliveries with a restart after each: the count goes on where the last run stopped.
    path = new_path(data.spark, "every-n")
    reports = deliver(data, feeds(data), lambda source, checkpoint: run.every_n(
        source, "every-n", REPORT_EVERY, ["ts", "event_id"], "value", path, checkpoint))
    return rounded(reports, 4, "revenue", "avg_amount")


@query("stream_foreach_batch", f"SELECT event_id, event_type, {sqltext.half_up('value')} AS rounded FROM events WHERE event_type <> 'error'")
def stream_foreach_batch(data: Data):
    def peek(batch: DataFrame) -> DataFrame:
        return batch.filter("event_type <> 'error'").select("event_id", "event_type", half_up(F.col("value")).alias("rounded"))

    return run.each_batch(stream(data), "each-batch", peek)


@query("stream_memory_sink", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_memory_sink(data: Data):
    name = "memory_" + new_path(data.spark, "m").rsplit("-", 1)[1]
    return run.memory(aggregates.counts_by_key(stream(data), "event_type"), name)


@query("stream_encode_kv", """SELECT CAST(user_id AS VARCHAR) AS key, event_id || ', ' || user_id || ', ' || event_type AS value
 FROM events""")
def stream_encode_kv(data: Data):
    messages = sources.as_messages(stream(data), "user_id", ["event_id", "user_id", "event_type"], text="delimited")
    return run.append(messages, "encode")


@query("stream_restart", "SELECT event_id, event_type, value FROM events")
def stream_restart(data: Data):
    # Each restart reads the files that are new since the last run and nothing twice.
    path = new_path(data.spark, "restart")
    return deliver(data, feeds(data), lambda source, checkpoint: run.append(
        source.select("event_id", "event_type", "value"), "restart", path, checkpoint))


@query("stream_dedup", "SELECT event_id, user_id, ts FROM events")
def stream_dedup(data: Data):
    twice = stream(data).unionByName(stream(data)).select("event_id", "user_id", "ts")
    once = state.deduplicated(twice, ["event_id"], "ts", "1 hour")
    return run.append(once.withColumn("ts", F.col("ts").cast("timestamp_ntz")), "dedup")


@query("stream_validate_records", """SELECT CASE WHEN event_type = 'error' THEN 'bad' ELSE 'good' END AS verdict, count(*) AS n,
 CAST(sum(CASE WHEN event_type <> 'error' THEN event_id END) AS BIGINT) AS id_sum FROM events GROUP BY 1""")
def stream_validate_records(data: Data):
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType())])
    messages = sources.as_messages(stream(data), "event_id", ["event_id", "event_type"])
    # A producer that cuts off the end of its error messages.
    cut = F.when(F.col("value").contains('"error"'), F.expr("substring(value, 1, length(value) - 3)"))
    checked = decode.checked_json(messages.withColumn("value", F.coalesce(cut, F.col("value"))), schema)
    stored = run.append(checked, "validate")
    verdict = F.when(decode.is_bad(stored), "bad").otherwise("good")
    good_id = F.when(~decode.is_bad(stored), F.col("event_id"))
    return stored.groupBy(verdict.alias("verdict")).agg(F.count("*").alias("n"), F.sum(good_id).alias("id_sum"))


@query("stream_keyed_state", f"""SELECT user_id AS key, count(*) AS trips, {sqltext.total('value')} AS amount
 FROM events GROUP BY 1""")
def stream_keyed_state(data: Data):
    totals = run.upsert(state.keyed_totals(stream(data), "user_id", "event_id", "value"), "keyed-state", ["key", "salt"])
    return rounded(state.folded(totals), 4, "amount")
