"""Queries over dated events."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.functions import text, times
from quillspark.operators import calendar, documents
from quillspark.plans.book import Book, read

book = Book()
PRIORITY = {"purchase": 1, "click": 2, "view": 3}
AS_OF = "2024-01-10 00:00:00"
_CASE = "CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 END"


def _as_of():
    return F.lit(AS_OF).cast("timestamp_ntz")


@book.add(f"""
SELECT event_id, user_id, event_type, CAST(ts AS DATE) AS event_date FROM (
  SELECT *, {_CASE} AS p, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), {_CASE} IS NULL ORDER BY {_CASE}, ts, event_id) AS nth FROM events)
WHERE p IS NULL OR nth = 1""")
def event_priority_dedupe(spark, sf_dir):
    events = read(spark, sf_dir, "events").withColumn("event_date", F.to_date("ts"))
    kept = calendar.dedupe(events, [F.col("user_id"), F.col("event_date")], calendar.priority_of(F.col("event_type"), PRIORITY), [F.col("ts"), F.col("event_id")])
    return kept.select("event_id", "user_id", "event_type", "event_date")


@book.add("""
SELECT c_custkey AS event_id, coalesce(n_name, 'Unknown') AS institution_name, coalesce(r_name, 'Unknown') AS institution_type, c_mktsegment AS event_type,
  'Contact: ' || c_name || CASE WHEN c_acctbal > 0 THEN ' | Phone: ' || CAST(c_custkey AS VARCHAR) ELSE '' END AS contact_info
FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 5 <> 0) n ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def event_enriched(spark, sf_dir):
    dim = read(spark, sf_dir, "nation").where("n_nationkey % 5 <> 0").join(calendar.small(read(spark, sf_dir, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    phone = F.when(F.col("c_acctbal") > 0, F.col("c_custkey").cast("string"))
    rows = read(spark, sf_dir, "customer").join(calendar.small(dim), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return rows.select(F.col("c_custkey").alias("event_id"), F.coalesce("n_name", F.lit("Unknown")).alias("institution_name"), F.coalesce("r_name", F.lit("Unknown")).alias("institution_type"), F.col("c_mktsegment").alias("event_type"), calendar.contact(F.col("c_name"), phone, F.lit(None).cast("string")).alias("contact_info"))


_ENRICHED = """
SELECT CAST(event_id AS VARCHAR) AS event_id, 'U' || user_id % 7 AS ticker, coalesce(n_name, 'Unknown') AS institution_name, n_nationkey AS institution_id, event_type,
  CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS DATE) AS event_date,
  strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', '%H:%M') || CASE WHEN date_diff('hour', (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', ts) = 5 THEN ' EST' ELSE ' EDT' END AS event_time_local
FROM events LEFT JOIN nation ON user_id % 7 = n_nationkey AND n_nationkey < 5"""


def calendar_events(spark, sf_dir):
    """events in the shape of a service's answer, with nations as institutions."""
    events = read(spark, sf_dir, "events")
    missing = F.lit(None).cast("string")
    found = events.select(F.col("event_id").cast("string").alias("event_id"), F.concat(F.lit("U"), F.col("user_id") % 7).alias("ticker"), "event_type", F.col("props").alias("description"), F.col("ts").cast("timestamp").alias("event_date_time"), missing.alias("webcast_link"), missing.alias("contact_name"), missing.alias("contact_phone"), missing.alias("contact_email"), F.year("ts").alias("fiscal_year"), F.concat(F.lit("Q"), F.quarter("ts")).alias("fiscal_period"))
    dim = read(spark, sf_dir, "nation").where("n_nationkey < 5").select(F.concat(F.lit("U"), F.col("n_nationkey")).alias("ticker"), F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.lit("Nation").alias("type"))
    return calendar.enrich(found, dim)


@book.add(_ENRICHED)
def calendar_chain(spark, sf_dir):
    return calendar_events(spark, sf_dir).select("event_id", "ticker", "institution_name", "institution_id", "event_type", "event_date", "event_time_local")


@book.add("""
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS DATE) AS local_date, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', '%H:%M') AS local_time,
  strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Halifax', '%H:%M') || ' AST' AS second_time FROM events""")
def event_local_time(spark, sf_dir):
    ts = F.col("ts").cast("timestamp")
    return read(spark, sf_dir, "events").select("event_id", times.local_date(ts).alias("local_date"), F.date_format(times.local(ts), "HH:mm").alias("local_time"), F.concat(F.date_format(times.local(ts, "America/Halifax"), "HH:mm"), F.lit(" AST")).alias("second_time"))


@book.add(f"SELECT event_id, user_id, event_type FROM events WHERE ts > TIMESTAMP '{AS_OF}' AND ts <= TIMESTAMP '{AS_OF}' + INTERVAL 30 DAY")
def events_next_30d(spark, sf_dir):
    return calendar.upcoming(read(spark, sf_dir, "events"), "ts", _as_of(), 30).select("event_id", "user_id", "event_type")


@book.add(f"SELECT event_type, count(*) AS event_count FROM events WHERE ts > TIMESTAMP '{AS_OF}' GROUP BY event_type ORDER BY event_count DESC, event_type")
def events_by_type(spark, sf_dir):
    return calendar.upcoming(read(spark, sf_dir, "events"), "ts", _as_of()).groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count")).orderBy(F.desc("event_count"), "event_type")


@book.add(f"SELECT event_id, event_type, props FROM events WHERE user_id = 7 AND ts > TIMESTAMP '{AS_OF}' ORDER BY ts, event_id")
def events_for_user(spark, sf_dir):
    read(spark, sf_dir, "events").createOrReplaceTempView("calendar_events")
    return spark.sql(f"SELECT event_id, event_type, props FROM calendar_events WHERE user_id = 7 AND ts > TIMESTAMP_NTZ '{AS_OF}' ORDER BY ts, event_id")


@book.add(f"SELECT event_id, user_id FROM events WHERE event_type = 'purchase' AND ts > TIMESTAMP '{AS_OF}'")
def events_of_one_type(spark, sf_dir):
    read(spark, sf_dir, "events").createOrReplaceTempView("calendar_events")
    return spark.sql(f"SELECT event_id, user_id FROM calendar_events WHERE event_type = 'purchase' AND ts > TIMESTAMP_NTZ '{AS_OF}'")


@book.add(f"SELECT count(*) FILTER (ts > TIMESTAMP '{AS_OF}') AS upcoming, count(*) FILTER (ts <= TIMESTAMP '{AS_OF}') AS past FROM events")
def upcoming_past(spark, sf_dir):
    return calendar.upcoming_and_past(read(spark, sf_dir, "events"), "ts", _as_of())


@book.add("""
SELECT event_type, event_id, CASE WHEN length(props) > 6 THEN substr(props, 1, 6) || '...' ELSE props END AS headline, CAST(nth AS INTEGER) AS nth, n FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS nth FROM events) JOIN (SELECT event_type, count(*) AS n FROM events GROUP BY event_type) USING (event_type) WHERE nth <= 3""")
def event_type_samples(spark, sf_dir):
    events = read(spark, sf_dir, "events")
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    first = documents.samples(events, "event_type", [F.col("ts"), F.col("event_id")])
    return first.join(counts, "event_type").select("event_type", "event_id", text.preview(F.col("props"), 6).alias("headline"), "nth", "n")


@book.add("""
WITH b AS (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS z FROM orders),
r AS (SELECT CAST(a + INTERVAL (90 * i) DAY AS DATE) AS first, least(CAST(a + INTERVAL (90 * i + 89) DAY AS DATE), z) AS last FROM b, range(1000) t(i) WHERE a + INTERVAL (90 * i) DAY <= z)
SELECT first, last, count(o_orderkey) AS orders FROM r LEFT JOIN orders ON CAST(o_orderdate AS DATE) BETWEEN first AND last GROUP BY first, last""")
def date_ranges_90d(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").withColumn("day", F.to_date("o_orderdate"))
    ends = orders.agg(F.min("day").alias("a"), F.max("day").alias("z"))
    spans = ends.select(F.inline(times.ranges(F.col("a"), F.col("z"))))
    start = orders.agg(F.min("day")).scalar()
    counted = orders.groupBy(F.floor(F.date_diff("day", start) / 90).alias("i")).agg(F.count(F.lit(1)).alias("orders"))
    numbered = spans.withColumn("i", F.floor(F.date_diff("first", start) / 90))
    return numbered.join(counted, "i", "left").select("first", "last", F.coalesce("orders", F.lit(0)).alias("orders"))


@book.add("SELECT event_id, event_type FROM events WHERE event_type IN ('purchase', 'signup', 'click', 'view')")
def multi_select_filter(spark, sf_dir):
    return calendar.selected(read(spark, sf_dir, "events"), "event_type", ["purchase", "signup", "Browsing"], {"Browsing": ["click", "view"]}).select("event_id", "event_type")


@book.add("SELECT DISTINCT event_type FROM events WHERE event_type IS NOT NULL AND event_type <> '' ORDER BY event_type")
def distinct_sorted(spark, sf_dir):
    return read(spark, sf_dir, "events").where("event_type <> ''").select("event_type").distinct().orderBy("event_type")


@book.add("""
SELECT CAST(event_id AS VARCHAR) AS event_id, 'BEGIN:VEVENT' || chr(13) || chr(10) || 'UID:' || event_id || chr(13) || chr(10) || 'DTSTART:' || strftime(ts, '%Y%m%dT%H%M%SZ') || chr(13) || chr(10) || 'DTEND:' || strftime(ts + INTERVAL 1 HOUR, '%Y%m%dT%H%M%SZ')
  || chr(13) || chr(10) || 'SUMMARY:U' || user_id % 7 || ' ' || props || chr(13) || chr(10) || 'END:VEVENT' AS value FROM events WHERE event_type = 'signup'""")
def ics_export(spark, sf_dir):
    return calendar.icalendar(calendar_events(spark, sf_dir).where("event_type = 'signup'"))


@book.add("""
SELECT CAST(event_id AS VARCHAR) AS event_id, 'U' || user_id % 7 || ': ' || props AS title, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', '%Y-%m-%dT%H:%M:%S') AS start,
  CASE event_type WHEN 'purchase' THEN 'green' WHEN 'error' THEN 'red' ELSE 'grey' END AS colour FROM events""")
def calendar_view(spark, sf_dir):
    return calendar.view(calendar_events(spark, sf_dir), {"purchase": "green", "error": "red"}, "grey")


@book.add("""
SELECT CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto' AS DATE) AS local_date, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Toronto', '%A') AS weekday, count(*) AS n FROM events GROUP BY ALL ORDER BY 1""")
def events_by_weekday(spark, sf_dir):
    ts = times.local(F.col("ts").cast("timestamp"))
    return read(spark, sf_dir, "events").groupBy(F.to_date(ts).alias("local_date"), F.date_format(ts, "EEEE").alias("weekday")).agg(F.count(F.lit(1)).alias("n")).orderBy("local_date")


@book.add("""
WITH m AS (SELECT CAST(max(o_orderdate) AS DATE) AS today FROM orders)
SELECT CAST(today - INTERVAL (i) DAY AS DATE) AS day, CAST(today - INTERVAL 36 MONTH AS DATE) AS archive_from, CAST(today + INTERVAL 180 DAY AS DATE) AS calendar_to FROM m, range(8) t(i)""")
def rolling_dates(spark, sf_dir):
    today = read(spark, sf_dir, "orders").agg(F.to_date(F.max("o_orderdate")).alias("today"))
    return today.select(F.explode(times.days_back(F.col("today"), 7)).alias("day"), times.window_start(F.col("today")).alias("archive_from"), times.months_about(F.col("today"), 6).alias("calendar_to"))


@book.add("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, '{\"ids\":[' || event_id || ',' || user_id || ']}' AS packed FROM events")
def json_round_trip(spark, sf_dir):
    k = F.from_json("props", "k int")["k"]
    return read(spark, sf_dir, "events").select("event_id", k.alias("k"), F.to_json(F.struct(F.array("event_id", "user_id").alias("ids"))).alias("packed"))
