"""Dated events: enrichment, priority de-duplication, time windows, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.functions import text, times

#: Of several announcements of one period the least number counts.
PRIORITY = {"Earnings": 1, "ConfirmedEarningsRelease": 2, "ProjectedEarningsRelease": 3}


def priority_of(kind: Column, priority: dict[str, int] = PRIORITY) -> Column:
    return F.create_map(*(F.lit(x) for kv in priority.items() for x in kv))[kind]


def contact(name: Column, phone: Column, email: Column) -> Column:
    part = lambda label, c: F.when(text.none_if_blank(c).isNotNull(), F.concat(F.lit(label), c))
    return F.concat_ws(" | ", part("Contact: ", name), part("Phone: ", phone), part("Email: ", email))


def small(dim: DataFrame, rows: int = 100_000) -> DataFrame:
    """dim with a broadcast hint if it has no more than so many rows; otherwise the join is left to Spark."""
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim


def enrich(events: DataFrame, institutions: DataFrame) -> DataFrame:
    """events(event_id, ticker, event_type, description, event_date_time, webcast_link, contact_name, contact_phone,
    contact_email, fiscal_year, fiscal_period) with institution columns and local times: 15 columns."""
    dim = institutions.select("ticker", F.col("id").alias("_id"), F.col("name").alias("_name"), F.col("type").alias("_type"))
    ts = F.col("event_date_time").cast("timestamp")
    return events.join(small(dim), "ticker", "left").select(
        "event_id", "ticker", F.coalesce("_name", F.lit("Unknown")).alias("institution_name"), F.col("_id").alias("institution_id"),
        F.coalesce("_type", F.lit("Unknown")).alias("institution_type"), F.coalesce("event_type", F.lit("Unknown")).alias("event_type"),
        F.col("description").alias("event_headline"), ts.alias("event_date_time_utc"), times.local(ts).alias("event_date_time_local"),
        times.local_date(ts).alias("event_date"), times.clock(ts).alias("event_time_local"), "webcast_link",
        contact(F.col("contact_name"), F.col("contact_phone"), F.col("contact_email")).alias("contact_info"), "fiscal_year", "fiscal_period",
    )


def dedupe(events: DataFrame, group: list[Column], priority: Column, ties: list[Column]) -> DataFrame:
    """Of the events with a priority, the first of each group by (priority, ties); all events without one."""
    ranked = events.withColumn("_p", priority)
    # events without a priority get a group of their own row, so that a frequent kind doesn't meet in one task
    own = F.when(F.col("_p").isNull(), F.struct(*ties).cast("string"))
    w = Window.partitionBy(*group, own).orderBy(F.col("_p").asc(), *ties)
    nth = F.when(F.col("_p").isNotNull(), F.row_number().over(w)).otherwise(F.lit(1))
    return ranked.withColumn("_nth", nth).where("_nth = 1").drop("_nth", "_p")


def period_key(ticker: Column, year: Column, period: Column, date: Column) -> Column:
    """ticker|year|period, or ticker|date|date where one of the two is missing."""
    full = text.none_if_blank(year.cast("string")).isNotNull() & text.none_if_blank(period).isNotNull()
    return F.when(full, F.concat_ws("|", ticker, year, period)).otherwise(F.concat_ws("|", ticker, F.lit("date"), F.coalesce(date.cast("string"), F.lit(""))))


def dedupe_announcements(events: DataFrame, ordinal: str) -> DataFrame:
    key = period_key(F.col("ticker"), F.col("fiscal_year"), F.col("fiscal_period"), F.col("event_date"))
    return dedupe(events, [key], priority_of(F.col("event_type")), [F.col(ordinal)])


def upcoming(events: DataFrame, ts: str, as_of: Column, days: int | None = None) -> DataFrame:
    late = F.col(ts) > as_of
    return events.where(late if days is None else late & (F.col(ts) <= as_of + F.make_interval(days=F.lit(days))))


def upcoming_and_past(events: DataFrame, ts: str, as_of: Column) -> DataFrame:
    n = F.count_if(F.col(ts) > as_of)
    return events.agg(n.alias("upcoming"), (F.count(F.lit(1)) - n).alias("past"))


def selected(events: DataFrame, column: str, chosen: list[str], groups: dict[str, list[str]] | None = None) -> DataFrame:
    """Rows whose value is chosen; a chosen group's name stands for its values; nothing chosen: all rows."""
    values = [v for c in chosen for v in (groups or {}).get(c, [c])]
    return events.where(F.col(column).isin(values)) if chosen else events


def view(events: DataFrame, colours: dict[str, str], other: str) -> DataFrame:
    """title, local start without an offset, and colour."""
    known = F.create_map(*(F.lit(x) for kv in colours.items() for x in kv))
    return events.select("event_id", F.concat_ws(": ", "ticker", "event_headline").alias("title"), F.date_format("event_date_time_local", "yyyy-MM-dd'T'HH:mm:ss").alias("start"), F.coalesce(known[F.col("event_type")], F.lit(other)).alias("colour"))


def icalendar(events: DataFrame) -> DataFrame:
    """(event_id, value): one VEVENT each; an event lasts an hour."""
    ts = F.col("event_date_time_utc")
    lines = ["BEGIN:VEVENT", F.concat(F.lit("UID:"), F.col("event_id")), F.concat(F.lit("DTSTART:"), times.ics_stamp(ts)), F.concat(F.lit("DTEND:"), times.ics_stamp(ts + F.expr("interval 1 hour"))), F.concat(F.lit("SUMMARY:"), F.col("ticker"), F.lit(" "), F.col("event_headline")), "END:VEVENT"]
    return events.select("event_id", F.concat_ws("\r\n", *(F.lit(x) if isinstance(x, str) else x for x in lines)).alias("value"))
