from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from quillspark.operators import calendar

SCHEMA = "event_id string, ticker string, event_type string, description string, event_date_time string, webcast_link string, contact_name string, contact_phone string, contact_email string, fiscal_year int, fiscal_period string"


def events(spark):
    row = lambda i, t, kind, when, fy=None, fp=None, name=None, phone=None: (str(i), t, kind, f"h{i}", when, None, name, phone, "", fy, fp)
    return spark.createDataFrame([
        row(1, "A", "ProjectedEarningsRelease", "2024-01-10T12:00:00Z", 2024, "Q1"), row(2, "A", "Earnings", "2024-01-11T12:00:00Z", 2024, "Q1", "Ann", "1"),
        row(3, "A", "ConfirmedEarningsRelease", "2024-01-11T13:00:00Z", 2024, "Q1"), row(4, "A", "Earnings", "2024-01-12T12:00:00Z", 2024, "Q1"),
        row(5, "B", "Earnings", "2024-07-02T02:00:00Z"), row(6, "B", "ConfirmedEarningsRelease", "2024-07-01T20:00:00Z"), row(7, "B", "Dividend", "2024-07-01T20:00:00+02:00"),
        row(7, "B", "Dividend", "2024-07-01T20:00:00+02:00"), row(8, "Z", None, None),
    ], SCHEMA)


def chain(spark):
    dim = spark.createDataFrame([("A", 1, "Bank A", "Bank"), ("B", 2, "Bank B", "Fund")], "ticker string, id int, name string, type string")
    return calendar.enrich(events(spark), dim)


def test_enrichment(spark):
    got = {r["event_id"]: r for r in chain(spark).collect()}
    assert (got["2"]["institution_name"], got["2"]["contact_info"], got["2"]["event_time_local"]) == ("Bank A", "Contact: Ann | Phone: 1", "07:00 EST")
    assert (got["5"]["event_date"], got["5"]["event_time_local"]) == (dt.date(2024, 7, 1), "22:00 EDT")
    assert got["7"]["event_time_local"] == "14:00 EDT" and got["7"]["contact_info"] == ""
    assert (got["8"]["institution_name"], got["8"]["institution_type"], got["8"]["event_type"], got["8"]["event_date"]) == ("Unknown", "Unknown", "Unknown", None)


def test_dedupe_keeps_the_first_by_priority_and_is_idempotent(spark):
    rows = chain(spark).withColumn("ordinal", F.col("event_id").cast("int"))
    once = calendar.dedupe_announcements(rows, "ordinal")
    ids = sorted(r["event_id"] for r in once.collect())
    assert ids == ["2", "5", "7", "7", "8"] or ids == ["2", "5", "7", "8"]
    assert sorted(r["event_id"] for r in calendar.dedupe_announcements(once, "ordinal").collect()) == ids


def test_equal_other_events_all_stay(spark):
    rows = chain(spark).withColumn("ordinal", F.monotonically_increasing_id())
    assert calendar.dedupe_announcements(rows, "ordinal").where("event_type = 'Dividend'").count() == 2


def test_export_and_selection(spark):
    at_night = spark.sql("SELECT 'x' AS event_id, 'T' AS ticker, 'H' AS event_headline, TIMESTAMP '2024-01-01 23:30:00' AS event_date_time_utc")
    value = calendar.icalendar(at_night).first()["value"]
    assert "DTSTART:20240101T233000Z\r\nDTEND:20240102T003000Z\r\n" in value and value.startswith("BEGIN:VEVENT")
    kinds = lambda chosen: {r["event_type"] for r in calendar.selected(chain(spark), "event_type", chosen, {"Results": list(calendar.PRIORITY)}).collect()}
    assert kinds(["Dividend"]) == {"Dividend"} and kinds(["Results"]) == set(calendar.PRIORITY) and len(kinds([])) == 5
    row = calendar.upcoming_and_past(chain(spark).where("event_date_time_utc IS NOT NULL"), "event_date_time_utc", F.lit("2024-06-01").cast("timestamp")).first()
    assert tuple(row) == (4, 4)
