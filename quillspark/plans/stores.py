"""Queries over what writers wrote: tables go to the shared folder and are read back by the readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillspark.operators import calendar, name_match
from quillspark.plans.book import Book, read
from quillspark.plans.events import calendar_events
from quillspark.sources import readers, sinks, whole_file
from quillspark.tables import new_path as folder

book = Book()


@book.add("SELECT doc_id, lang, source, text, '[' || doc_id || ',' || n_chars || ']' AS nested FROM documents")
def csv_round_trip(spark, sf_dir):
    """CSV with line ends, quotes and a nested column in it."""
    nested = F.when(F.col("doc_id").isNotNull() & F.col("n_chars").isNotNull(), F.array("doc_id", "n_chars")).alias("nested")
    rows = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text", nested)
    path = folder(spark)
    sinks.replace_csv(rows, path)
    return readers.csv_records(spark, path, "doc_id long, lang string, source string, text string, nested string")


@book.add("SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_nationkey < 20")
def csv_append(spark, sf_dir):
    """Two appends to one table."""
    rows, path = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey"), folder(spark)
    sinks.append_csv(rows.where("c_nationkey < 10"), path)
    sinks.append_csv(rows.where("c_nationkey BETWEEN 10 AND 19"), path)
    return readers.csv_records(spark, path, "c_custkey long, c_name string, c_nationkey int")


@book.add("SELECT page_id, url FROM pages WHERE page_id % 3 = 0 OR page_id % 3 = 1")
def json_append(spark, sf_dir):
    rows, path = read(spark, sf_dir, "pages").select("page_id", "url", (F.col("page_id") % 3).alias("part")), folder(spark)
    for part in range(2):
        sinks.append_json(rows.where(F.col("part") == part).drop("part"), path)
    return spark.read.schema("page_id long, url string").json(path)


@book.add("SELECT conv_id, turn, role FROM conversations")
def json_repair(spark, sf_dir):
    """A JSON array for each conversation; every second one breaks off behind an element, every fourth behind its comma."""
    turn = F.to_json(F.struct("turn", "role"))
    arrays = read(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.concat_ws(",", F.collect_list(turn)).alias("body"))
    end = F.when(F.col("conv_id") % 4 == 0, ", \n").when(F.col("conv_id") % 2 == 0, "").otherwise("]")
    raw = arrays.select("conv_id", F.concat(F.lit("["), "body", end).alias("raw"))
    return raw.select("conv_id", F.inline(F.from_json(readers.closed_array(F.col("raw")), "array<struct<turn:bigint,role:string>>")))


@book.add("""
SELECT o_orderkey, 'calls' AS queue FROM orders WHERE o_orderstatus = 'O' UNION ALL SELECT o_orderkey, 'removed' FROM orders WHERE o_orderstatus = 'F'""")
def queue_files(spark, sf_dir):
    """The queue of calls and that of removals; what isn't a call gets into neither."""
    orders, path = read(spark, sf_dir, "orders"), folder(spark)
    process = orders.where("o_orderstatus <> 'F'").select("o_orderkey", (F.col("o_orderstatus") == "O").alias("is_earnings_call"))
    sinks.queues(process, orders.where("o_orderstatus = 'F'").select("o_orderkey"), f"{path}/process", f"{path}/remove")
    of = lambda name, tag: readers.queue(spark, f"{path}/{name}", "o_orderkey long").withColumn("queue", F.lit(tag))
    return of("process", "calls").unionByName(of("remove", "removed")).unionByName(of("nothing", "none"))


_NEW = "(SELECT s_suppkey FROM supplier WHERE s_nationkey IN (3, 7) AND s_suppkey % 2 = 0)"


@book.add(f"""
SELECT s_suppkey, s_nationkey, CASE WHEN s_suppkey IN {_NEW} THEN 'new' ELSE 'old' END AS state FROM supplier
WHERE s_suppkey IN {_NEW} OR s_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_suppkey IN {_NEW})""")
def keys_replaced(spark, sf_dir):
    """The partitions of two keys are replaced, with fewer rows, the others stay."""
    rows, path = read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), folder(spark)
    sinks.replace_keys(rows.withColumn("state", F.lit("old")), path, ["s_nationkey"])
    sinks.replace_keys(rows.where("s_nationkey IN (3, 7) AND s_suppkey % 2 = 0").withColumn("state", F.lit("new")), path, ["s_nationkey"])
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return spark.read.schema(f"{kinds}, state string").parquet(path).select("s_suppkey", "s_nationkey", "state")


@book.add("SELECT event_id, CASE WHEN user_id % 5 = 0 OR event_type = 'view' THEN 'set aside' ELSE 'sound' END AS side FROM events")
def quarantine(spark, sf_dir):
    """Rows whose check says no, or nothing, are set aside with a time."""
    check = F.when(F.col("user_id") % 5 != 0, F.col("event_type") == "view")
    good, bad = sinks.quarantined(read(spark, sf_dir, "events").select("event_id", "user_id", "event_type"), check)
    return good.select("event_id", F.lit("sound").alias("side")).unionByName(bad.where("set_aside_at IS NOT NULL").select("event_id", F.lit("set aside").alias("side")))


@book.add("SELECT c_custkey, 'negative balance' AS error FROM customer WHERE c_acctbal < 0")
def failure_list(spark, sf_dir):
    results = read(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_acctbal") < 0, "negative balance").alias("error"))
    return sinks.failures(results, "c_custkey", "error").where("failed_at IS NOT NULL").select("c_custkey", "error")


@book.add("""
SELECT p_partkey, name FROM (SELECT p_partkey, w AS name, row_number() OVER (PARTITION BY p_partkey ORDER BY k, w) AS nth FROM part
JOIN (SELECT n_nationkey AS k, lower(substr(n_name, 1 + n_nationkey % 5, 1 + n_nationkey % 2)) AS w FROM nation) ON contains(lower(p_name), w) OR contains(w, lower(p_name))) WHERE nth = 1""")
def names_from_a_table(spark, sf_dir):
    """A table of short names, in order, against all rows: the first that holds or is held by the text."""
    part = F.lower(F.substring("n_name", F.col("n_nationkey") % 5 + 1, F.col("n_nationkey") % 2 + 1))
    names = read(spark, sf_dir, "nation").select("n_nationkey", part.alias("name"))
    found = name_match.first_match(read(spark, sf_dir, "part"), "p_name", names, "name", "n_nationkey").where("matched IS NOT NULL")
    return found.select("p_partkey", F.col("matched.name").alias("name"))


@book.add("""
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT -1, CAST(l_linenumber AS INTEGER), count(*) FROM lineitem GROUP BY l_linenumber HAVING count(*) > 1""")
def unique_keys(spark, sf_dir):
    """Keys that aren't unique, with their counts: none for the table's key, and all line numbers taken alone."""
    rows = read(spark, sf_dir, "lineitem")
    whole = sinks.repeated_keys(rows, ["l_orderkey", "l_linenumber"]).select("l_orderkey", F.col("l_linenumber").cast("int"), "n")
    return whole.unionByName(sinks.repeated_keys(rows, ["l_linenumber"]).select(F.lit(-1).cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("int"), "n"))


@book.add("SELECT doc_id, lang, source, n_chars, CAST(text AS VARCHAR) AS text FROM documents")
def json_array_sink(spark, sf_dir):
    """One closed JSON array in the place of an older one, read back."""
    whole_file.register(spark)
    rows, path = read(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars", "text"), f"{folder(spark)}/all.json"
    for part in (rows.where("doc_id % 2 = 0"), rows):
        part.write.format("whole_file").option("path", path).mode("overwrite").save()
    return whole_file.json_elements(spark, path, rows.schema)


@book.add("""
WITH e AS (SELECT event_id, user_id, props FROM events WHERE event_type = 'signup')
SELECT 'UID:' || event_id AS line, 1 AS n FROM e UNION ALL SELECT 'SUMMARY', count(*) FROM e UNION ALL SELECT 'BEGIN:VEVENT', count(*) FROM e UNION ALL SELECT 'END:VEVENT', count(*) FROM e
UNION ALL SELECT 'BEGIN:VCALENDAR', 1 UNION ALL SELECT 'END:VCALENDAR', 1""")
def calendar_sink(spark, sf_dir):
    """A calendar file; its lines are counted, those with ids one by one."""
    whole_file.register(spark)
    path = f"{folder(spark)}/all.ics"
    texts = calendar.icalendar(calendar_events(spark, sf_dir).where("event_type = 'signup'")).select("value")
    options = {"layout": "text", "head": "BEGIN:VCALENDAR\r\nVERSION:2.0\r\n", "between": "\r\n", "tail": "\r\nEND:VCALENDAR\r\n"}
    texts.write.format("whole_file").options(**options).option("path", path).mode("overwrite").save()
    lines = spark.read.option("lineSep", "\r\n").text(path).where("value RLIKE '^(BEGIN|END|UID|SUMMARY):'")
    return lines.select(F.when(F.col("value").startswith("SUMMARY"), "SUMMARY").otherwise(F.col("value")).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("n"))
