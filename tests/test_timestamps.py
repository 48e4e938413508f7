from mnemolake.functions import timestamps as T
from mnemolake.operators.normal_times import normalised_times
from pyspark.sql import functions as F

INSTANTS = [
    ("2025-11-02T01:30:00.123999", "America/New_York", "2025-11-02T05:30:00.123Z"),  # twice: the first
    ("[Sun 2025-11-02 01:30 EST]", "America/New_York", "2025-11-02T06:30:00.000Z"),
    ("2025-03-09 02:30:00", "America/New_York", "2025-03-09T07:30:00.000Z"),  # never: moved on
    ("2025-03-09 02:30:00 America/New_York", None, "2025-03-09T07:30:00.000Z"),
    ("1781026751", "UTC", "2026-06-09T17:39:11.000Z"),
    ("1741498544893941", None, "2025-03-09T05:35:44.893Z"),
    ("1741497179.052", None, "2025-03-09T05:12:59.052Z"),
    ("31 Oct 2026, 23:28:34", "Asia/Kathmandu", "2026-10-31T17:43:34.000Z"),
    ("Wed, 31 Dec 2025 20:10:49 +0530", None, "2025-12-31T14:40:49.000Z"),
    ("12/31/2025 12:29:13 PM", "UTC", "2025-12-31T12:29:13.000Z"),
    ("01/01/2026 12:04:45 AM", "UTC", "2026-01-01T00:04:45.000Z"),
    ("31.12.2025 19:53:05", "Bad/Zone", "2025-12-31T19:53:05.000Z"),
    ("2025-03-09T05-15-54.071Z", None, "2025-03-09T05:15:54.071Z"),
    ("2025-11-02 01:30:00 EST", "Australia/Sydney", "2025-11-01T15:30:00.000Z"),
    ("2025-06-02 01:30:00 IST", "Asia/Kolkata", "2025-06-01T20:00:00.000Z"),
    ("2026-11-01 03:53:43 America/Los_Angeles", None, "2026-11-01T11:53:43.000Z"),
    ("2025-02-30 00:00:00", None, None), ("2025-13-01T00:00:00Z", None, None), ("2025-01-01T24:00:00Z", None, None),
    ("2025-10-05T10:00:00 Foo/Bar", None, None), ("2025-10-05 10:00:00 XQZ", None, None), ("Invalid Date", None, None), ("", None, None), (None, None, None), ("x" * 100_000, None, None),
]
DAYS = [
    ("20250308", "Asia/Tokyo", "2025-03-08"), ("  2025-03-08 ", None, "2025-03-08"), ("April 11, 2026", None, "2026-04-11"), ("9 Sep 2025", None, "2025-09-09"), ("Fri 2025-09-12", None, "2025-09-12"),
    ("1759043673000", "America/New_York", "2025-09-28"), ("2025-03-09T03:00:00Z", "America/Los_Angeles", "2025-03-08"), ("02/13/2026", None, "2026-02-13"), ("01.02.2026", None, "2026-02-01"), ("0000-00-00", None, None),
]


def test_instants_and_days(spark):
    zones = T.known_zones(spark)
    df = spark.createDataFrame([(i, v, z) for i, (v, z, _) in enumerate(INSTANTS)], "i int, v string, z string").withColumn("z", T.known_or_null(F.col("z"), zones))
    got = {r["i"]: r["f"] for r in T.with_instant_utc(df, "v", "z", zones, "t").select("i", T.instant_form(F.col("t")).alias("f")).collect()}
    assert [got[i] for i in range(len(INSTANTS))] == [e for _, _, e in INSTANTS]
    df = spark.createDataFrame([(i, v, z) for i, (v, z, _) in enumerate(DAYS)], "i int, v string, z string")
    got = {r["i"]: r["d"] for r in T.with_calendar_day(df, "v", "z", zones, "d").collect()}
    assert [got[i] for i in range(len(DAYS))] == [e for _, _, e in DAYS]


def test_session_zone_does_not_matter(spark):
    zones = T.known_zones(spark)
    df = spark.createDataFrame([("2025-03-30 01:30:00", "UTC")], "v string, z string")
    spark.conf.set("spark.sql.session.timeZone", "Europe/London")
    try:
        assert T.with_instant_utc(df, "v", "z", zones, "t").select(T.instant_form(F.col("t"))).first()[0] == "2025-03-30T01:30:00.000Z"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_tables_with_repeats_nulls_and_clashing_columns(spark):
    messages = spark.createDataFrame([(1, "w", "2025-03-09T05:15:54Z", "x"), (1, "w", "2025-03-09T05:15:54Z", "x"), (2, None, None, "y"), (3, "w", "2025-03-09T05:15:54.000Z", "z")], "row_id bigint, workspace_id string, timestamp string, zone string")
    entries = spark.createDataFrame([("a", "w", "2025/03/09", 1), ("a", "w", "2025/03/09", 1), ("b", None, "2025-03-09", 2)], "id string, workspace_id string, logical_date string, day int")
    spaces = spark.createDataFrame([("w", '{"timezone": "Asia/Tokyo"}'), ("v", None)], "id string, metadata string")
    got = sorted(tuple(r) for r in normalised_times(messages, entries, spaces).collect())
    assert got == [("memory_daily_entries", "a", "2025-03-09"), ("session_messages", "1", "2025-03-09T05:15:54.000Z"), ("session_messages", "1", "2025-03-09T05:15:54.000Z")]
    assert normalised_times(messages.limit(0), entries.limit(0), spaces.limit(0)).count() == 0
