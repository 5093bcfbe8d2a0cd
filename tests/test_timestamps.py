import re
from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest

from strataloom.operators import timestamps as T

CASES = [
    ("2019-08-06T13:10:49-04:00", "UTC", "2019-08-06T17:10:49.000000Z"),
    ("\t2023-04-21 23:37:02 UTC ", "Asia/Tokyo", "2023-04-21T23:37:02.000000Z"),
    ("2020-07-01 12:00:00 America/New_York", "UTC", "2020-07-01T16:00:00.000000Z"),
    ("2014-01-08 16:14:57 IST", "UTC", "2014-01-08T10:44:57.000000Z"),
    ("Apr 9, 2016 12:32:10 AM IST", "UTC", "2016-04-08T19:02:10.000000Z"),
    ("Apr 9, 2016 12:32:10 PM IST", "UTC", "2016-04-09T07:02:10.000000Z"),
    ("Sun Oct 31 19:22:54 2021 -0400", "UTC", "2021-10-31T23:22:54.000000Z"),
    ("Fri, 12 Aug 2022 00:59:50 +0100", "UTC", "2022-08-11T23:59:50.000000Z"),
    ("22 Jan 2015 23:32:07 +0530", "UTC", "2015-01-22T18:02:07.000000Z"),
    ("20210207T040709Z", "UTC", "2021-02-07T04:07:09.000000Z"),
    ("2017/07/21 19:25", "Asia/Tokyo", "2017-07-21T10:25:00.000000Z"),
    ("31.12.2019 01:16:31", "Asia/Kolkata", "2019-12-30T19:46:31.000000Z"),
    ("2021-08-25 05:26:20,622 +1000", "UTC", "2021-08-24T19:26:20.622000Z"),
    ("2017-07-22T19:18:42.576285937+00", "UTC", "2017-07-22T19:18:42.576285Z"),
    ("2023-12-25T03:06:19+01:00[Europe/Berlin]", "UTC", "2023-12-25T02:06:19.000000Z"),
    ("2023-10-25t03:50:38z", "UTC", "2023-10-25T03:50:38.000000Z"),
    ("1421746700 +0900", "UTC", "2015-01-20T09:38:20.000000Z"),
    ("@1619901242 +0530", "UTC", "2021-05-01T20:34:02.000000Z"),
    ("1716542610964", "UTC", "2024-05-24T09:23:30.964000Z"),
    ("1564879467000001", "UTC", "2019-08-04T00:44:27.000001Z"),
    ("2021-03-28 02:30:00", "Europe/Berlin", "skipped"),
    ("2021-10-31 02:30:00", "Europe/Berlin", "ambiguous"),
    ("2021-10-31 03:00:00", "Europe/Berlin", "2021-10-31T02:00:00.000000Z"),
    ("2021-10-31 02:30:00 CET", "Europe/Berlin", "2021-10-31T01:30:00.000000Z"),
    ("2021-02-30 02:30:00", "UTC", "invalid"),
    ("2021-02-03 25:30:00", "UTC", "invalid"),
    ("0000-00-00 00:00:00", "UTC", "invalid"),
    ("2021-02-03 01:30:00 Mars/Base", "UTC", "invalid"),
    ("2021-02-03 01:30:00", None, "invalid"),
    ("yesterday", "UTC", "invalid"),
    ("", "UTC", "invalid"),
    ("x" * 100_000, "UTC", "invalid"),
    (None, "UTC", None),
]


@pytest.fixture(scope="module")
def abbrevs(spark):
    return spark.createDataFrame([("IST", 330), ("CET", 60), ("UTC", 0), (" cet", 60), (None, 1)], "abbrev string, offset_minutes bigint")


def test_every_form(spark, abbrevs):
    rows = spark.createDataFrame([c[:2] for c in CASES], "text string, zone string")
    got = {(r["text"], r["zone"]): r["utc_text"] for r in T.parse(rows, abbrevs).collect()}
    assert got == {c[:2]: c[2] for c in CASES}


def test_the_result_is_the_same_in_any_session_zone(spark, abbrevs):
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        rows = spark.createDataFrame([c[:2] for c in CASES[:20]], "text string, zone string")
        assert {r["text"]: r["utc_text"] for r in T.parse(rows, abbrevs).collect()} == {c[0]: c[2] for c in CASES[:20]}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_each_hour_around_the_changes_against_zoneinfo(spark, abbrevs):
    cases = []
    for zone in ("Europe/London", "America/New_York", "Australia/Sydney", "Asia/Kolkata"):
        for start in (datetime(2019, 3, 9), datetime(2019, 3, 30), datetime(2019, 4, 6), datetime(2019, 10, 5), datetime(2019, 10, 26), datetime(2019, 11, 2)):
            cases += [((start + timedelta(minutes=30 * i)).strftime("%Y-%m-%d %H:%M:%S"), zone) for i in range(96)]

    def expected(text, zone):
        t = datetime.fromisoformat(text)
        found = {u for fold in (0, 1) if (u := t.replace(tzinfo=ZoneInfo(zone), fold=fold).astimezone(timezone.utc)).astimezone(ZoneInfo(zone)).replace(tzinfo=None) == t}
        return next(iter(found)).strftime("%Y-%m-%dT%H:%M:%S.%fZ") if len(found) == 1 else "ambiguous" if found else "skipped"

    rows = spark.createDataFrame(cases, "text string, zone string")
    got = {(r["text"], r["zone"]): r["utc_text"] for r in T.parse(rows, abbrevs).collect()}
    assert got == {c: expected(*c) for c in cases}


def test_the_dictionary_learns_only_what_is_new(spark, abbrevs, tmp_path):
    path = f"{tmp_path}/dictionary"
    found = lambda *x: spark.createDataFrame([("r", t, "UTC") for t in x], "source string, text string, zone string")
    d = T.TimestampDictionary(spark, path)
    assert d.entries() is None
    assert d.learn(found("2020-01-01 00:00:00", "no date", "no date"), abbrevs).count() == 2
    assert d.learn(found("no date", "2020-01-02 00:00:00"), abbrevs).count() == 3
    assert T.TimestampDictionary(spark, path).entries().count() == 3
    T.parse(found("no date"), abbrevs).write.mode("append").parquet(path)  # as a second learner would at the same time
    assert d.entries().count() == 3
    assert T.dictionary_path(spark, abbrevs) == T.dictionary_path(spark, abbrevs.orderBy("abbrev")) != T.dictionary_path(spark, abbrevs.limit(2))


def test_rows_with_clashing_columns_and_empty_tables(spark, abbrevs):
    clocks = spark.createDataFrame([("r", "Asia/Tokyo"), ("r", "Asia/Tokyo"), (None, "UTC")], "repo_name string, tz_name string")
    rows = spark.createDataFrame([("r", "2020-01-01 09:00:00", "kept", 1), ("r", "2020-01-01 09:00:00", "kept", 1), ("q", "2020-01-01 09:00:00", None, 2), (None, None, "", 3)], "repo_name string, d string, zone string, utc_text int")
    got = sorted(((r["repo_name"], r["d_utc"], r["zone"], r["utc_text"]) for r in T.normalise(rows, ["d"], clocks, abbrevs).collect()), key=str)
    assert got == sorted([("r", "2020-01-01T00:00:00.000000Z", "kept", 1)] * 2 + [("q", "invalid", None, 2), (None, None, "", 3)], key=str)
    assert T.normalise(rows.limit(0), ["d"], clocks.limit(0), abbrevs.limit(0)).count() == 0


def test_commits(spark, small_dir):
    from strataloom.plans.problems import p1_found

    got = p1_found(spark, small_dir).collect()
    assert got and len({(r[0], r[1]) for r in got}) == len(got)
    assert all(re.match(T.CANONICAL, r["utc_text"]) or r["utc_text"] in ("invalid", "skipped", "ambiguous") for r in got)
