"""Dates of exports: every form, the order of day and month, and what is lost."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfwise.functions import dates as D
from shelfwise.sources import files as FS

DAY = dt.datetime(2024, 10, 15)
FORMS = ["10/15/24", "10/15/2024", "10-15-2024", "10.15.2024", "20241015", "15 October 2024", "Oct 15 2024", "October 15, 2024", "15-Oct-24",
         "15-Oct-2024", "15 Oct 2024", "Tue, Oct 15, 2024", "Tuesday 15 October 2024", "October 15th, 2024", "2024/10/15", "2024.10.15",
         "2024-10-15", " 2024-10-15 ", "OCT 15 2024", "15/Oct/2024"]
TIMES = {" 3:05 PM": (15, 5, 0), " 03:05": (3, 5, 0), " 12:05 am": (0, 5, 0), " 12:05 p.m.": (12, 5, 0), " 23:59:58": (23, 59, 58),
         ", 3:05:07 pm": (15, 5, 7)}
BAD = ["bad date", "", "  ", "13/45/2024", "2024-02-30", "10/15/2024 13:05 PM", "10/15/2024 0:05 PM", "1 mai 2024", "10/15/2024x", "123",
       "20241315", "10/15-2024", "15.10", "October", "12:30", "2024-10-15 25:00", None, "x" * 5000, "1/" * 3000]


def parsed(spark, texts, day_first=False):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    return [r[0] for r in df.select(D.to_timestamp_lenient("t", day_first)).collect()]


def test_forms_of_one_day(spark):
    assert parsed(spark, FORMS) == [DAY] * len(FORMS)


@pytest.mark.parametrize("time", TIMES)
def test_forms_with_a_time(spark, time):
    h, m, s = TIMES[time]
    texts = [f.strip() + time for f in FORMS if f != "20241015" and not (time[0] == "," and f.startswith(("2024", " 2024")))]
    got = parsed(spark, texts)
    assert got == [DAY.replace(hour=h, minute=m, second=s)] * len(texts), list(zip(texts, got))


def test_compact_times(spark):
    assert parsed(spark, ["20241015T030506", "202410150305", "20241015 0305"]) == [
        DAY.replace(hour=3, minute=5, second=6), DAY.replace(hour=3, minute=5), DAY.replace(hour=3, minute=5)]


def test_bad_cells_are_null(spark):
    assert parsed(spark, BAD) == [None] * len(BAD) == parsed(spark, BAD, True)


def test_two_digit_years(spark):
    assert [x.year for x in parsed(spark, ["1/2/00", "1/2/68", "1/2/69", "1/2/99", "2-Jan-70"])] == [2000, 2068, 1969, 1999, 1970]


def test_every_day_of_some_years(spark):
    days = [dt.datetime(1999, 1, 1) + dt.timedelta(i) for i in range(1200)]
    for fmt, first in (("%m/%d/%Y", False), ("%d/%m/%y", True), ("%d.%m.%Y", True), ("%Y%m%d", False), ("%B %d, %Y", True), ("%a, %d %b %Y", False)):
        assert parsed(spark, [d.strftime(fmt) for d in days], first) == days


def test_the_order_that_reads_more_wins(spark):
    rows = [("3/4/2024", "3/4/2024", "x"), ("25/4/2024", "3/25/2024", None), ("5/6/2024", "5/6/2024", "")]
    df = spark.createDataFrame(rows, "uk string, us string, none string")
    out = D.with_dates(df, ["uk", "us", "none", "absent"]).collect()
    assert [r["uk"] for r in out] == [dt.datetime(2024, 4, 3), dt.datetime(2024, 4, 25), dt.datetime(2024, 6, 5)]
    assert [r["us"] for r in out] == [dt.datetime(2024, 3, 4), dt.datetime(2024, 3, 25), dt.datetime(2024, 5, 6)]
    rep = {r["column"]: r for r in D.date_report(df, ["uk", "us", "none"]).collect()}
    assert (rep["uk"]["day_order"], rep["us"]["day_order"], rep["none"]["day_order"]) == (D.DAY_FIRST, D.MONTH_FIRST, D.MONTH_FIRST)
    assert (rep["uk"]["lost"], rep["none"]["lost"], rep["none"]["blank"], rep["none"]["cells"]) == (0, 1, 2, 3)


@pytest.mark.parametrize("more", ["25/12/2024", "12/25/2024"])
def test_report_counts_the_cells_that_the_parser_loses(spark, more):
    times = ["", " 3:05 PM", " 13:05 pm", " 25:00", " 12:05 a.m."]
    days = [*FORMS, "3/4/2024", "25.4.24", "4/25/24", "31/02/1996", "2/30/1996", "0/5/2024", "13-13-2024", "29 Feb 2023", "soon"]
    texts = [d + t for d in days for t in times] + BAD + [more] * 500
    df = spark.createDataFrame([(t, "x") for t in texts], "t string, other string")
    rep = {r["column"]: r for r in D.date_report(df, ["t", "other"]).collect()}
    first = more == "25/12/2024"
    got = parsed(spark, texts, first)
    assert (rep["t"]["day_order"], rep["t"]["cells"]) == (D.DAY_FIRST if first else D.MONTH_FIRST, len(texts))
    assert rep["t"]["lost"] == sum(at is None and bool((t or "").strip(" ")) for t, at in zip(texts, got))
    assert (rep["other"]["lost"], rep["other"]["cells"], rep["other"]["day_order"]) == (len(texts), len(texts), D.MONTH_FIRST)


def test_report_reads_a_cell_once_in_compiled_code(spark):
    df = spark.createDataFrame([("1/2/2024", "x")], "a string, b string")
    plan = D.date_report(df, ["a", "b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("try_cast(") == 1 and "lambda" not in plan


def test_files_have_orders_of_their_own(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,day\n1,25/12/2024\n2,3/4/2024\n")
    (tmp_path / "b.csv").write_text("id,day\n3,12/25/2024\n4,3/4/2024\n")
    df = FS.read_feed(spark, str(tmp_path), {"id": "int"}, dates=["day"], with_file=True)
    assert {r["id"]: r["day"].strftime("%m-%d") for r in df.collect()} == {1: "12-25", 2: "04-03", 3: "12-25", 4: "03-04"}


def test_no_parser_throws_in_the_plan(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = D.with_dates(df, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "gettimestamp" not in plan.lower() and "CartesianProduct" not in plan and "Python" not in plan
    assert D.with_dates(df.limit(0), ["t"]).count() == 0
    assert df.select(D.to_timestamp_lenient(F.lit(None))).first()[0] is None
