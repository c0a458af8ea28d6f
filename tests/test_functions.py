"""Scalar functions on the hand-made rows of FIXTURES.md section 3."""

from pyspark.sql import functions as F

from shelfwise.functions import scalars as S


def _one(spark, expr, data, schema):
    df = spark.createDataFrame(data, schema)
    return [r[0] for r in df.select(expr.alias("out")).collect()]


def test_week_parse(spark):
    weeks = ["Fiscal Week 1 of 2025", "Fiscal Week 9 of 2025", "Fiscal Week 26 of 2025",
             "Fiscal Week 52 of 2024", "bad", None]
    df = spark.createDataFrame([(w,) for w in weeks], "week string")
    got = [tuple(r) for r in df.select(S.week_num("week"), S.week_year("week")).collect()]
    assert got == [(1, 2025), (9, 2025), (26, 2025), (52, 2024), (None, None), (None, None)]


def test_latest_week_orders_by_number_not_text(spark):
    from shelfwise.operators.kpis import latest_week
    df = spark.createDataFrame([("Fiscal Week 9 of 2025",), ("Fiscal Week 26 of 2025",),
                                ("Fiscal Week 52 of 2024",), ("bad",), (None,)], "week string")
    r = latest_week(df).first()
    assert (r.week, r.week_num, r.year) == ("Fiscal Week 26 of 2025", 26, 2025)


def test_full_upc(spark):
    data = [("0784", "12"), ('="078"', None), (None, "1"), ("abc", "5"), ("000", None), ("  ", "3")]
    got = _one(spark, S.full_upc("u", "p"), data, "u string, p string")
    assert got == ["078412", "078", None, "05", "00", None]


def test_clean_text(spark):
    got = _one(spark, S.clean_text("v"), [(' ="0123" ',), ('="77"',), ("",), (None,), ("'x'  ",)], "v string")
    assert got == ["0123", "77", "", None, "x"]


def test_clean_upc_key(spark):
    got = _one(spark, S.clean_upc_key("v"), [("  00 0784",), ("0012",), (" 12 3",)], "v string")
    assert got == ["0784", "12", "123"]


def test_strip_point_zero(spark):
    got = _one(spark, S.strip_point_zero("v"), [("12.0",), ("1.05",), (None,), ("10.00",)], "v string")
    assert got == ["12", "1.05", "", "10.00"]


def test_safe_label(spark):
    got = _one(spark, S.safe_label("v"), [("a/b[c]",), ("  ",), (None,), ("x" * 40,), (" a:b ",)], "v string")
    assert got == ["a_b_c_", "No_BU", "No_BU", "x" * 31, "a_b"]


def test_concat_codes(spark):
    df = spark.createDataFrame([("A", "B"), ("", ""), (None, "B")], "a string, b string")
    got = [tuple(r) for r in df.select(S.concat_code("a", "b"), S.concat_code_default(
        F.coalesce("a", F.lit("")), "b")).collect()]
    assert got == [("A-B", "A-B"), ("-", "Unknown"), (None, "-B")]


def test_to_number_and_dates(spark):
    got = _one(spark, S.to_number("v"), [("15000.5",), ("$1,000",), ("nan",), (" 12 ",)], "v string")
    assert got == [15000.5, None, None, 12.0]
    got = _one(spark, S.date_text(S.to_timestamp_safe("v")), [("2024-01-02 10:00:00",), ("junk",)], "v string")
    assert got == ["2024-01-02", "No Date"]


def test_zero_safe_division(spark):
    got = _one(spark, F.col("a") / S.nz("b"), [(5.0, 0.0), (6.0, 3.0)], "a double, b double")
    assert got == [5.0, 2.0]


def test_file_safe_and_money_text(spark):
    got = _one(spark, S.file_safe("v"), [("Fiscal Week 9 of 2025",), ("a:b c",)], "v string")
    assert got == ["Fiscal_Week_9_of_2025", "ab_c"]
    got = _one(spark, S.money_text("v"), [(1234567.891,)], "v double")
    assert got == ["$1,234,567.89"]


def test_schema_helpers(spark):
    from shelfwise.operators import schema as P
    from shelfwise.operators.backlog import sort_for_report
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "`oms id +` int, ` name ` string")
    t = P.trim_headers(df)
    assert t.columns == ["oms id +", "name"]
    w = P.widen(t, {"oms id +": "float", "absent": "int"})
    assert dict(w.dtypes)["oms id +"] == "float"
    c = P.insert_constants(t, {"Price File": "p1"})
    assert c.columns == ["Price File", "oms id +", "name"]
    assert P.missing_columns(t, ["name", "x"]) == ["x"]
    s = sort_for_report(t, ["name", "oms id +"])
    assert [r[0] for r in s.collect()] == [3, 1, 2]


def test_whole_int(spark):
    got = _one(spark, S.whole_int("v"), [("4",), ("4.0",), ("4.5",), ("x",), (None,), ("1e12",)], "v string")
    assert got == [4, 4, None, None, None, None]


def test_codes_dates_and_numbers_as_delivered(spark):
    from shelfwise.functions import scalars as S
    one = spark.range(1)
    assert one.select(S.strip_point_zero(F.lit(12345678901.0)), S.strip_point_zero(F.lit(12345678901234.0)),
                      S.strip_point_zero(F.lit(12.0)), S.strip_point_zero(F.lit(12345678.5))).first()[:] == (
        "12345678901", "12345678901234", "12", "12345678.5")
    got = one.select(S.full_upc(F.lit('=""'), F.lit("1")), S.full_upc(F.lit("nan"), F.lit("1")),
                     S.full_upc(F.lit('="0012"'), F.lit("nan")), S.full_upc(F.lit("012"), F.lit('="03"'))).first()[:]
    assert got == (None, None, "012", "0123")
    texts = ["10/15/2024", "Oct 15, 2024", "2024-10-15", "15-Oct-2024", "10/15/2024 8:30"]
    days = one.select(*[S.to_timestamp_safe(F.lit(t)).cast("date").cast("string") for t in texts]).first()[:]
    assert set(days) == {"2024-10-15"}
    df = spark.createDataFrame([("10/15/2024",), ("junk",), (None,), ("",)], "t string")
    assert df.agg(S.lost_share("t", S.to_timestamp_safe(F.col("t")))).first()[0] == 0.5
