"""File-level sources and sinks on real files in a per-test folder."""

import os

from pyspark.sql import functions as F

from helpers import rows
from shelfwise.sources import files as FS
from shelfwise.sources import sinks as SK


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def test_read_feed_types_by_name(spark, tmp_path):
    p = str(tmp_path / "feed" / "pythononlinesales_1.csv")
    _write(p, "extra,oms id +,day,online sales $ +\nx,12,2024-01-02,3.5\ny,bad,junk,4\n")
    df = FS.read_feed(spark, p, {"oms id +": "int", "online sales $ +": "double"}, dates=["day"],
                      required=["oms id +"])
    got = [tuple(r) for r in df.orderBy("extra").collect()]
    assert got[0][0] == "x" and got[0][1] == 12 and got[0][2].day == 2 and got[0][3] == 3.5
    assert got[1][1:] == (None, None, 4.0)


def test_discover_case_insensitive_and_latest(spark, tmp_path):
    d = tmp_path / "drop"
    for n in ["PythonOnlineSales_b.csv", "pythononlinesales_a.csv", "other.csv", "pythononlinesales_c.xlsx"]:
        _write(str(d / n), "a\n1\n")
    got = [r.file_name for r in FS.discover(spark, str(d), prefix="pythonOnlineSales", suffix=".csv").collect()]
    assert got == ["PythonOnlineSales_b.csv", "pythononlinesales_a.csv"]
    names = spark.createDataFrame([("Team Territory Store List 9.1.2024.xlsx",),
                                   ("Team Territory Store List 10.15.2023.xlsx",), ("junk.xlsx",)], "file_name string")
    r = FS.latest_by_name_date(names).first()
    assert r.file_name == "Team Territory Store List 9.1.2024.xlsx" and str(r.file_date) == "2024-09-01"
    ordered = [r.file_name for r in FS.order_by_name_digits(
        spark.createDataFrame([("FW12.xlsx",), ("FW9.xlsx",)], "file_name string")).collect()]
    assert ordered == ["FW9.xlsx", "FW12.xlsx"]


def test_read_preamble_csv(spark, tmp_path):
    p = str(tmp_path / "sheet.csv")
    _write(p, "Report\nGenerated today\nOMSID,,TOTAL SCORE\n1,x,2.5,extra\n2\n")
    df = FS.read_preamble_csv(spark, p, header_row=3)
    assert df.columns == ["OMSID", "_c1", "TOTAL SCORE"]
    assert [tuple(r) for r in df.collect()] == [("1", "x", "2.5"), ("2", "", "")]


def test_html_rows_pick_table_with_upc_and_item(spark):
    html = ("<html><p>Description : <b>Spring list</b></p>\n<table><tr><th>Note</th></tr><tr><td>n</td></tr></table>"
            "<table><tr><th>UPC</th><th>Item</th></tr><tr><td>=\"0123\"</td><td>A</td></tr>"
            "<tr><td></td><td>B</td></tr></table></html>")
    df = spark.createDataFrame([(1, html), (2, "<table><tr><th>X</th></tr></table>")], "id int, html string")
    out = FS.html_rows(df, "id", "html", ["UPC", "Item", "Missing"])
    assert rows(out, "id", "UPC", "Item", "Missing") == [(1, None, "B", None), (1, '="0123"', "A", None)]
    label = df.select(FS.html_field(F.col("html"), FS.DESCRIPTION_PATTERN, F.lit("stem"))).collect()
    assert [r[0] for r in label] == ["Spring list", "stem"]


def test_publish_versions_and_pointer(spark, tmp_path):
    t = str(tmp_path / "table")
    a = spark.createDataFrame([(1,)], "x int")
    v1 = SK.publish(a, t, "v1")
    b = SK.read_published(spark, t).withColumn("x", F.col("x") + 1)
    v2 = SK.publish(b, t, "v2")     # reads v1 while writing v2: no self-overwrite
    assert SK.current_version(spark, t) == v2 and v1 != v2
    assert SK.read_published(spark, t).first().x == 2
    assert SK.read_published(spark, t, "v1").first().x == 1


def test_write_partitioned_labels(spark, tmp_path):
    df = spark.createDataFrame([("a/b", 1), ("a/b", 2), ("", 3)], "bu string, v int")
    out = str(tmp_path / "by_bu")
    SK.write_partitioned(df, out, "bu", sort=["v"])
    back = spark.read.parquet(out)
    assert rows(back, "bu_label", "bu", "v") == [("No_BU", "", 3), ("a_b", "a/b", 1), ("a_b", "a/b", 2)]


def test_upsert_partitioned_rewrites_touched_days_only(spark, tmp_path):
    t = str(tmp_path / "sales")
    stored = spark.createDataFrame([(1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0)], "day int, item int, v double")
    stored.write.partitionBy("day").parquet(t)
    batch = spark.createDataFrame([(1, 10, 9.0)], "day int, item int, v double")
    SK.upsert_partitioned(spark, t, batch, ["day", "item"], "day")
    assert rows(spark.read.parquet(t), "day", "item", "v") == [(1, 10, 9.0), (1, 11, 2.0), (2, 10, 3.0)]


def test_ingest_stream_upserts_each_file_once(spark, tmp_path):
    from shelfwise.streaming.ingest import ingest_stream
    drop, table = str(tmp_path / "drop"), str(tmp_path / "table")
    _write(os.path.join(drop, "feed_1.csv"), "day,item,v\n1,10,1.0\n1,11,2.0\n")
    q = ingest_stream(spark, drop, table, ["day", "item", "v"], {"day": "int", "item": "int", "v": "double"},
                      ["day", "item"], prefix="feed_", checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    _write(os.path.join(drop, "feed_2.csv"), "day,item,v\n1,10,5.0\n")
    _write(os.path.join(drop, "other.csv"), "day,item,v\n9,9,9\n")
    q = ingest_stream(spark, drop, table, ["day", "item", "v"], {"day": "int", "item": "int", "v": "double"},
                      ["day", "item"], prefix="feed_", checkpoint=str(tmp_path / "ck"))
    q.awaitTermination()
    assert rows(SK.read_published(spark, table), "day", "item", "v") == [(1, 10, 5.0), (1, 11, 2.0)]


def test_batch_ingest_applies_files_one_after_another(spark, tmp_path):
    from shelfwise.operators.ingest import FeedSpec, ingest
    drop, tables = str(tmp_path / "drop"), str(tmp_path / "tables")
    _write(os.path.join(drop, "PythonOnlineSales_1.CSV"), "ignored: other suffix\n")
    _write(os.path.join(drop, "PythonOnlineSales_1.csv"), "day,item,v\n1,10,1.0\n1,11,2.0\n2,10,3.0\n")
    _write(os.path.join(drop, "onlinestores_a.csv"), "store,name\n1,A\n")
    _write(os.path.join(drop, "onlinestores_b.csv"), "store,name\n2,B\n")
    specs = [FeedSpec("sales", "pythononlinesales", {"day": "int", "item": "int", "v": "double"}, keys=("day", "item")),
             FeedSpec("stores", "onlinestores", {"store": "int"}),
             FeedSpec("calendar", "pythoncalendar")]
    a = {(r.feed, r.file): r for r in ingest(spark, drop, tables, specs).collect()}
    r = a["sales", "PythonOnlineSales_1.csv"]
    assert (r.rows_removed, r.rows_added, r.final_row_count, r.backup_version, r.error) == (0, 3, 3, None, None)
    assert rows(SK.read_published(spark, f"{tables}/stores")) == [(2, "B")]
    assert a["stores", "onlinestores_b.csv"].rows_removed == 1
    assert a["calendar", None].error == "no files"
    # columns in another order, and overlapping rows: the later file's row counts
    _write(os.path.join(drop, "pythononlinesales_2.csv"), "v,item,day\n9.0,10,1\n")
    a = {r.file: r for r in ingest(spark, drop, tables, specs[:1]).collect()}
    one, two = a["PythonOnlineSales_1.csv"], a["pythononlinesales_2.csv"]
    assert (one.rows_removed, one.rows_added, one.final_row_count) == (3, 3, 3)
    assert (two.rows_removed, two.rows_added, two.final_row_count) == (1, 1, 3)
    assert one.backup_version is not None and one.version != one.backup_version
    assert rows(SK.read_published(spark, f"{tables}/sales"), "day", "item", "v") == [(1, 10, 9.0), (1, 11, 2.0), (2, 10, 3.0)]


def _file_by_file(files, match):
    """The delete + append of one file after another, on lists."""
    table = []
    for f in files:
        days, items = {d for d, _, _ in f} - {None}, {i for _, i, _ in f} - {None}
        pairs = {(d, i) for d, i, _ in f if d is not None and i is not None}

        def gone(r):
            if match == "pair":
                return (r[0], r[1]) in pairs
            # three-valued IN: a null key with a filled set is unknown, and unknown rows go
            a = None if r[0] is None and days else r[0] in days
            b = None if r[1] is None and items else r[1] in items
            return not (a is False or b is False)
        table = [r for r in table if not gone(r)] + list(f)
    return sorted(table, key=str)


def test_merge_numbered_equals_file_by_file(spark):
    import random

    from shelfwise.operators.upsert import merge_numbered
    r = random.Random(3)
    for match in ("cross", "pair"):
        for trial in range(3):
            def some(n):
                return [(r.choice([None, 1, 2, 3, 4]), r.choice([None, 7, 8, 9]), float(r.randrange(100))) for _ in range(n)]
            stored, files = some(12), [some(r.randrange(1, 6)) for _ in range(4)]
            df = spark.createDataFrame([(*x, n) for n, f in enumerate(files, 1) for x in f], "day int, item int, v double, n int")
            st = spark.createDataFrame(stored, "day int, item int, v double")
            got = merge_numbered(st, df, ["day", "item"], "n", match).where("_gone IS NULL").select("day", "item", "v")
            assert sorted((tuple(x) for x in got.collect()), key=str) == _file_by_file([stored, *files], match)


def test_publish_retry_and_batches(spark, tmp_path):
    t = str(tmp_path / "table")
    SK.publish(spark.range(150_000), t, "batch_0", batch=0)
    again = SK.read_published(spark, t).union(spark.range(5))
    v = SK.publish(again, t, "batch_0")             # same name while reading it: a folder of its own
    assert v != "batch_0" and SK.read_published(spark, t).count() == 150_005
    assert SK.read_published(spark, t, "batch_0").count() == 150_000
    SK.publish(SK.read_published(spark, t), t, "batch_1", batch=1)
    assert SK.publish(spark.range(1), t, "batch_1", batch=1) == "batch_1"      # applied already: skipped
    assert SK.read_published(spark, t).count() == 150_005


def test_failed_publish_leaves_the_table(spark, tmp_path):
    import pytest
    t = str(tmp_path / "table")
    SK.publish(spark.range(3), t, "a")
    with pytest.raises(Exception):
        SK.publish(spark.range(3).select(F.raise_error(F.lit("stop")).alias("id")), t, "b")
    assert SK.current_version(spark, t) == "a" and SK.read_published(spark, t).count() == 3


def test_upsert_partitioned_keeps_null_days_and_text_keys(spark, tmp_path):
    t = str(tmp_path / "sales")
    schema = "day string, item int, v double, extra string"
    spark.createDataFrame([("007", 10, 1.0, "x"), (None, 77, 1.0, "x"), (None, 78, 2.0, "x")], schema).write.partitionBy("day").parquet(t)
    batch = spark.createDataFrame([(None, 79, 5.0), ("007", 11, 6.0)], "day string, item int, v double")
    SK.upsert_partitioned(spark, t, batch, ["day", "item"], "day")
    got = rows(SK.read_partitioned(spark, t, batch), "day", "item", "v", "extra")
    assert got == [(None, 77, 1.0, "x"), (None, 78, 2.0, "x"), (None, 79, 5.0, None), ("007", 10, 1.0, "x"), ("007", 11, 6.0, None)]


def test_preamble_quotes_line_ends_and_headers(spark, tmp_path):
    d = str(tmp_path / "sheets")
    _write(os.path.join(d, "a.csv"), 'title\r\nA,B\r\n"x,y",2\r\n"say ""hi""",\r\n')
    _write(os.path.join(d, "b.csv"), "title\nB,A\n3,z\n\n4,w\n")
    df = FS.read_preamble_csv(spark, d, header_row=2)
    assert set(df.columns) == {"A", "B"}
    assert rows(df, "A", "B") == [("", ""), ('say "hi"', ""), ("w", "4"), ("x,y", "2"), ("z", "3")]


def test_html_attributes_case_and_entities(spark):
    html = ('<TABLE border="1"><TR class=h><TH>UPC</TH><th>Item</th></TR><tr bgcolor=x><td align="right">12</td><td>A &amp; B</td></tr>'
            "<tr><td>13</td><td>C</td></tr></TABLE>")
    df = spark.createDataFrame([(1, html), (2, "no table")], "id int, html string")
    assert rows(FS.html_rows(df, "id", "html", ["UPC", "Item"]), "UPC", "Item") == [("12", "A & B"), ("13", "C")]
    assert [r[0] for r in FS.html_missing(df, "id", "html").collect()] == [2]


def test_last_match_and_strict_tables(spark):
    import pytest
    files = spark.createDataFrame([("/d/Reviews_a.csv", "Reviews_a.csv"), ("/d/Reviews_b.csv", "Reviews_b.csv")],
                                  "path string, file_name string")
    assert FS.last_match(FS.select_files(files, contains="review")).first().file_name == "Reviews_b.csv"
    df = spark.createDataFrame([(2, "<table><tr><th>X</th></tr></table>")], "id int, html string")
    with pytest.raises(RuntimeError):
        FS.html_rows(df, "id", "html", ["UPC"], strict=True)


def test_ingest_stream_partitioned_table(spark, tmp_path):
    from shelfwise.streaming.ingest import ingest_stream
    drop, table = str(tmp_path / "drop"), str(tmp_path / "table")
    spec = {"day": "int", "item": "int", "v": "double"}
    _write(os.path.join(drop, "feed_1.csv"), "day,item,v\n1,10,1.0\n1,11,2.0\n2,10,3.0\n")
    ingest_stream(spark, drop, table, ["day", "item", "v"], spec, ["day", "item"], prefix="feed_",
                  checkpoint=str(tmp_path / "ck"), partition_col="day").awaitTermination()
    _write(os.path.join(drop, "feed_2.csv"), "day,item,v\n1,10,5.0\n")
    ingest_stream(spark, drop, table, ["day", "item", "v"], spec, ["day", "item"], prefix="feed_",
                  checkpoint=str(tmp_path / "ck"), partition_col="day").awaitTermination()
    assert rows(spark.read.parquet(table), "day", "item", "v") == [(1, 10, 5.0), (1, 11, 2.0), (2, 10, 3.0)]


def test_html_row_maps_keep_all_columns(spark):
    html = "<table><tr><th>UPC</th><th>Item</th><th>Trade1</th></tr><tr><td>1</td><td>A</td><td></td></tr></table>"
    df = spark.createDataFrame([(1, html)], "id int, html string")
    r = FS.html_row_maps(df, "id", "html").first()
    assert r.cells == {"UPC": "1", "Item": "A", "Trade1": None}


def _csv(path, text_columns, rows_):
    """A CSV with all declared columns; rows give some of them by name."""
    names = list(text_columns)
    lines = [",".join(names)] + [",".join(str(r.get(n, "")) for n in names) for r in rows_]
    _write(path, "\n".join(lines) + "\n")


def test_seven_feeds_and_the_merged_catalogue(spark, tmp_path):
    from shelfwise.sources import feeds
    drop, tables = str(tmp_path / "drop"), str(tmp_path / "tables")
    web = [c for c in feeds.columns(feeds.WEBSITE) if not c.startswith("order count")]
    raw = ["online product interaction conversion rate " if c == "online product interaction conversion rate" else c for c in web]
    day = {"day": "10/15/2024", "oms id +": 7}
    _csv(f"{drop}/PythonOnlineWebsiteAnalysis_1.csv", raw, [
        {**day, "online product interaction conversion rate ": 0.5, "online pip visits +": 10, "online pip conversion rate +": 0.2}])
    _csv(f"{drop}/PythonOnlineSales_1.csv", feeds.columns(feeds.SALES), [{**day, "online sales $ +": 3.5, "online return units +": 1.5}])
    _csv(f"{drop}/PythonOnlineSales_2.csv", feeds.columns(feeds.SALES), [{**day, "online sales $ +": 4.5}])
    _csv(f"{drop}/PythonOnlineClassification.csv", feeds.columns(feeds.CLASSIFICATION), [
        {"oms id +": 7, "online upc +": "000000000123", "online class +": "first"}, {"oms id +": 7, "online upc +": "000000000123", "online class +": "second"},
        {"oms id +": 8, "online upc +": "short"}])
    score = [c for c in feeds.columns(feeds.SCORECARD) if c]
    _csv(f"{drop}/sheet.csv", score, [{"OMSID": 7, "TOTAL SCORE": 2.5}])
    with open(f"{drop}/sheet.csv") as f:
        _write(f"{drop}/BA Scorecard 1.csv", "x\n" * 27 + f.read())
    _csv(f"{drop}/OnlineStores.csv", feeds.columns(feeds.STORES), [{"icr store nbr +": "0012", "icr byo nbr +": 3}])
    _csv(f"{drop}/PythonCalendar_Full.csv", ["week"], [{"week": "Fiscal Week 1 of 2025"}])
    fg = feeds.columns(feeds.FG_STATUS)
    _csv(f"{drop}/FG Status Report.csv", [*fg, *[c for c in ("Basic", "Dash") if c not in fg]], [
        {"UPC": "00000000012", "M P G": "m1", "Basic": "b", "Dash": "d"}, {"UPC": "00000000012", "M P G": "m2", "Basic": "b", "Dash": "d"}])
    audit = feeds.run(spark, drop, tables).collect()
    assert not [r for r in audit if r.error], [r.error for r in audit if r.error]
    assert {r.feed for r in audit} == {f.name for f in feeds.feed_specs()} and len(audit) == 8
    assert {r.feed: r.warning for r in audit if r.warning} == {"fg_status": "expected 15000 to 20000 rows, got 1"}
    get = lambda t: SK.read_published(spark, f"{tables}/{t}").collect()
    w = get("online_website_anaylsis")[0]
    assert w["order count TY"] == 2.0 and w["online product interaction conversion rate"] == 0.5 and w["day"].day == 15
    assert [r["online sales $ +"] for r in get("online_sales")] == [4.5]
    assert [r["online class +"] for r in get("online_classification")] == ["first"]
    assert [(r["OMSID"], r["TOTAL SCORE"]) for r in get("BA_scorecard")] == [(7, 2.5)]
    assert get("online_stores")[0]["icr store nbr +"] == "0012" and len(get("calendar")) == 1
    m = get("merged_classification")
    assert len(m) == 1 and (m[0]["oms id +"], m[0]["M P G"], m[0]["Basic-Dash"]) == (7, "m1", "b-d")
