"""Operators on small hand-made fixtures (FIXTURES.md section 3), plus the
invariants of SURVEY section 5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfwise.operators import backlog as BL
from shelfwise.operators import dedupe as D
from shelfwise.operators import diff as DF
from shelfwise.operators import dq as DQ
from shelfwise.operators import enrich as E
from shelfwise.operators import kpis as K
from shelfwise.operators import upsert as U

KEYS = [(1, 1), (1, 2), (2, 1), (None, 1), (None, 9), (9, None), (1, None)]


def _stored(spark):
    return spark.createDataFrame([(i, d, it) for i, (d, it) in enumerate(KEYS)], "rid int, day int, item int")


def test_two_set_delete_matches_sql_semantics(spark):
    batch = spark.createDataFrame([(1, 1), (2, 2)], "day int, item int")
    kept = U.delete_matching(_stored(spark), batch, ["day", "item"], "cross")
    assert rows(kept, "day", "item") == [(None, 9), (9, None)]


def test_pairwise_delete(spark):
    batch = spark.createDataFrame([(1, 1), (2, 2)], "day int, item int")
    kept = U.delete_matching(_stored(spark), batch, ["day", "item"], "pair")
    assert len(rows(kept)) == 6 and (1, 1) not in rows(kept, "day", "item")


def test_delete_with_empty_batch_keeps_all(spark):
    batch = spark.createDataFrame([], "day int, item int")
    assert U.delete_matching(_stored(spark), batch, ["day", "item"]).count() == len(KEYS)


def test_conditions_validate_and_need_all_keys(spark):
    s = _stored(spark)
    with pytest.raises(ValueError):
        U.mark_deletes(s, None, ["day", "item"], conditions={"store": [1]})
    only_day = U.delete_matching(s, None, ["day", "item"], conditions={"day": [1]})
    assert only_day.count() == len(KEYS)
    both = U.delete_matching(s, None, ["day", "item"], conditions={"day": ["1"], "item": [1, 2]})
    # (null, 1) and (1, null) are lost by three-valued logic, as in the reference
    assert rows(both, "day", "item") == [(None, 9), (2, 1), (9, None)]


def test_upsert_is_idempotent_and_counts(spark):
    stored = spark.createDataFrame([(1, 10, 1.0), (1, 11, 2.0), (2, 10, 3.0)], "day int, item int, v double")
    batch = spark.createDataFrame([(1, 10, "9")], "day int, item int, v string")
    once, stats = U.upsert(stored, batch, ["day", "item"])
    twice, _ = U.upsert(once, batch, ["day", "item"])
    assert rows(once) == rows(twice)
    assert dict(once.schema.fields[2].jsonValue())["type"] == "double"
    s = stats.first()
    assert (s.rows_before, s.rows_removed, s.rows_added, s.final_row_count) == (3, 1, 1, 3)


def test_prefer_active(spark):
    data = [("A", "Active", "1"), ("B", "Obsolete", "2"), ("C", "Active", "3"), ("C", "Obsolete", "4"),
            ("D", "Obsolete", "5"), ("D", "Sell Off", "6"), ("E", "Active", "7"), ("E", "Active", "8"),
            ("E", "Obsolete", "9"), (None, "Active", "10")]
    df = spark.createDataFrame([(u, s, n, i) for i, (u, s, n) in enumerate(data)],
                               "upc string, status string, item string, o int")
    out = D.prefer_active_rollup(df, "upc", "status", "item", ["o"])
    assert rows(out) == [("A", "Active", "1"), ("B", "Obsolete", "2"), ("C", "Active", "3"),
                         ("D", "Obsolete,Sell Off", "5,6"), ("E", "Active,Active", "7,8"),
                         ("nan", "Active", "10")]


def test_string_rollups(spark):
    df = spark.createDataFrame([("k", "b", 1), ("k", "a", 2), ("k", "b", 3), ("n", None, 1), (None, "z", 1)],
                               "k string, v string, o int").dropna(subset=["k"])
    dup = D.rollup_text(df, ["k"], {"v": (", ", False)}, ["o"])
    uni = D.rollup_text(df, ["k"], {"v": (", ", True)}, ["o"])
    assert rows(dup) == [("k", "b, a, b"), ("n", "")]
    assert rows(uni) == [("k", "b, a"), ("n", "")]


def test_first_per_key_and_first_nonnull(spark):
    df = spark.createDataFrame([(1, None, "x", 2), (1, "a", "y", 3), (1, "b", None, 1), (2, None, None, 1)],
                               "k int, a string, b string, o int")
    assert rows(D.first_per_key(df, ["k"], ["o"]), "k", "a", "b") == [(1, "b", None), (2, None, None)]
    assert rows(D.first_nonnull_per_key(df, ["k"], ["o"], ["a", "b"])) == [(1, "b", "x"), (2, None, None)]
    assert rows(D.duplicate_keys(df, ["k"])) == [(1, 3)]


def test_keep_null_on_not_equal(spark):
    df = spark.createDataFrame([("excluded-network",), ("us",), (None,)], "n string")
    assert BL.keep_unless_equal(df, "n", "excluded-network").count() == 2


def test_backlog(spark):
    as_of = "2024-03-01 00:00:00"
    d = dt.datetime(2024, 3, 1)
    data = [("X", None, 5), ("X", d - dt.timedelta(days=14), 1), ("X", d - dt.timedelta(days=15), 3),
            ("X", d - dt.timedelta(days=1), None), ("", d, 2), ("Y", None, 1)]
    df = spark.createDataFrame(data, "bu string, dt timestamp_ntz, rating int")
    out = BL.backlog(df, "bu", "dt", as_of, rating="rating")
    r = {x.bu: x for x in out.collect()}
    assert set(r) == {"X", "Y"}
    assert (r["X"]["count"], r["X"].old_count, r["X"].low_rating_count, r["X"].row_count) == (3, 1, 2, 4)
    assert r["X"].oldest_date_str == "2024-02-15" and r["Y"].oldest_date_str == "No Date"
    kept = BL.backlog(df, "bu", "dt", as_of, keep_blank_bu=True)
    assert "No BU" in {x.bu for x in kept.collect()}


def _snap(spark, data):
    return spark.createDataFrame(data, "omsid string, dc string, ntwk_replen string, dc_replen string, "
                                       "oh_qty double, oo_qty double")


def test_snapshot_diff_labels(spark):
    low = _snap(spark, [("1", "DC10X", "ON", "ON", 5.0, None),      # id 1 gone next week
                        ("2", "DC20", "ON", "ON", 1.0, 0.0),         # ON -> OFF
                        ("3", "DC30", "OFF", "OFF", 4.0, None),      # all off, inventory to 0
                        ("4", None, "ON", "ON", 1.0, 1.0),           # null DC matches null DC
                        ("5", "DC50", "ON", "ON", 1.0, 1.0), ("5", "DC50", "ON", "ON", 1.0, 1.0),
                        ("0", "DC00", "ON", "ON", 1.0, 1.0), ("bad", "DC00", "ON", "ON", 1.0, 1.0)])
    high = _snap(spark, [("2", "DC20", "ON", "OFF", 1.0, 0.0),
                         ("3", "DC30", "OFF", "OFF", 0.0, None),
                         ("4", None, "ON", "ON", 1.0, 1.0),
                         ("5", "DC50", "ON", "ON", 1.0, 1.0), ("5", "DC50", "ON", "ON", 1.0, 1.0),
                         ("5", "DC51", "ON", "ON", 1.0, 1.0),       # new DC for known id
                         ("6", "DC60", "ON", "ON", 1.0, 1.0)])      # new id
    out = DF.snapshot_diff(low, high)
    got = sorted((r.omsid, r.dc, r.change_type) for r in out.collect())
    assert got == sorted([(1, "DC10", DF.MISSING_ID), (2, "DC20", DF.REPLEN_CHANGE),
                          (3, "DC30", DF.ZERO_INVENTORY), (5, "DC51", DF.NEW_COMBO),
                          (6, "DC60", DF.NEW_COMBO)])
    counts = {r.change_type: r["count"] for r in DF.change_counts(out).collect()}
    assert counts == {DF.NEW_COMBO: 2, DF.REPLEN_CHANGE: 1, DF.ZERO_INVENTORY: 1, DF.MISSING_ID: 1}
    assert DF.count_changes(low, high).collect() == DF.change_counts(out).collect()
    nothing = low.limit(0)
    assert {r["count"] for r in DF.count_changes(nothing, nothing).collect()} == {0}
    assert DF.zero_inventory(nothing, high).count() == 0
    same = DF.snapshot_diff(low, low)
    assert same.count() == 0 and DF.change_counts(same).filter("count > 0").count() == 0


def test_distribute_evenly_conserves_sums(spark):
    fact = spark.createDataFrame([("w1", 1, 10.0), ("w1", 2, 1.0), ("w1", 2, 2.0), ("w1", 2, 3.0)],
                                 "week string, item int, sales double")
    web = spark.createDataFrame([("w1", 1, 6.0), ("w1", 2, 9.0), ("w1", 3, 4.0)],
                                "week string, item int, total_visits double")
    out = E.distribute_evenly(fact, web, ["week", "item"], ["total_visits"])
    assert out.count() == 5 and rows(E.key_spine(fact, web, ["week", "item"]), "item") == [(1,), (2,), (3,)]
    assert out.agg(F.sum("total_visits")).first()[0] == pytest.approx(19.0)
    assert rows(out.filter("item = 2"), "total_visits") == [(3.0,), (3.0,), (3.0,)]
    assert rows(out.filter("item = 3"), "sales", "total_visits") == [(None, 4.0)]


def test_kpis_zero_denominators_and_share(spark):
    df = spark.createDataFrame([("a", 10.0, 0.0, 0, 0, 0.0, 0), ("a", 5.0, 0.0, None, 0, -1.0, 2),
                                ("b", 20.0, 10.0, 4, 2, 0.0, 1)],
                               "d string, sales double, sales_ly double, units int, units_ly int, "
                               "return_amt double, cancel_units int")
    k = {r.d: r for r in K.sales_kpis(df, ["d"]).collect()}
    assert k["a"].sales_growth_pct == pytest.approx((15.0 / 1 - 1) * 100)
    assert k["a"].returns == 1.0 and k["a"].cancel_rate == pytest.approx(200.0)
    assert k["b"].net_sales == pytest.approx(20.0 - 1 * 20.0 / 4)
    share = K.share_of_total(df, "d").agg(F.sum("sales_share")).first()[0]
    assert share == pytest.approx(100.0)
    st = K.standouts(K.sales_kpis(df, ["d"]), "sales_diff", 1, 1)
    assert rows(st, "standout", "d") == [("bottom", "b"), ("top", "a")]


def test_prefix_join_fans_out(spark):
    left = spark.createDataFrame([("123456789011",), ("",)], "upc string")
    right = spark.createDataFrame([("12345678901A", "m1"), ("12345678901B", "m2"), ("", "blank")],
                                  "code string, m string")
    out = E.join_prefix(left, right, "upc", "code", 11)
    assert rows(out, "upc", "m") == [("", "blank"), ("123456789011", "m1"), ("123456789011", "m2")]
    one = E.join_prefix(left, right, "upc", "code", 11, right_cols=["m"], one_per_prefix=["code"])
    assert rows(one, "upc", "m") == [("", "blank"), ("123456789011", "m1")]


def test_dq_and_profile(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, s string")
    rep = {r.rule: r for r in DQ.dq_report(df, [
        {"rule": "required_columns", "columns": ["k", "x"]}, {"rule": "unique_key", "keys": ["k"]},
        {"rule": "row_count_range", "min": 1, "max": 2}, {"rule": "non_empty"},
        {"rule": "row_conservation", "before": df}]).collect()}
    assert not rep["required_columns"].passed and rep["required_columns"].detail == "x"
    assert rep["unique_key"].observed == 1 and not rep["row_count_range"].passed
    assert rep["non_empty"].passed and rep["row_conservation"].passed
    prof = {r.column_name: r for r in DQ.profile(df).collect()}
    assert (prof["k"].null_count, prof["k"].unique_count, prof["k"].stat) == (0, 2, "Min: 1, Max: 2")
    assert (prof["s"].null_count, prof["s"].unique_count, prof["s"].stat) == (1, 3, "a, b")


def test_distinct_count_null_rules_and_top_n(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), ("b", 4), ("b", 5), ("b", 6)], "k string, v int")
    assert tuple(D.distinct_count(df, ["k"]).first()) == (2,)
    assert tuple(D.distinct_count(df, ["k"], null_as_value=True).first()) == (3,)
    top = D.top_n_per_group(df.dropna(), ["k"], [F.col("v").desc()], 2, buckets=3)
    assert rows(top, "k", "v", "rank") == [("a", 1, 2), ("a", 2, 1), ("b", 5, 2), ("b", 6, 1)]


def test_group_all_any_null_is_false(spark):
    df = spark.createDataFrame([(1, "OFF"), (1, None), (2, "OFF"), (2, "OFF")], "k int, r string")
    got = rows(D.group_all_any(df, ["k"], {"off": F.col("r") == "OFF"}))
    assert got == [(1, False, True), (2, True, True)]


def test_net_sales_skips_rows_with_nulls_and_is_not_rounded(spark):
    from shelfwise.operators import kpis as K
    df = spark.createDataFrame([("a", 10.0, 1.0, 2, 2, 0.0, 0), ("a", 6.0, 1.0, None, 2, 0.0, 0), ("a", 5.0, 1.0, 1, 1, None, 0),
                                ("b", 0.333, 0.0, 1, 1, 0.0, 0)],
                               "d string, sales double, sales_ly double, units int, units_ly int, return_amt double, cancel_units int")
    got = {r.d: r for r in K.sales_kpis(df, ["d"]).collect()}
    assert got["a"].net_sales == 10.0 and got["a"].ty_sales == 21.0 and abs(got["b"].net_sales - 0.333) < 1e-12


def test_share_of_a_zero_total(spark):
    from shelfwise.operators import kpis as K
    df = spark.createDataFrame([("a", 0.0, 0.0)], "d string, sales double, sales_ly double")
    assert K.share_of_total(df, "d").first().sales_share == 0.0


def test_money_mean_is_not_rounded(spark):
    from shelfwise.operators import quotes as QT
    df = spark.createDataFrame([("o", 1, 1.004), ("o", 2, 1.004)], "owner string, order_no int, quote_total double")
    assert QT.owner_summary(df).first().avg_quote_total == 1.004


def test_blank_groups_are_one(spark):
    from shelfwise.operators import backlog as BL
    df = spark.createDataFrame([("", None), ("  ", None), (None, None), ("x", None)], "bu string, d timestamp_ntz")
    got = {r.bu: r.row_count for r in BL.backlog(df, "bu", "d", "2024-01-01", keep_blank_bu=True).collect()}
    assert got == {"No BU": 3, "x": 1}


def test_row_counts_of_missing_and_empty_tables(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "a"))
    spark.range(0).write.parquet(str(tmp_path / "b"))
    got = {r.table_name: (r.row_count, r.status) for r in DQ.table_row_counts(
        spark, {n: str(tmp_path / n) for n in "abc"}).collect()}
    assert got == {"a": (5, "ok"), "b": (0, "ok"), "c": (None, "missing")}
    assert DQ.profile(spark.createDataFrame([("a",), ("a",), ("b",)], "s string")).first().stat == "a, b"


def test_combine_dense_has_every_item_in_every_week(spark):
    from shelfwise.operators import jobs as JB
    sales = spark.createDataFrame([("w1", 1, 5, 2.0), ("w1", 1, 6, 3.0)], "week string, item int, store int, sales double")
    totals = spark.createDataFrame([("w1", 1, 10.0), ("w2", 2, 4.0)], "week string, item int, total_visits double")
    cat = spark.createDataFrame([(1, "c")], "item int, class string")
    score = spark.createDataFrame([(1, 9.0)], "item int, total_score double")
    stores = spark.createDataFrame([(5, "S")], "store int, store_name string")
    cal = spark.createDataFrame([("w1",), ("w2",), ("w3",)], "week string")
    out = JB.combine(sales, totals, cat, score, stores, ["total_visits"])
    assert rows(out, "week", "item", "store", "total_visits", "class", "store_name") == [
        ("w1", 1, 5, 5.0, "c", "S"), ("w1", 1, 6, 5.0, "c", None), ("w2", 2, None, 4.0, None, None)]
    dense = JB.combine(sales, totals, cat, score, stores, ["total_visits"], calendar=cal, dense=True)
    assert dense.select("week", "item").distinct().count() == 6 and dense.count() == 7
    few = JB.combine(sales, totals, cat, score, stores, ["total_visits"], calendar=cal.where("week = 'w2'"))
    assert rows(few, "week", "item") == [("w2", 2)]


def test_weekly_report_tables(spark):
    from shelfwise.operators import jobs as JB
    sales = spark.createDataFrame(
        [(1, 1, dt.datetime(1998, 1, 2), "Fiscal Week 1 of 1998", 10.0, 5.0, 1, 1, 0.0, 0), (1, 1, dt.datetime(1998, 1, 9), "Fiscal Week 2 of 1998", 8.0, 5.0, 1, 1, 4.0, 0),
         (1, 9, dt.datetime(1998, 1, 9), "Fiscal Week 2 of 1998", 8.0, 5.0, 1, 1, 4.0, 0), (1, 1, dt.datetime(1999, 1, 9), "Fiscal Week 2 of 1999", 8.0, 5.0, 1, 1, 4.0, 0)],
        "item int, store int, day timestamp_ntz, week string, sales double, sales_ly double, units int, units_ly int, return_amt double, cancel_units int")
    cat = spark.createDataFrame([(1, "d")], "item int, dept string")
    st = spark.createDataFrame([(1, "m")], "store int, market string")
    base = JB.report_base(sales, cat, st, "of 1998", ("1998-01-01", "1998-02-26"))
    t = JB.weekly_report(base, ["dept"], share_dims=["market"])
    assert base.count() == 2 and [(r.dept, r.ty_sales, r.return_rate) for r in t["kpis"].collect()] == [("d", 8.0, 50.0)]
    assert t["trend"].count() == 2 and t["high_return"].count() == 1 and t["high_cancel"].count() == 0
    assert t["share_market"].first().sales_share == 100.0 and t["standouts"].count() == 2
