"""Stored layouts and kept results: plans, and equality with a full run."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfwise.operators import maintained as M
from shelfwise.operators import upsert as U
from shelfwise.sources import layout as L
from shelfwise.sources import sinks as SK


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_latest_weeks_prune_the_fact(spark, tmp_path):
    data = [(f"Fiscal Week {w} of {y}", i, 10 * w + i) for y in (2023, 2024) for w in (1, 2, 9, 10, 52) for i in range(20)]
    data += [(None, 1, 1), ("no week", 2, 2)]
    df = spark.createDataFrame(data, "week string, item int, sales int")
    L.write_weekly(df, str(tmp_path / "f"))
    out = L.latest_weeks(spark, str(tmp_path / "f"))
    assert "dynamicpruning" in plan(out)
    assert {r["week"] for r in out.collect()} == {"Fiscal Week 52 of 2024"} and out.count() == 20
    two = L.latest_weeks(spark, str(tmp_path / "f"), 2)
    assert {r["week"] for r in two.collect()} == {"Fiscal Week 52 of 2024", "Fiscal Week 10 of 2024"}
    assert spark.read.parquet(str(tmp_path / "f")).count() == len(data)
    L.write_weekly(df.limit(0), str(tmp_path / "e"))


def test_files_of_other_weeks_are_not_read(spark, tmp_path):
    df = spark.range(5000).select(F.concat(F.lit("Fiscal Week "), (F.col("id") % 50 + 1).cast("string"), F.lit(" of 2024")).alias("week"),
                                  F.col("id").alias("item"))
    L.write_weekly(df, str(tmp_path / "f"))
    out = L.latest_weeks(spark, str(tmp_path / "f"))
    out.collect()
    found = []

    def walk(node):
        for i in range(node.children().size()):
            walk(node.children().apply(i))
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            walk(node.plan())
        if name == "FileSourceScanExec":
            found.append((node.requiredSchema().size(), node.metrics().apply("numFiles").value()))
    out2 = out.select("item")
    qe = out2._jdf.queryExecution()
    out2._jdf.collectToPython()
    walk(qe.executedPlan())
    files = [n for cols, n in found if cols > 0]
    assert files and max(files) < 5, found


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    a = spark.range(1000).select((F.col("id") % 100).alias("item"), F.col("id").alias("v"))
    b = spark.range(80).select(F.col("id").alias("item"), (F.col("id") * 2).alias("w"))
    want = rows(a.join(b, "item", "left"))
    x = L.write_bucketed(a, "test_fact", str(tmp_path / "a"), ["item"], 8)
    y = L.write_bucketed(b, "test_dim", str(tmp_path / "b"), ["item"], 8)
    keep = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = x.join(y, "item", "left")
        assert "Exchange" not in plan(out) and "SortMergeJoin" in plan(out)
        summed = out.groupBy("item").agg(F.sum("w").alias("s"))
        assert "Exchange" not in plan(summed)
        assert rows(out) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", keep)


def group():
    return {"shop": F.col("shop"), "big": F.col("item") > 5}


def measures():
    return {"qty": F.col("qty"), "cents": F.col("price").cast("decimal(18,2)")}


def delivery(spark, seed, n):
    r = random.Random(seed)
    data = [(r.choice([None, 1, 2, 3, 4]), r.choice([None, *range(10)]), r.choice(["a", "b", None]), r.choice([None, 1, 5]),
             round(r.random() * 9, 2)) for _ in range(n)]
    return spark.createDataFrame(data, "day int, item int, shop string, qty int, price double")


@pytest.mark.parametrize("match", ["cross", "pair"])
def test_kept_sums_equal_a_full_run(spark, tmp_path, match):
    table, sums = str(tmp_path / "t"), str(tmp_path / "s")
    stored = None
    for k in range(4):
        batch = delivery(spark, k, 60 if k == 0 else 6)
        got = M.maintain(spark, table, sums, batch, ["day", "item"], group(), measures(), match)
        stored = batch if stored is None else U.upsert(stored, batch, ["day", "item"], match)[0]
        assert rows(got) == rows(M.full_sums(stored, group(), measures())), k
    assert rows(SK.read_published(spark, table)) == rows(stored)


def test_kept_sums_recover_from_a_lost_publish(spark, tmp_path):
    table, sums = str(tmp_path / "t"), str(tmp_path / "s")
    M.maintain(spark, table, sums, delivery(spark, 1, 30), ["day", "item"], group(), measures())
    more = SK.read_published(spark, table).unionByName(delivery(spark, 2, 10))
    SK.publish(more, table)                    # the table moved on, its sums did not
    got = M.maintain(spark, table, sums, delivery(spark, 3, 5), ["day", "item"], group(), measures())
    assert rows(got) == rows(M.full_sums(SK.read_published(spark, table), group(), measures()))
    again = M.maintain(spark, table, sums, delivery(spark, 3, 5).limit(0), ["day", "item"], group(), measures())
    assert rows(again) == rows(got)


def test_sums_of_doubles_are_refused(spark):
    with pytest.raises(ValueError, match="price"):
        M.full_sums(delivery(spark, 1, 2), group(), {"price": F.col("price")})


def test_sketches_read_new_files_only_and_merge(spark, tmp_path):
    path, sketches = str(tmp_path / "t"), str(tmp_path / "k")
    part = lambda a, b: spark.range(a, b).select(F.col("id"), F.when(F.col("id") % 4 > 0, (F.col("id") % 50).cast("string")).alias("s"),
                                                 (F.col("id") / 7).alias("x")).coalesce(2)
    part(0, 20000).write.parquet(path)
    first = {r["column"]: r for r in M.sketched_profile(spark, path, sketches).collect()}
    assert first["id"]["rows"] == 20000 and abs(first["id"]["distinct_values"] - 20000) < 20000 * 0.08
    before = spark.read.parquet(sketches).count()
    part(10000, 30000).write.mode("append").parquet(path)
    grown = {r["column"]: r for r in M.sketched_profile(spark, path, sketches).collect()}
    assert spark.read.parquet(sketches).count() == 2 * before               # facts of the new files only
    assert grown["id"]["rows"] == 40000 and abs(grown["id"]["distinct_values"] - 30000) < 30000 * 0.08
    assert grown["s"]["nulls"] == 10000 and 36 <= grown["s"]["distinct_values"] <= 51
    assert abs(grown["x"]["distinct_values"] - 30000) < 30000 * 0.08
    M.sketched_profile(spark, path, sketches)
    assert spark.read.parquet(sketches).count() == 2 * before
