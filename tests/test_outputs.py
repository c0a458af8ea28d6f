"""Order inside partitioned outputs, sheets larger than a split, counts in flight, first rows."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows
from shelfwise.operators import dq as DQ
from shelfwise.operators import ingest as IN
from shelfwise.sources import files as FS
from shelfwise.sources import sinks as SK


@pytest.fixture
def small_splits(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    before = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_outputs_are_ordered_across_files(spark, tmp_path, small_splits):
    r = random.Random(3)
    data = [(i, "hot" if i % 3 else r.choice(["a/b", "c", None]), r.choice([None, r.randrange(500)]), "x" * 20) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, bu string, days int, pad string").repartition(6)
    path = str(tmp_path / "out")
    SK.write_partitioned(df, path, "bu", ["days"])
    rep = {x["label"]: x for x in SK.order_report(spark, path, "bu_label", "days").collect()}
    assert set(rep) == {"hot", "a_b", "c", "No_BU"} and sum(x["rows"] for x in rep.values()) == 3000
    assert all(x["rows_out_of_order"] == 0 and x["files_out_of_order"] == 0 for x in rep.values())
    assert rep["hot"]["files"] > 1                     # a hot label spans tasks
    assert rows(spark.read.parquet(path), "id") == rows(df, "id")
    plan = df.repartitionByRange("bu")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" in plan


def test_order_report_sees_disorder(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("a", 3), ("a", None), ("a", 2)], "l string, k int").coalesce(1)
    df.write.partitionBy("l").parquet(str(tmp_path / "bad"))
    assert SK.order_report(spark, str(tmp_path / "bad"), "l", "k").first()["rows_out_of_order"] == 2


def test_lines_are_numbered_over_splits(spark, tmp_path, small_splits):
    r = random.Random(5)
    want = []
    for f in range(3):
        lines = ["".join(r.choice("ab,c é") for _ in range(r.randrange(0, 60))) for _ in range(200 + f)]
        (tmp_path / f"s{f} +x.csv").write_bytes(("\r\n" if f == 1 else "\n").join(lines).encode() + (b"\n" if f else b""))
        want += [(f"s{f} +x.csv", i + 1, x) for i, x in enumerate(lines)]
    got = FS.numbered_lines(spark, str(tmp_path))
    assert got.rdd.getNumPartitions() > 3 or spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 3
    assert sorted((x["_file"], x["row_no"], x["line"]) for x in got.collect()) == sorted(want)


def test_a_large_sheet_reads_the_same_in_any_splits(spark, tmp_path, small_splits):
    for f, head in (("a", "id,,name"), ("b", "name,id")):
        body = "".join(f"{i},b{i},\"n, {i}\"\n" if f == "a" else f"m{i},{i}\n" for i in range(400))
        (tmp_path / f"{f}.csv").write_text("report\n" + "note " * 100 + "\n\n" + head + "\n" + body)
    got = FS.read_preamble_csv(spark, str(tmp_path), 4, with_file=True)
    out = {(x["_file"], x["_row"]): (x["id"], x["_c1"], x["name"]) for x in got.collect()}
    want = {("a.csv", 5 + i): (str(i), f"b{i}", f"n, {i}") for i in range(400)}
    want |= {("b.csv", 5 + i): (str(i), None, f"m{i}") for i in range(400)}
    assert out == want
    ordered = FS.read_preamble_csv(spark, str(tmp_path), 4).collect()
    assert [x["id"] for x in ordered] == [str(i) for i in range(400)] * 2
    assert FS.read_preamble_csv(spark, str(tmp_path), 99_999).count() == 0


class Jobs:
    """Jobs that ran inside a with block, counted by a job group's ids."""
    def __init__(self, spark):
        self.sc = spark.sparkContext

    def __enter__(self):
        self.sc.setJobGroup("counted", "counted")
        self.before = set(self.sc.statusTracker().getJobIdsForGroup("counted"))
        return self

    def __exit__(self, *_):
        self.n = len(set(self.sc.statusTracker().getJobIdsForGroup("counted")) - self.before)
        self.sc.setLocalProperty("spark.jobGroup.id", None)


def test_counts_are_taken_while_writing(spark, tmp_path):
    drop = tmp_path / "drop"
    drop.mkdir()
    spec = IN.FeedSpec("sales", "sales", {"day": "int", "item": "int", "qty": "int"}, keys=("day", "item"))
    (drop / "Sales1.csv").write_text("day,item,qty\n1,1,5\n1,2,6\n2,1,7\n")
    (drop / "sales2.csv").write_text("day,item,qty\n2,1,8\n3,3,9\n")
    first = IN.ingest(spark, str(drop), str(tmp_path / "t"), [spec]).collect()
    assert [(r["file"], r["rows_removed"], r["rows_added"], r["final_row_count"], r["error"]) for r in first] == [
        ("Sales1.csv", 0, 3, 3, None), ("sales2.csv", 1, 2, 4, None)]
    again = IN.ingest(spark, str(drop), str(tmp_path / "t"), [spec]).collect()
    assert again[-1]["final_row_count"] == 4 == SK.read_published(spark, str(tmp_path / "t" / "sales")).count()


def test_one_write_counts_like_a_full_count(spark, tmp_path, monkeypatch):
    r = random.Random(2)
    data = [(r.randrange(4), r.choice([None, 1, 2, 3]), i) for i in range(500)]
    marked = spark.createDataFrame(data, "_n int, _gone int, v int").repartition(7)
    want = ({n: sum(x[0] == n for x in data) for n in range(4)}, {n: sum(x[1] == n for x in data) for n in (1, 2, 3)})
    df, counts = IN.counted(marked, 3, "f")
    with Jobs(spark) as jobs:
        df.where("_gone IS NULL").write.parquet(str(tmp_path / "one"))
        got = counts()
    assert got == want and jobs.n <= 2          # the write (its shuffle may be a job of its own under AQE)
    monkeypatch.setattr(IN, "OBSERVED", 2)
    df, counts = IN.counted(marked, 3, "f")
    df.where("_gone IS NULL").write.parquet(str(tmp_path / "two"))
    assert counts() == want


def test_first_rows_and_values_follow_the_files(spark, tmp_path):
    path = str(tmp_path / "t")
    for i, part in enumerate((["z", None, "y"], [], ["b", "a", None])):
        spark.createDataFrame([(v, i) for v in part], "s string, i int").coalesce(1).write.parquet(f"{path}/p{i}")
    df = spark.read.option("recursiveFileLookup", True).parquet(path)
    assert [tuple(x) for x in DQ.first_rows(df, 4).collect()] == [("z", 0), (None, 0), ("y", 0), ("b", 2)]
    prof = {x["column_name"]: x for x in DQ.profile(df).collect()}
    assert prof["s"]["stat"] == "z, y, b" and prof["s"]["sample_values"] == "z, null" and prof["s"]["row_count"] == 6
    assert prof["i"]["stat"] == "Min: 0, Max: 2" and prof["i"]["sample_values"] == "0, 0"
    made = DQ.profile(spark.createDataFrame([("b",), ("a",), ("b",)], "s string")).first()
    assert made["stat"] == "a, b" and made["sample_values"] is None and made["row_count"] == 3
    empty = DQ.profile(df.where("false")).collect()
    assert [x["row_count"] for x in empty] == [0, 0]
