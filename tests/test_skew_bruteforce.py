"""Operators against brute-force Python on fixtures where one key holds a
third of all rows (the hot-key case the design must survive), with nulls
and duplicates mixed in."""

import random

import pytest

from shelfwise.operators import dedupe as D
from shelfwise.operators import diff as DF
from shelfwise.operators import enrich as E
from shelfwise.operators import upsert as U

N = 3000


def _keys(rnd, n, hot, spread):
    return [hot if rnd.random() < 1 / 3 else rnd.randrange(spread) for _ in range(n)]


@pytest.fixture(scope="module")
def rnd():
    return random.Random(7)


def test_first_per_key_hot_key(spark, rnd):
    ks = _keys(rnd, N, 0, 50)
    data = [(k, i, rnd.choice(["a", "b", None])) for i, k in enumerate(ks)]
    rnd.shuffle(data)
    df = spark.createDataFrame(data, "k int, o int, v string").repartition(7)
    got = {r.k: (r.o, r.v) for r in D.first_per_key(df, ["k"], ["o"]).collect()}
    want = {}
    for k, o, v in sorted(data, key=lambda t: t[1]):
        want.setdefault(k, (o, v))
    assert got == want


def test_unique_rollup_hot_key(spark, rnd):
    ks = _keys(rnd, N, 1, 20)
    data = [(k, i, rnd.choice(["x", "y", "z", None])) for i, k in enumerate(ks)]
    df = spark.createDataFrame(data, "k int, o int, v string").repartition(5)
    got = {r.k: r.v for r in D.rollup_text(df, ["k"], {"v": (", ", True)}, ["o"]).collect()}
    want = {}
    for k, o, v in sorted(data, key=lambda t: t[1]):
        seen = want.setdefault(k, [])
        if v is not None and v not in seen:
            seen.append(v)
    assert got == {k: ", ".join(v) for k, v in want.items()}


def test_distribute_evenly_hot_key(spark, rnd):
    ks = _keys(rnd, N, 3, 40)
    fact = spark.createDataFrame([(k, float(i)) for i, k in enumerate(ks)], "k int, s double").repartition(6)
    metrics = spark.createDataFrame([(k, float(k * 10 + 1)) for k in range(0, 45)], "k int, m double")
    out = E.distribute_evenly(fact, metrics, ["k"], ["m"]).collect()
    counts = {k: ks.count(k) for k in set(ks)}
    assert len(out) == N + len([k for k in range(45) if k not in counts])
    for r in out:
        if r.s is None:
            assert r.m == r.k * 10 + 1 and r.k not in counts
        else:
            assert r.m == pytest.approx((r.k * 10 + 1) / counts[r.k])
    total = sum(r.m for r in out)
    assert total == pytest.approx(sum(k * 10 + 1 for k in range(45)))


def _in(v, s):
    if v is None:
        return None if s else False
    return v in s


def test_two_set_delete_hot_key(spark, rnd):
    stored = [(rnd.choice([None] + list(range(6))), 0 if rnd.random() < 1 / 3 else rnd.randrange(30))
              for _ in range(N)]
    batch = [(rnd.randrange(3), rnd.randrange(10)) for _ in range(40)]
    days, items = {d for d, _ in batch}, {i for _, i in batch}
    keep = []
    for d, i in stored:
        a, b = _in(d, days), _in(i, items)
        both = False if (a is False or b is False) else (None if (a is None or b is None) else True)
        if both is False:           # NOT(...) true only when the conjunction is false
            keep.append((d, i))
    s = spark.createDataFrame(stored, "day int, item int").repartition(4)
    b = spark.createDataFrame(batch, "day int, item int")
    got = [tuple(r) for r in U.delete_matching(s, b, ["day", "item"]).collect()]
    assert sorted(got, key=str) == sorted(keep, key=str)


def _brute_diff(low, high):
    """The four labels by nested loops over rows, each labelled high row
    emitted once per label (distinct multiplicity)."""
    def norm(rows):
        return [(o, (dc or "nan")[:4], n, d, q) for o, dc, n, d, q in rows if o]
    low, high = norm(low), norm(high)
    ids_h = {r[0] for r in high}
    out = set()
    for i, r in enumerate(low):
        if r[0] not in ids_h:
            out.add(("low", i, DF.MISSING_ID))
    keys_l = {(r[0], r[1]) for r in low}
    for j, h in enumerate(high):
        key = (h[0], h[1])
        if key not in keys_l:
            out.add(("high", j, DF.NEW_COMBO))
        elif any((l[0], l[1]) == key and ((l[2] == "ON" and h2[2] == "OFF") or (l[3] == "ON" and h2[3] == "OFF"))
                 for l in low for h2 in high if (h2[0], h2[1]) == key):
            out.add(("high", j, DF.REPLEN_CHANGE))
    for j, h in enumerate(high):
        lo = [r for r in low if r[0] == h[0]]
        hi = [r for r in high if r[0] == h[0]]
        if lo and all(r[2] == "OFF" and r[3] == "OFF" for r in lo + hi) and \
                sum(r[4] or 0 for r in lo) > 0 and sum(r[4] or 0 for r in hi) == 0:
            out.add(("high", j, DF.ZERO_INVENTORY))
    return out


def test_snapshot_diff_against_loops(spark, rnd):
    def snap(n, zero):
        rows = []
        for _ in range(n):
            o = 1 if rnd.random() < 1 / 3 else rnd.randrange(2, 25)
            q = 0.0 if zero and o % 5 == 0 else rnd.choice([None, 0.0, 3.0])
            rows.append((o, rnd.choice(["DC1x", "DC2", None]), rnd.choice(["ON", "OFF", None]),
                         "OFF" if o % 5 == 0 else rnd.choice(["ON", "OFF"]), q))
        return rows
    low, high = snap(300, False), snap(300, True)
    for i, r in enumerate(low):          # make every 5th id all-off in the old week
        if r[0] % 5 == 0:
            low[i] = (r[0], r[1], "OFF", "OFF", 2.0)
    for j, r in enumerate(high):
        if r[0] % 5 == 0:
            high[j] = (r[0], r[1], "OFF", "OFF", 0.0)
    schema = "omsid long, dc string, ntwk_replen string, dc_replen string, oh_qty double, row_id int"
    lo = spark.createDataFrame([(*r, i) for i, r in enumerate(low)], schema)
    hi = spark.createDataFrame([(*r, j) for j, r in enumerate(high)], schema)
    out = DF.snapshot_diff(lo, hi, inventory=("oh_qty",))
    got = set()
    for r in out.collect():
        side = "low" if r.change_type == DF.MISSING_ID else "high"
        got.add((side, r.row_id, r.change_type))
    assert got == _brute_diff(low, high)
    assert out.count() == len(got)
    # counts and ids from the key table equal those of the emitted rows
    by_key = DF.count_changes(lo, hi, inventory=("oh_qty",)).collect()
    assert by_key == DF.change_counts(out).collect()
    assert {r["count"] for r in by_key} != {0}
    zero = DF.zero_inventory(lo, hi, inventory=("oh_qty",)).collect()
    assert zero and zero == DF.zero_inventory_ids(out).collect()
