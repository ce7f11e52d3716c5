from __future__ import annotations

import datetime as dt
import random

import pytest
from conftest import MDM, at, source_frames

from niaga.operators.history import BEGINNING, as_of, first_versions, merge_versions
from niaga.plans.incremental import open_history, run_incremental

SCHEMA = "id string, price long, tier string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def listed(history):
    return sorted((tuple(r) for r in history.select("id", "price", "tier", "valid_from", "valid_to").collect()), key=repr)


def test_versions(spark):
    a, b, c = (at(f"2026-0{m}-01 00:00:00") for m in (2, 3, 4))
    merge = lambda h, rows, when: merge_versions(h, frame(spark, rows), "id", ["price", "tier"], when)
    first = first_versions(frame(spark, [("x", 1, "s"), ("y", 2, None), ("z", 3, "s")]), "id", ["price", "tier"])
    two = merge(first, [("x", 1, "s"), ("y", 2, "t"), ("n", 9, "s"), (None, 1, "s")], a)  # y changed, z gone, n new
    expected = [("n", 9, "s", a, None), ("x", 1, "s", BEGINNING, None), ("y", 2, None, BEGINNING, a), ("y", 2, "t", a, None), ("z", 3, "s", BEGINNING, a)]
    assert listed(two) == sorted(expected, key=repr)
    same = [("x", 1, "s"), ("y", 2, "t"), ("n", 9, "s")]
    assert listed(merge(two, same, a)) == listed(merge(two, same, b)) == listed(two)
    three = merge(two, [("x", 1, "s"), ("y", 5, "t"), ("z", 3, "s")], c)  # y changed again, n gone, z back
    assert listed(three) == sorted(
        [("x", 1, "s", BEGINNING, None), ("y", 2, None, BEGINNING, a), ("y", 2, "t", a, c), ("y", 5, "t", c, None),
         ("z", 3, "s", BEGINNING, a), ("z", 3, "s", c, None), ("n", 9, "s", a, c)],
        key=repr,
    )
    again = merge(three, [("x", 1, "s"), ("y", 6, "t"), ("z", 3, "s")], c)  # corrected at the same time
    assert {r for r in listed(again) if r[0] == "y"} == {("y", 2, None, BEGINNING, a), ("y", 2, "t", a, c), ("y", 6, "t", c, None)}


@pytest.mark.parametrize("run_events", [1_000_000, 7])
def test_as_of_equals_a_scan_of_the_versions(spark, run_events):
    """Ties of event and version, gaps, unknown and missing keys, and a hot key cut into runs."""
    r = random.Random(1)
    day = lambda n: dt.datetime(2026, 1, 1) + dt.timedelta(days=n)
    versions = []
    for k in "abc":
        cuts = sorted(r.sample(range(60), 5))
        for f, t in zip(cuts, [*cuts[1:], None], strict=True):
            versions.append((k, r.randrange(100), f"t{f}", day(f), day(t - (f % 2)) if t and t - f > 1 else day(t) if t else None))
    events = [(i, r.choice(["a", "a", "a", "a", "b", "c", "d", None]), day(r.randrange(62)), 5) for i in range(200)]
    history = spark.createDataFrame(versions, f"{SCHEMA}, valid_from timestamp_ntz, valid_to timestamp_ntz")
    got = as_of(spark.createDataFrame(events, "n int, id string, t timestamp_ntz, _n int"), history, "id", "t", ["price", "tier"], run_events)
    plain = []
    for n, k, t, x in events:
        valid = [v for v in versions if v[0] == k and v[3] <= t and (v[4] is None or t < v[4])]
        plain.append((n, k, t, x, *(valid[-1][1:3] if valid else (None, None))))
    assert sorted((tuple(row) for row in got.collect()), key=lambda x: x[0]) == plain
    assert as_of(spark.createDataFrame(events, "n int, id string, t timestamp_ntz, _n int"), history.limit(0), "id", "t", ["price"]).count() == 200


def test_loads_keep_the_history_of_the_dimensions(spark, tmp_path):
    root = str(tmp_path / "root")
    load = lambda mdm, day: run_incremental(spark, source_frames(spark, mdm_products=mdm), root, day, publish_failed_checks=True)
    load(MDM, dt.date(2026, 7, 1))
    dearer = [(*p[:4], 150, p[5]) if p[0] == "P1" else p for p in MDM]
    load(dearer, dt.date(2026, 7, 2))
    last = load(dearer, dt.date(2026, 7, 3))
    history = open_history(spark, root, last.run_id, "dim_product")
    rows = sorted(((r.product_id, r.harga_jual_idr, r.valid_from, r.valid_to) for r in history.collect()), key=lambda r: (r[0], r[2]))
    change = dt.datetime(2026, 7, 2)
    assert rows[:2] == [("P1", 100, BEGINNING, change), ("P1", 150, change, None)] and len(rows) == len({p[0] for p in MDM}) + 1
