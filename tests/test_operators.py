from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from niaga.operators import (
    bucket_count,
    dense_key,
    dense_key_by_day,
    frequent_keys,
    keep_first,
    lookup,
    range_count,
    staged_bounds,
    top,
    write_buckets,
)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_keep_first_takes_the_earliest_row(spark):
    rows = [("a", 3, "late"), ("b", 1, "only"), ("a", 1, "first"), ("a", 2, "mid"), (None, 9, "x"), (None, 8, "y")]
    df = spark.createDataFrame(rows, "k string, _arrival int, v string")
    got = {(r.k, r.v) for r in keep_first(df, "k").collect()}
    assert got == {("a", "first"), ("b", "only"), (None, "y")}


def test_keep_first_dealt_to_tasks_sorts_after_the_shuffle_only(spark, tmp_path):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 != 1, (F.col("id") % 5000).cast("string")).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1000003)).alias("_arrival"),
        F.col("id").alias("v"),
    )
    rows.write.parquet(str(tmp_path / "t"))
    rows = spark.read.parquet(str(tmp_path / "t"))
    often = frequent_keys(rows, "k", 30000)
    assert often == ["hot"]
    first = keep_first(rows, "k", tasks=7, frequent=often)
    want = {(r.k, r.v) for r in keep_first(rows, "k").collect()}
    assert {(r.k, r.v) for r in first.collect()} == want and first.count() == len(want)
    # a row of a key that is not frequent meets no sort before its shuffle, and seven tasks after it
    cold = plan_of(first).split("Exchange hashpartitioning(k#")[-1]
    assert "REPARTITION_BY_NUM" in cold and "Sort" not in cold and "WindowGroupLimit" not in cold
    assert "hashpartitioning(k#" in plan_of(first) and ", 7)" in cold


def test_frequent_keys_of_a_small_table_are_not_sought(spark):
    assert frequent_keys(spark.range(200).select(F.lit("a").alias("k")), "k", 200) == []


def test_keep_first_limits_each_key_before_the_shuffle(spark, tmp_path):
    rows = spark.range(2000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("_arrival"),
    )
    rows.write.parquet(str(tmp_path / "t"))
    first = keep_first(spark.read.parquet(str(tmp_path / "t")), "k")
    plan = plan_of(first)
    above, below = plan.split("Exchange hashpartitioning", 1)
    assert "WindowGroupLimit" in above and "Final" in above
    assert "WindowGroupLimit" in below and "Partial" in below
    assert first.where("k = 'hot'").count() == 1
    assert first.count() == 2000 - 667 + 1


def test_dense_key_over_many_ranges(spark, tmp_path):
    names = [f"K-{i}" for i in range(6000)]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_key(df, "key", ["name"], str(tmp_path / "ordered"))
        files = {f for f in numbered.inputFiles()}
        got = {r.name: r.key for r in numbered.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 4  # the order was spread over several tasks
    assert got == {n: i for i, n in enumerate(sorted(names), start=1)}


def test_dense_key_of_nothing_and_of_descending_groups(spark, tmp_path):
    empty = spark.createDataFrame([], "a int")
    assert dense_key(empty, "key", ["a"], str(tmp_path / "e")).count() == 0
    df = spark.createDataFrame([(True, 1), (False, 2), (False, 1)], "aside boolean, n int")
    got = dense_key(df, "key", ["aside", "n"], str(tmp_path / "o")).collect()
    assert {(r.aside, r.n): r.key for r in got} == {(False, 1): 1, (False, 2): 2, (True, 1): 3}


@pytest.mark.parametrize("ranges", [1, 8, 200])
def test_dense_key_by_day(spark, tmp_path, ranges):
    rows = [(i % 7 == 0, 20240101 + (i * i) % 9, f"K-{(i * 7919) % 100_003}") for i in range(3000)]
    df = spark.createDataFrame(rows, "aside boolean, day int, id string").repartition(5)
    bounds = staged_bounds(df.select("day", "id"), len(rows), ranges)
    assert len(bounds) == ranges - 1
    calendar = list(range(20240101, 20240131))
    placed = dense_key_by_day(df, "key", ("aside", "day", "id"), bounds, calendar, str(tmp_path / "ordered"))
    got = {(r.aside, r.day, r.id): r.key for r in placed.collect()}
    expected = sorted(r for r in rows if not r[0])
    assert {k: v for k, v in got.items() if not k[0]} == {r: i for i, r in enumerate(expected, start=1)}
    assert len(got) == len(rows) and {v for k, v in got.items() if k[0]} == {None}


def test_rows_are_evaluated_once(spark, tmp_path):
    """Nothing samples the rows that get a key: each passes the plan above the source one time."""
    seen = spark.sparkContext.accumulator(0)
    df = spark.createDataFrame([(False, 1, f"K{i}") for i in range(500)], "aside boolean, day int, id string")
    watched = df.rdd.map(lambda r: (seen.add(1), r)[1]).toDF(df.schema)
    placed = dense_key_by_day(watched, "key", ("aside", "day", "id"), [(1, "K3"), (1, "K5")], [1], str(tmp_path / "o"))
    assert placed.agg(F.max("key")).first()[0] == 500 and seen.value == 500


def test_number_of_ranges():
    assert [range_count(n, 8) for n in (0, 1, 25_001, 10**6, 10**9)] == [1, 1, 2, 8, 500]


def test_lookup_without_key_matches_nothing(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None), (3, "zz"), (4, "none-7")], "id int, k string")
    # a dimension holding every stand-in value must still not match a missing key
    dim = spark.createDataFrame([("a", -1)] + [(f"none-{i}", i) for i in range(4096)], "k string, dk int")
    expected = {1: -1, 2: None, 3: None, 4: 7}
    assert {r.id: r.dk for r in lookup(rows, dim, "k", "k", "id").collect()} == expected
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shuffled = lookup(rows, dim, "k", "k", "id")
        assert "SortMergeJoin" in plan_of(shuffled)
        assert {r.id: r.dk for r in shuffled.collect()} == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_spreads_missing_keys(spark):
    rows = spark.range(20000).select("id", F.lit(None).cast("string").alias("k"))
    dim = spark.createDataFrame([("a", 1)], "k string, dk int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = lookup(rows, dim, "k", "k", "id").withColumn("p", F.spark_partition_id())
        sizes = [r["count"] for r in joined.groupBy("p").count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 20000 and max(sizes) < 2 * 20000 / len(sizes)


def test_top_is_planned_as_top_k(spark):
    df = spark.range(1000).select("id", (F.col("id") % 7).alias("v"))
    best = top(df, 5, F.desc("v"), F.asc("id"))
    assert [r.id for r in best.collect()] == [6, 13, 20, 27, 34]
    assert "TakeOrderedAndProject" in plan_of(best)


def test_lookup_splits_a_hot_key(spark, tmp_path):
    """A key holding a third of the rows is split over tasks when the dimension is shuffled."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    }
    rows = spark.range(0, 300000, 1, 16).select(
        F.concat(F.lit("r"), F.col("id")).alias("id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5000)).alias("k"),
    )
    dim = spark.range(5000).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
        F.col("id").alias("dk"),
    )
    rows.write.parquet(str(tmp_path / "rows"))
    dim.write.parquet(str(tmp_path / "dim"))
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        joined = lookup(
            spark.read.parquet(str(tmp_path / "rows")), spark.read.parquet(str(tmp_path / "dim")), "k", "k", "id"
        )
        rows_by_task = joined.withColumn("p", F.spark_partition_id()).collect()
    finally:
        for name in settings:
            spark.conf.unset(name)
    hot = [r.p for r in rows_by_task if r.dk == 0]
    assert len(rows_by_task) == 300000 and len(hot) == 100000
    assert all(r.dk == (0 if r.k == "hot" else int(r.k[1:])) for r in rows_by_task if r.k != "k0")
    assert len(set(hot)) > 3


def test_bounds_come_from_a_sample_of_one_size():
    """What the driver collects does not grow with the table."""
    from niaga.operators.keys import MOST_RANGES, SAMPLE_ROWS, range_count, sample_share

    for rows in (10**7, 10**9, 10**12, 10**14):
        ranges = range_count(rows, 200)
        assert ranges <= MOST_RANGES and sample_share(rows, ranges) * rows < SAMPLE_ROWS + 1
    assert sample_share(100, 8) == 1


def test_rows_stored_in_buckets_of_their_key_are_not_shuffled(spark, tmp_path):
    rows = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 != 1, (F.col("id") % 5000).cast("string")).alias("k"),
        F.pmod(F.xxhash64("id"), F.lit(1000003)).alias("_arrival"),
        F.col("id").alias("v"),
    )
    dealt = write_buckets(rows, "k", 5, str(tmp_path / "t"))
    plain = spark.read.parquet(str(tmp_path / "t"))
    first = keep_first(plain, "k", tasks=5, frequent=["hot"], dealt=dealt)
    want = {(r.k, r.v) for r in keep_first(plain, "k").collect()}
    assert {(r.k, r.v) for r in first.collect()} == want and first.count() == len(want)
    # frequent and null keys alone are shuffled, behind the limit of their map tasks
    final = plan_of(first).split("Initial Plan")[0]
    assert final.count("Exchange") == 1 and "REPARTITION" not in final and "SelectedBucketsCount" in final
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("niaga_")]


@pytest.mark.parametrize("ranges", [2, 8, 200])
def test_dense_key_by_day_in_buckets(spark, tmp_path, ranges):
    rows = [(i % 7 == 0, 20240101 + (i * i) % 9 if i % 50 else None, f"K-{(i * 7919) % 100_003}") for i in range(3000)]
    df = spark.createDataFrame(rows, "aside boolean, day int, id string").repartition(5)
    bounds = staged_bounds(df.select("day", "id"), len(rows), ranges)
    asked = (df, "key", ("aside", "day", "id"), bounds, list(range(20240101, 20240131)))
    placed = dense_key_by_day(*asked, str(tmp_path / "buckets"), buckets=True)
    assert placed.columns == ["aside", "day", "id", "key"]
    assert sorted(map(str, placed.collect())) == sorted(map(str, dense_key_by_day(*asked, str(tmp_path / "shuffled")).collect()))
    assert "SelectedBucketsCount" in plan_of(placed) and "REPARTITION" not in plan_of(placed)
    parts = {r.p for r in placed.withColumn("p", F.spark_partition_id()).collect() if r.key}
    assert len(parts) == len(bounds) + 1  # a task for each range


def test_number_of_buckets():
    assert [bucket_count(n, 8) for n in (0, 900_000, 3 * 10**6, 10**8, 10**10, 10**13)] == [0, 0, 3, 8, 250, 1024]
