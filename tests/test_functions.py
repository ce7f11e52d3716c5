from __future__ import annotations

import datetime as dt
import random
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from niaga.functions import (
    date_key,
    date_month,
    elapsed_days,
    fold_rows,
    mean,
    number_label,
    percent_label,
    ratio_round,
    rupiah_label,
    whole_seconds,
)


def half_away(value: Fraction, scale: int) -> float:
    scaled = abs(value) * 10**scale
    whole = int(scaled + Fraction(1, 2))
    return (whole if value >= 0 else -whole) / 10**scale


@pytest.mark.parametrize("scale", [0, 1, 2])
def test_ratio_round_is_exact(spark, scale):
    rng = random.Random(scale)
    pairs = [(rng.randint(-5000, 5000), rng.randint(1, 400)) for _ in range(3000)]
    pairs += [(1, 8), (3, 8), (1005, 1000), (-1, 8), (5, 2), (-5, 2), (0, 7), (57, 200)]
    pairs += [(9 * 10**18, 7), (9 * 10**18, 10**12 + 1)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint")
    got = df.select("a", "b", ratio_round(F.col("a"), F.col("b"), scale).alias("r")).collect()
    assert [r.r for r in got] == [half_away(Fraction(r.a, r.b), scale) for r in got]


def test_ratio_round_factor_and_empty_denominator(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (1, None), (None, 3)], "a bigint, b bigint")
    got = df.select(ratio_round(F.col("a"), F.col("b"), 2, factor=100).alias("r"))
    assert [r.r for r in got.collect()] == [33.33, None, None, None]
    assert df.select(mean(F.col("a"), F.col("b")).alias("r")).collect()[1].r is None


def test_margin_rounding_matches_pandas(spark):
    rng = random.Random(5)
    rows = [(rng.randint(0, 2000), rng.randint(1, 2000)) for _ in range(20000)]
    rows += [(999, 800), (1, 800), (3, 800), (5, 800), (7, 1600)]  # half-way hundredths
    frame = pd.DataFrame(rows, columns=["margin", "price"])
    expected = (frame.margin / frame.price * 100).round(2).tolist()
    percent = F.col("margin").cast("double") / F.col("price").cast("double") * 100
    got = spark.createDataFrame(frame).select((F.rint(percent * 100) / 100).alias("r")).collect()
    assert [r.r for r in got] == expected


def test_calendar_expressions(spark):
    rows = [
        (dt.datetime(2026, 6, 30, 23, 59, 59, 999999),),
        (dt.datetime(2026, 7, 1),),
        (dt.datetime(2026, 7, 1, 0, 0, 1),),
        (dt.datetime(2024, 12, 29, 12),),
    ]
    df = spark.createDataFrame(rows, "ts timestamp_ntz")
    snapshot = dt.date(2026, 7, 1)
    got = df.select(
        date_key(F.col("ts")).alias("k"),
        date_month(date_key(F.col("ts"))).alias("m"),
        elapsed_days(F.col("ts"), snapshot).alias("d"),
        whole_seconds(F.col("ts")).alias("s"),
    ).collect()
    assert [r.k for r in got] == [20260630, 20260701, 20260701, 20241229]
    assert [r.m for r in got] == [202606, 202607, 202607, 202412]
    expected = [(dt.datetime(2026, 7, 1) - ts) // dt.timedelta(days=1) for (ts,) in rows]
    assert [r.d for r in got] == expected == [0, 0, -1, 548]
    assert [r.s for r in got] == [ts.replace(microsecond=0) for (ts,) in rows]


def test_labels(spark):
    def swap(text):
        return text.translate(str.maketrans(",.", ".,"))

    def rupiah(v):
        if v is None:
            return "Rp0"
        if abs(v) >= 1e9:
            return f"Rp{swap(f'{v / 1e9:,.2f}')} M"
        if abs(v) >= 1e6:
            return f"Rp{swap(f'{v / 1e6:,.1f}')} jt"
        return "Rp" + f"{v:,.0f}".replace(",", ".")

    values = [None, 0.0, 12.5, 13.5, 999.0, 1234.0, 999999.0, 1e6, 15246946.0, 38117363895.0, -2.5e6, 1.5e13]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = df.select(
        rupiah_label(F.col("v")).alias("r"),
        number_label(F.col("v")).alias("n"),
        number_label(F.col("v"), 2).alias("n2"),
        percent_label(F.col("v")).alias("p"),
    ).collect()
    assert [r.r for r in got] == [rupiah(v) for v in values]
    assert [r.n for r in got] == ["0" if v is None else f"{v:,.0f}".replace(",", ".") for v in values]
    assert [r.n2 for r in got] == ["0" if v is None else f"{v:,.2f}".replace(",", ".") for v in values]
    assert [r.p for r in got] == ["0%" if v is None else f"{v:.1f}%".replace(".", ",") for v in values]


def test_fold_rows_plans_no_cross_join(spark):
    a = spark.range(5).agg(F.count("*").alias("x"))
    b = spark.range(0).agg(F.sum("id").alias("y"))
    folded = fold_rows(a, b)
    assert folded.collect() == [(5, None)]
    plan = folded._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
