"""Exact ratios and one-row frame helpers."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def div_exact(a: Column, b: Column) -> Column:
    """Whole quotient of two integral columns, as BIGINT."""
    return F.call_function("div", a, b)


def _whole(value: Column | int, digits: int = 20) -> Column:
    column = value if isinstance(value, Column) else F.lit(value)
    return column.cast(f"decimal({digits},0)")


def ratio_round(num: Column, den: Column, scale: int, factor: int = 1) -> Column:
    """``factor * num / den`` rounded half away from zero to ``scale`` decimals, as DOUBLE.

    Runs on aggregated rows, in decimals: the result depends neither on
    summation order nor on binary fractions. The whole part and the remainder
    are scaled apart, so totals up to the BIGINT limit do not overflow. Null
    where ``den`` is zero or null.
    """
    n, d = _whole(F.abs(num)), F.nullif(_whole(F.abs(den)), _whole(0))
    units = factor * 10**scale
    rest = (n % d) * _whole(2 * units, 8) + d
    total = _whole(div_exact(n, d)) * _whole(units, 7) + _whole(div_exact(rest, d * _whole(2, 1)), 8)
    sign = F.when((F.signum(num) * F.signum(den)) < 0, -1).otherwise(1)
    return (total * F.lit(Decimal(1).scaleb(-scale)) * sign).cast("double")


def mean(total: Column, count: Column) -> Column:
    """Unrounded average of an integral total."""
    return total.cast("double") / F.nullif(count, F.lit(0).cast("bigint")).cast("double")


def fold_rows(*frames: DataFrame) -> DataFrame:
    """Put several one-row frames side by side.

    The rows are stacked and folded with ``max`` (which skips nulls), so no
    cross join is planned.
    """
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return stacked.agg(*(F.max(c).alias(c) for c in stacked.columns))
