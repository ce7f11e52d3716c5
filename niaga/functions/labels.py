"""Display labels as column expressions (decimal comma, dots between thousands)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _swap_separators(text: Column) -> Column:
    return F.translate(text, ",.", ".,")


def rupiah_label(value: Column) -> Column:
    """``Rp1,25 M`` from a thousand million, ``Rp3,4 jt`` from a million, else whole rupiah."""
    v = value.cast("double")
    size = F.abs(v)
    text = (
        F.when(size >= 1e9, F.concat(_swap_separators(F.format_number(v / 1e9, 2)), F.lit(" M")))
        .when(size >= 1e6, F.concat(_swap_separators(F.format_number(v / 1e6, 1)), F.lit(" jt")))
        .otherwise(F.replace(F.format_number(v, 0), F.lit(","), F.lit(".")))
    )
    return F.when(v.isNull() | F.isnan(v), F.lit("Rp0")).otherwise(F.concat(F.lit("Rp"), text))


def number_label(value: Column, decimals: int = 0) -> Column:
    """Dots between thousands; the decimal point stays a dot too."""
    v = value.cast("double")
    text = F.replace(F.format_number(v, decimals), F.lit(","), F.lit("."))
    return F.when(v.isNull() | F.isnan(v), F.lit("0")).otherwise(text)


def title_case(text: Column) -> Column:
    """Every run of letters begins with a capital and goes on in small letters: ``BANDA_ACEH`` gives ``Banda_Aceh``."""
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(capital, "")


def percent_label(value: Column, decimals: int = 1) -> Column:
    """Decimal comma, no thousands separator."""
    v = value.cast("double")
    text = F.translate(F.format_number(v, decimals), ".,", ",")
    return F.when(v.isNull() | F.isnan(v), F.lit("0%")).otherwise(F.concat(text, F.lit("%")))
