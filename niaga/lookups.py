"""Business lookups. They must stay as they are for right results."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Payment code -> (name, category).
PAYMENT_METHODS = {
    "OVO": ("OVO", "E-Wallet"),
    "GOPAY": ("GoPay", "E-Wallet"),
    "DANA": ("DANA", "E-Wallet"),
    "CREDIT_CARD": ("Kartu Kredit", "Kartu Kredit"),
    "VA_BCA": ("Virtual Account - BCA", "Virtual Account"),
    "VA_MANDIRI": ("Virtual Account - Mandiri", "Virtual Account"),
}
OTHER_PAYMENT_CATEGORY = "Lainnya"

# Page -> (funnel stage, position in the funnel).
FUNNEL_PAGES = {
    "/home": ("1. Landing", 1),
    "/search": ("2. Discovery", 2),
    "/product/view": ("3. Consideration", 3),
    "/cart/add": ("4. Intent", 4),
    "/checkout": ("5. Conversion", 5),
    "/payment/success": ("6. Purchase", 6),
}
UNKNOWN_PAGE = ("0. Unknown", 0)

# Movement type -> effect on stock, in report order.
MOVEMENT_DIRECTION = {
    "INBOUND": 1,
    "RETUR_STOCK": 1,
    "OUTBOUND": -1,
    "ADJUSTMENT_DEFECT": -1,
}
DEFECT = "ADJUSTMENT_DEFECT"

# Monday..Sunday and January..December.
DAY_NAMES = ("Senin", "Selasa", "Rabu", "Kamis", "Jumat", "Sabtu", "Minggu")
MONTH_NAMES = (
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
)

# Cell texts a CSV source may use for "no value".
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def map_value(column: Column, mapping: dict, default: Column | None = None) -> Column:
    """Literal-map lookup of ``column``; ``default`` (or null) where it has no entry."""
    literal = F.create_map(*(F.lit(x) for x in chain.from_iterable(mapping.items())))
    # try_element_at gives null, not an error, for a missing key
    found = F.try_element_at(literal, column)
    return found if default is None else F.coalesce(found, default)
