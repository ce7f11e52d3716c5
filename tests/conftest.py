from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from niaga.schemas import ARRIVAL, SOURCES  # noqa: E402
from niaga.session import local_session  # noqa: E402
from niaga.sources import SourceFrame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, app="niaga-tests")
    yield session
    session.stop()


def at(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


# A small hand-made company. Arrival order is the order of the rows.
CRM = [
    ("U2", "Budi", "b@x.id", "Medan", "Gold", at("2026-06-30 23:59:59")),
    ("U1", "Ani", "a@x.id", "Jakarta", "Silver", at("2026-01-01 00:00:00")),
    ("U2", "Budi again", "bb@x.id", "Bandung", "Standard", at("2025-01-01 00:00:00")),
    ("U3", "Citra", "c@x.id", "Medan", "Gold", at("2026-05-01 12:00:00")),
]
MDM = [
    ("P1", "Tas", "Apparel", 60, 100, True),
    ("P2", "Lampu", "Home", 120, 100, False),  # sold below cost
    ("P1", "Tas lain", "Home", 1, 2, False),
    ("P3", "Sepatu", "Apparel", 0, 800, True),
]
OMS = [
    ("O1", "U1", "P1", 2, at("2026-06-01 10:00:00"), "OVO", "Delivered"),
    ("O2", "U1", "P2", 1, at("2026-06-01 11:00:00"), "BARTER", "Cancelled"),
    ("O1", "U2", "P2", 9, at("2026-06-02 10:00:00"), "OVO", "Pending"),  # same id, later row
    ("O3", "U9", "P1", 1, at("2026-06-03 10:00:00"), "OVO", "Delivered"),  # unknown user
    ("O4", "U2", "P9", 1, at("2026-06-03 10:00:00"), "OVO", "Delivered"),  # unknown product
    ("O5", None, "P1", 1, at("2026-06-03 10:00:00"), "OVO", "Delivered"),  # no user
    ("O6", "U2", "P1", 3, at("2026-06-04 10:00:00"), "VA_BCA", "Returned"),
    ("O7", "U2", "P3", 1, at("2026-06-04 09:00:00"), "GOPAY", "Delivered"),
]
WEB = [
    ("L1", "S1", "U1", at("2026-06-01 09:00:00.750"), "/home", "10.0.0.1", "Mobile-Android", 100),
    ("L2", "S1", "U1", at("2026-06-01 09:01:00"), "/promo", "10.0.0.1", "Mobile-Android", 101),
    ("L3", "S1", "U1", at("2026-06-01 09:02:00"), "/about", "10.0.0.1", "Mobile-Android", 101),
    ("L4", "S2", None, at("2026-06-02 09:00:00"), "/home", "10.0.0.2", "Kiosk", 50),
    ("L5", "S3", "U9", at("2026-06-02 09:00:00"), "/checkout", "10.0.0.3", "Tablet-Fire-OS", 60),
    ("L6", "S4", "U3", at("2026-06-03 09:00:00"), "/home", "10.0.0.4", "Kiosk", 70),
    ("L1", "S9", "U2", at("2026-06-09 09:00:00"), "/home", "10.0.0.9", "Kiosk", 999),
]
WMS = [
    ("M1", "P1", "WH-JAKARTA-01", "INBOUND", 50, at("2026-06-01 08:00:00"), "OP-1"),
    ("M2", "P1", "WH-JAKARTA-02", "OUTBOUND", 20, at("2026-06-02 08:00:00"), "OP-1"),
    ("M3", "P1", "WH", "ADJUSTMENT_DEFECT", 5, at("2026-06-02 08:00:00"), "OP-2"),
    ("M4", "P2", "WH-X", "ADJUSTMENT_DEFECT", 5, at("2026-06-02 09:00:00"), "OP-2"),
    ("M5", "P9", "WH-JAKARTA-01", "INBOUND", 7, at("2026-06-02 09:00:00"), "OP-2"),  # unknown product
    ("M6", "P2", "WH-JAKARTA-01", "AUDIT", 7, at("2026-06-02 09:00:00"), "OP-2"),  # no direction
    ("M1", "P2", "WH-X", "INBOUND", 1, at("2026-06-01 07:00:00"), "OP-1"),
]


def source_frames(spark, **replaced) -> dict[str, SourceFrame]:
    """The hand-made sources; a keyword replaces the rows of one of them."""
    rows = {
        "crm_user_profiles": CRM,
        "mdm_products": MDM,
        "oms_orders": OMS,
        "web_clickstream_logs": WEB,
        "wms_inventory_movements": WMS,
    } | replaced
    frames = {}
    for name, data in rows.items():
        schema = SOURCES[name].schema.simpleString()[len("struct<") : -1]
        numbered = [(*row, i) for i, row in enumerate(data)]
        df = spark.createDataFrame(numbered, f"{schema}, {ARRIVAL}: bigint")
        frames[name] = SourceFrame(df)
    return frames
