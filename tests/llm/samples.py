"""Inputs that the tests of all operators share."""

from __future__ import annotations

SF = "/root/testdata/sf0.01"

# Columns whose names operators use themselves: they must not get in the way.
CLASHING = "row string, rest int, ids int, score double, c int, h int, key string, label int, stats int, spans string"

# Every kind of row that operators define a result for.
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "one two three four five"),
    (5, "one two three four five"),  # a repeated row
    (6, "One TWO three four five"),
    (None, "one two three four five"),
    (7, "déjà vu \U0001f600 日本語 \x1c x"),
    (8, "word " * 30000),
    (9, "a" * 300000),
]


def rows_of(df, *keys):
    return sorted((tuple(r[k] for k in keys) for r in df.collect()), key=lambda r: tuple((x is not None, x) for x in r))
