"""Internet addresses as numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

_QUAD = r"^[0-9]{1,3}([.][0-9]{1,3}){3}$"
_PARTS = [
    "substring_index(quad, '.', 1)",
    "substring_index(substring_index(quad, '.', 2), '.', -1)",
    "substring_index(substring_index(quad, '.', -2), '.', 1)",
    "substring_index(quad, '.', -1)",
]


def with_ip_number(df: DataFrame, text: str, number: str) -> DataFrame:
    """The dotted text column replaced by a number in [0, 2**32); NULL for anything else.

    Checking and cutting are steps of their own, so that each happens once per row.
    """
    others = [name for name in df.columns if name != text]
    parts = [f"cast({part} as int) as part{n}" for n, part in enumerate(_PARTS)]
    cut = df.selectExpr(*others, f"if({text} rlike '{_QUAD}', {text}, null) as quad").selectExpr(
        *others, *parts
    )
    valid = "greatest(part0, part1, part2, part3) <= 255"
    value = "part0 * 16777216L + (part1 * 65536 + part2 * 256 + part3)"
    return cut.selectExpr(*others, f"if({valid}, {value}, null) as {number}")


def ip_text(number: str) -> Column:
    """A number expression as dotted text."""
    parts = ", ".join(f"cast(shiftright({number}, {n}) & 255 as string)" for n in (24, 16, 8, 0))
    return F.expr(f"concat_ws('.', {parts})")
