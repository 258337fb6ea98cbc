"""Money held as text."""

from __future__ import annotations

from pyspark.sql import Column

MONEY = "decimal(16,2)"


def money(text: Column) -> Column:
    return text.try_cast(MONEY)


def line_amount(quantity: Column, price: Column) -> Column:
    """Exact product of two money texts, again as text (scale four)."""
    return (money(quantity) * money(price)).cast("string")
