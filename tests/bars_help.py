"""Values and rows that several test modules build."""

from __future__ import annotations

import datetime
from decimal import Decimal


def day(text: str | None) -> datetime.date | None:
    return datetime.date.fromisoformat(text) if text else None


def price(value) -> Decimal | None:
    return None if value is None else Decimal(str(value)).quantize(Decimal("0.00000001"))


def bar(symbol, dt, close, volume=100, seq=1, open=None, high=None, low=None, source="t"):
    """A bronze row; the other prices are those of ``close`` unless given."""
    pick = lambda value: price(close if value is None else value)
    return (symbol, day(dt), pick(open), pick(high), pick(low), price(close), volume, source, seq)


def rows_of(df, *columns):
    """The rows as sorted tuples, optionally of some columns."""
    selected = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in selected.collect()),
                  key=lambda row: tuple((v is not None, str(v)) for v in row))
