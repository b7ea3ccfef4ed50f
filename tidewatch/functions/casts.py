"""Typing expressions for the bronze → silver projections."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the quote-currency suffix removed from exchange symbols.
QUOTE_SUFFIX_PATTERN = "USDT$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def to_decimal(col, precision: int = 38, scale: int = 8,
               strict: bool = True) -> Column:
    """Text or double → DECIMAL(p, s), half-up on excess scale.

    ``strict`` keeps the reference behaviour (a malformed value fails the
    job under ANSI); otherwise ``try_cast`` yields null for quarantine.
    """
    t = f"decimal({precision},{scale})"
    return _c(col).cast(t) if strict else _c(col).try_cast(t)


def trade_asset(symbol) -> Column:
    """``BTCUSDT`` → ``BTC``; only a trailing quote suffix is removed."""
    return F.regexp_replace(_c(symbol), QUOTE_SUFFIX_PATTERN, "")


def snapshot_asset(symbol) -> Column:
    """``btc`` → ``BTC``."""
    return F.upper(_c(symbol))
