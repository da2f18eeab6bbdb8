"""Deterministic pseudo-stock.

The warehouse simulates stock per product from a hash of the id. CRC32 is the
product default (same function as the MySQL warehouse). ``md5_prefix`` takes
the first 32 bits of the MD5 hex digest; DuckDB can compute it as well, so the
SQL oracle uses that variant.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c

# Stock draw lists of the micro-batch inventory snapshot
# (zero appears 3 times in 11 so ~27% of pairs are out of stock).
STOCK_CHOICES = (0, 0, 0, 5, 10, 15, 20, 30, 50, 75, 100)
REORDER_CHOICES = (5, 10, 15, 20, 25, 30)
# Modulus and offset of the warehouse stock simulation.
STOCK_MOD = 500
REORDER_MOD = 80
REORDER_BASE = 20


def crc32_hash(c) -> Column:
    return F.crc32(_c(c).cast("string"))


def md5_prefix(c) -> Column:
    """First 8 hex digits of md5 as a non-negative BIGINT."""
    return F.conv(F.substring(F.md5(_c(c).cast("string")), 1, 8), 16, 10).cast("bigint")


HASHES = {"crc32": crc32_hash, "md5": md5_prefix}


def pseudo_stock(key, hash_fn: str = "crc32") -> tuple[Column, Column]:
    """(stock_qty, reorder_level) = (h mod 500, h mod 80 + 20) as INT."""
    h = HASHES[hash_fn](key)
    return (h % STOCK_MOD).cast("int"), (h % REORDER_MOD + REORDER_BASE).cast("int")


def pair_key(*cols) -> Column:
    return F.concat_ws("|", *[_c(c).cast("string") for c in cols])


def choose(h: Column, choices) -> Column:
    """Deterministic pick from a fixed list: ``choices[h mod n]``."""
    arr = F.array(*[F.lit(v) for v in choices])
    return F.element_at(arr, (h % len(choices) + 1).cast("int")).cast("int")


def snapshot_stock(*key_cols) -> tuple[Column, Column]:
    """(stock_qty, reorder_level) for a (product, seller) pair, drawn from the fixed lists."""
    h = md5_prefix(pair_key(*key_cols))
    return choose(h, STOCK_CHOICES), choose(F.floor(h / len(STOCK_CHOICES)).cast("bigint"), REORDER_CHOICES)
