"""Column -> Column expressions; all built-in Spark functions, no UDFs."""

from .dates import date_key, date_parts, day_name, is_weekend, iso_dow, month_name
from .hashing import choose, crc32_hash, md5_prefix, pair_key, pseudo_stock, snapshot_stock
from .numeric import mean, money, percentage, ratio, safe_ratio
from .text import (
    IN_STOCK, LOW_STOCK, OUT_OF_STOCK, batch_id_from_path, batch_label, blank_to_null, clean_text, fill_text,
    normalise_payment_type, stock_status, to_decimal, to_int, to_timestamp,
)

__all__ = [
    "date_key", "date_parts", "day_name", "is_weekend", "iso_dow", "month_name",
    "choose", "crc32_hash", "md5_prefix", "pair_key", "pseudo_stock", "snapshot_stock",
    "mean", "money", "percentage", "ratio", "safe_ratio",
    "IN_STOCK", "LOW_STOCK", "OUT_OF_STOCK", "batch_id_from_path", "batch_label", "blank_to_null", "clean_text", "fill_text",
    "normalise_payment_type", "stock_status", "to_decimal", "to_int", "to_timestamp",
]
