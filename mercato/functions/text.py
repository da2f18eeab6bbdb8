"""Column -> Column helpers for cleaning text and typing raw values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.column import Column as _Col


def _c(c) -> Column:
    return c if isinstance(c, _Col) else F.col(c)


def clean_text(c) -> Column:
    """``NULLIF(TRIM(c), '')``: blank -> NULL. Trims spaces only; tabs stay."""
    return F.nullif(F.trim(_c(c)), F.lit(""))


def to_int(c) -> Column:
    """Text -> INT; unparsable text becomes NULL instead of failing the job (ANSI)."""
    return clean_text(c).try_cast("int")


def to_decimal(c, precision: int = 15, scale: int = 2) -> Column:
    return clean_text(c).try_cast(f"decimal({precision},{scale})")


def to_timestamp(c) -> Column:
    """Text -> zone-less timestamp; impossible dates (e.g. 30 February) become NULL."""
    return clean_text(c).try_cast("timestamp_ntz")


def blank_to_null(c) -> Column:
    """What a CSV reader that maps empty fields to missing does: '' -> NULL, no trim."""
    c = _c(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def normalise_payment_type(c, to: str = "unknown") -> Column:
    """Case-insensitive ``not_defined`` -> ``to`` (``unknown`` in staging, ``other`` in the PG facts)."""
    v = clean_text(c)
    return F.when(F.lower(v) == F.lit("not_defined"), F.lit(to)).otherwise(v)


# The three stock buckets.
OUT_OF_STOCK = "Out of Stock"
LOW_STOCK = "Low Stock"
IN_STOCK = "In Stock"


def stock_status(qty, reorder, null_qty_in_stock: bool = False) -> Column:
    """Three-way bucket: 0 -> Out of Stock, below reorder level -> Low Stock, else In Stock.

    SQL ``CASE`` sends a NULL quantity to the ELSE branch (``In Stock``); the
    micro-batch path keeps NULL so unmatched inventory stays visible. Pick with
    ``null_qty_in_stock``.
    """
    qty, reorder = _c(qty), _c(reorder)
    expr = F.when(qty == 0, F.lit(OUT_OF_STOCK)).when(qty < reorder, F.lit(LOW_STOCK))
    if null_qty_in_stock:
        return expr.otherwise(F.lit(IN_STOCK))
    return expr.when(qty.isNotNull(), F.lit(IN_STOCK))


def fill_text(c) -> Column:
    """NULL text -> ''."""
    return F.coalesce(_c(c), F.lit(""))


def batch_label(batch_id, width: int = 4) -> Column:
    """Zero-padded batch number used in landed file names (``7`` -> ``0007``); longer numbers stay whole."""
    text = _c(batch_id).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))


def batch_id_from_path(path_col=None, prefix: str = "_batch_") -> Column:
    """Batch number parsed from a file name such as ``orders_batch_0007.csv`` (NULL if absent).

    Defaults to the name of the file each row was read from.
    """
    src = F.input_file_name() if path_col is None else _c(path_col)
    return F.nullif(F.regexp_extract(src, prefix + r"(\d+)", 1), F.lit("")).cast("int")
