"""Money formatting and line amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RUPIAH_PREFIX, RUPIAH_THOUSANDS


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def rupiah(col: Column | str) -> Column:
    """Integer rupiah as text with dot thousands separators: ``Rp.1.234.567``."""
    return F.concat(F.lit(RUPIAH_PREFIX), F.regexp_replace(F.format_number(_c(col), 0), ",", RUPIAH_THOUSANDS))


def line_amount(price: Column | str, quantity: Column | str) -> Column:
    """``price * quantity`` in integer rupiah."""
    return (_c(price).cast("long") * _c(quantity).cast("long"))
