"""String cleaning used by the dimension models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading or trailing whitespace, Unicode aware ((?U) makes \s match
# tabs, newlines and Unicode spaces, like the warehouse TRIM).
_EDGE_WS = r"(?U)^\s+|\s+$"


def trim_text(col: Column | str, unicode: bool = True) -> Column:
    """Strip leading and trailing whitespace.

    ``F.trim`` only removes the space character; with ``unicode=True`` every
    kind of whitespace is removed, as the warehouse function does.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, _EDGE_WS, "") if unicode else F.trim(c)


def title_words(col: Column | str, delimiters: str | None = None) -> Column:
    """``initcap``: lower-case everything, upper-case the first letter of each
    word (``men's shoes`` -> ``Men's Shoes``).

    Words are separated by spaces (Spark's ``initcap``).  With
    ``delimiters`` every character in that string also starts a new word,
    e.g. ``delimiters=" -/("`` turns ``t-shirt`` into ``T-Shirt``.
    """
    c = F.col(col) if isinstance(col, str) else col
    if delimiters is None:
        return F.initcap(c)
    chars = F.split(F.lower(c), "")
    seps = F.array(*[F.lit(d) for d in delimiters])
    titled = F.transform(chars, lambda ch, i: F.when(
        (i == 0) | F.array_contains(seps, F.element_at(chars, F.greatest(i, F.lit(1)))), F.upper(ch)).otherwise(ch))
    return F.when(c.isNull(), F.lit(None)).otherwise(F.array_join(titled, ""))


def digits_only(col: Column | str) -> Column:
    """Remove every character that is not 0-9; the result stays a string and
    NULL stays NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return F.regexp_replace(c, r"[^0-9]", "")
