"""Prefixed identifiers: ``U12`` / ``P7`` / ``O42``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col):
    return F.col(col) if isinstance(col, str) else col


def strip_prefix_id(col: Column | str, prefix: str, lenient: bool = False) -> Column:
    """Drop one leading ``prefix`` and cast the rest to ``long``.

    Strict (default) follows the warehouse cast: under ANSI mode a value that
    is not a number fails the query.  ``lenient=True`` returns NULL instead so
    the caller can quarantine the row.
    """
    digits = F.regexp_replace(_c(col), "^" + prefix, "")
    return digits.try_cast("long") if lenient else digits.cast("long")


def user_number(col: Column | str) -> Column:
    """Numeric part of a user id for the bot ordering rule: every leading
    ``U``/``u`` is stripped, text that is no number becomes NULL."""
    return F.regexp_replace(_c(col), "^[Uu]+", "").try_cast("long")


def with_prefix(col: Column | str, prefix: str) -> Column:
    return F.concat(F.lit(prefix), _c(col).cast("string"))
