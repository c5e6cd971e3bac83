"""Small scalar helpers: dates, arrays, messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(c) -> Column:
    """V6: ``yyyy-MM-dd`` text of a date / timestamp."""
    return F.date_format(_c(c), "yyyy-MM-dd")


def n_tokens(c) -> Column:
    """V7: array size (null array -> -1, as ``size`` does)."""
    return F.size(_c(c))


def first_token(c) -> Column:
    """V7: first element, null when empty."""
    return F.try_element_at(_c(c), F.lit(1))


# Text message "(id, 'name')"; the name is single-quoted and may contain anything but a quote-paren end.
TUPLE_MESSAGE = r"^\(\s*(-?\d+)\s*,\s*'(.*)'\s*\)$"


def to_tuple_message(id_col, name_col) -> Column:
    """``(id, 'name')`` text form of a category message."""
    return F.format_string("(%s, '%s')", _c(id_col), _c(name_col))


def parse_tuple_message(c) -> tuple[Column, Column]:
    """Parse ``(id, 'name')`` without eval; unparsable -> (null, null)."""
    c = _c(c)
    ok = c.rlike(TUPLE_MESSAGE)
    id_ = F.when(ok, F.regexp_extract(c, TUPLE_MESSAGE, 1).try_cast("long"))
    name = F.when(ok, F.regexp_extract(c, TUPLE_MESSAGE, 2))
    return id_, name
