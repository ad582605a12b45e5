"""Column expressions used by the clean layer. All are Catalyst built-ins.

Text parsing is lenient by default: malformed numbers or timestamps become NULL and
the data-quality rules decide what happens to the row. ``strict=True`` uses the
throwing forms (Spark's ANSI casts) instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.config import TIMESTAMP_FORMAT


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def typed(c: str | Column, dtype: str, strict: bool = False) -> Column:
    """Cast text to ``dtype``; NULL on bad text unless ``strict``."""
    c = _c(c)
    return c.cast(dtype) if strict else c.try_cast(dtype)


def parse_ts(c: str | Column, fmt: str = TIMESTAMP_FORMAT, strict: bool = False) -> Column:
    """Parse text with a fixed pattern; NULL on bad text unless ``strict``."""
    c = _c(c)
    return F.to_timestamp(c, fmt) if strict else F.try_to_timestamp(c, F.lit(fmt))


def day_span(end: str | Column, start: str | Column) -> Column:
    """Signed whole calendar days from ``start`` to ``end``; NULL if either is NULL."""
    return F.datediff(_c(end), _c(start))


def later_than(a: str | Column, b: str | Column) -> Column:
    """``a > b`` as timestamps; NULL if either is NULL."""
    return _c(a) > _c(b)


def late_by_day(delay_days: str | Column) -> Column:
    """Day-based late flag: never NULL, true only for a positive day delay."""
    return F.coalesce(_c(delay_days) > 0, F.lit(False))


def upper_trim(c: str | Column) -> Column:
    return F.trim(F.upper(_c(c)))


def lower_trim(c: str | Column) -> Column:
    return F.trim(F.lower(_c(c)))


def joined_location(city: str | Column, state: str | Column, sep: str = ", ") -> Column:
    """``city, state`` skipping NULL parts (both NULL gives the empty string)."""
    return F.concat_ws(sep, _c(city), _c(state))


def joined_location_strict(city: str | Column, state: str | Column, sep: str = ", ") -> Column:
    """Documented variant: NULL as soon as one part is NULL."""
    return F.concat(_c(city), F.lit(sep), _c(state))


def money_sum(a: str | Column, b: str | Column, scale: int = 2) -> Column:
    return F.round(_c(a) + _c(b), scale)


def product(*cols: str | Column) -> Column:
    out = _c(cols[0])
    for c in cols[1:]:
        out = out * _c(c)
    return out
