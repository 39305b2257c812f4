"""Array functions that stay quiet on empty arrays while ANSI mode is on."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def first_item(items) -> Column:
    """C4: first element; NULL for an empty or NULL array."""
    return F.get(_col(items), F.lit(0))


def items_where(items, field: str, value: str) -> Column:
    """The structs of an array whose field equals a value."""
    return F.filter(_col(items), lambda item: item[field] == F.lit(value))


def explode_or(items, default) -> Column:
    """One row per item, or one default row for a NULL or empty array."""
    items = _col(items)
    empty = items.isNull() | (F.size(items) == 0)
    return F.explode(F.when(empty, F.array(default)).otherwise(items))
