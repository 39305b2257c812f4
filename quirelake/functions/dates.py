"""Weekday codes and the date encodings of the landed documents."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.conventions import (
    OTHER_RELEASE_DAY,
    SHORT_DATE_PATTERN,
    WEEKDAY_KEYS,
    WEEKDAY_SPELLINGS,
)


# one literal map, folded once per query
_RELEASE_DAYS = "map({})".format(
    ", ".join(
        f"'{name}', {code}"
        for code, names in WEEKDAY_SPELLINGS.items()
        for name in names
    )
)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def release_day(weekday) -> Column:
    """Weekday in any known spelling -> 0 (Monday) .. 6, otherwise 7."""
    codes = F.try_element_at(F.expr(_RELEASE_DAYS), _col(weekday))
    return F.coalesce(codes, F.lit(OTHER_RELEASE_DAY))


def weekday_key(date) -> Column:
    """The list key of a date's weekday, e.g. MONDAY."""
    names = F.array(*[F.lit(name) for name in WEEKDAY_KEYS])
    return F.get(names, F.weekday(_col(date)))


def iso_date(text) -> Column:
    """Calendar day of an ISO timestamp in the session zone; bad text -> NULL."""
    return F.to_date(F.try_to_timestamp(_col(text)))


def short_date(text) -> Column:
    """``yy.MM.dd``; the two-digit year lies in 2000..2099; bad text -> NULL."""
    return F.try_to_date(_col(text), SHORT_DATE_PATTERN)


def epoch_ms_date(millis) -> Column:
    """Calendar day of epoch milliseconds in the session zone."""
    return F.to_date(F.timestamp_millis(_col(millis)))


def landing_date(path) -> Column:
    """The last ``YYYY/MM/DD`` in a path; NULL when there is none."""
    day = F.regexp_extract(_col(path), r"^.*/(\d{4}/\d{2}/\d{2})/", 1)
    return F.try_to_date(day, "yyyy/MM/dd")




def first_date(path) -> Column:
    """The ``YYYY/MM/DD`` that a path begins with; NULL when that is no date."""
    return F.replace(F.left(_col(path), F.lit(10)), F.lit("/"), F.lit("-")).try_cast("date")
