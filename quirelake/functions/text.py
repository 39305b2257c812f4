"""Text functions."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.conventions import AUTHOR_SEPARATOR

_REST = 2**31 - 1


def join_names(names) -> Column:
    """Names joined by the author separator; NULL names are left out."""
    return F.concat_ws(AUTHOR_SEPARATOR, names)


def drop_prefix(text, length: int = 1) -> Column:
    """The text without its first characters, whatever they are."""
    return F.substring(text, length + 1, _REST)


def jsonp_body(text) -> Column:
    """What follows the first ``(``, less the closing two characters."""
    text = F.col(text) if isinstance(text, str) else text
    start = F.locate("(", text)
    length = F.greatest(F.length(text) - start - F.lit(2), F.lit(0))
    return F.when(start > 0, F.substr(text, start + 1, length))


def fill_template(template: str, **values) -> Column:
    """A text template with ``{name}`` places filled from columns.

    A NULL value gives NULL: a request without its key is not a request.
    """
    parts = []
    for literal, name in re.findall(r"([^{}]*)(?:\{(\w+)\})?", template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            value = values[name]
            value = F.col(value) if isinstance(value, str) else value
            parts.append(value.cast("string"))
    return F.concat(*parts)
