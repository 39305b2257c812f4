"""Column functions: weekday codes, dates, keys, text and arrays."""

from quirelake.functions.arrays import explode_or, first_item, items_where
from quirelake.functions.dates import (
    epoch_ms_date,
    first_date,
    iso_date,
    landing_date,
    release_day,
    short_date,
    weekday_key,
)
from quirelake.functions.keys import key_part, path_stem, path_title
from quirelake.functions.text import drop_prefix, fill_template, join_names, jsonp_body

__all__ = [
    "drop_prefix",
    "epoch_ms_date",
    "explode_or",
    "fill_template",
    "first_date",
    "first_item",
    "iso_date",
    "items_where",
    "join_names",
    "jsonp_body",
    "key_part",
    "landing_date",
    "path_stem",
    "path_title",
    "release_day",
    "short_date",
    "weekday_key",
]
