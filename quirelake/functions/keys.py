"""Keys that live in file paths or in composite text ids."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from quirelake.conventions import KEY_SEPARATOR


def path_title(path) -> Column:
    """Name of the folder that holds the file, counted from the end of the path."""
    return F.try_element_at(F.split(path, "/"), F.lit(-2))


def path_stem(path) -> Column:
    """File name up to its first dot."""
    return F.substring_index(F.substring_index(path, "/", -1), ".", 1)


def key_part(text, position: int) -> Column:
    """One part of ``title_episode`` text as a number; malformed -> NULL."""
    return F.get(F.split(text, KEY_SEPARATOR), F.lit(position)).try_cast("bigint")
