"""Sources and sinks of the lake."""

from quirelake.sources.landing import (
    inventory,
    inventory_changes,
    of_titles,
    read_files,
    read_landing,
    read_packed,
)
from quirelake.sources.tables import (
    backup,
    preview,
    read_curated,
    read_history,
    read_optimized,
    read_quarantine,
    register_views,
    write_curated,
    write_history,
    write_optimized,
    write_quarantine,
)

__all__ = [
    "backup",
    "inventory",
    "inventory_changes",
    "of_titles",
    "preview",
    "read_curated",
    "read_files",
    "read_history",
    "read_landing",
    "read_optimized",
    "read_packed",
    "read_quarantine",
    "register_views",
    "write_curated",
    "write_history",
    "write_optimized",
    "write_quarantine",
]
