"""K5: where each layer of the lake lives.

    raw/{platform}/{target}/YYYY/MM/DD/...json           landed documents
    historical/merged/{platform}/{target}/landing_date=/batch=   resumable compaction
    historical/optimized/{target}/platform=/landing_date=        compacted history
    optimized/{target}/year=/month=/day=/platform=        compacted days
    processed/{table}/year=/month=/day=/platform=         curated tables
    quarantine/year=/month=/day=/platform=/target=        documents a run could not take whole
    temp/{platform}/{target}                              backups, staged targets
    checkpoints/{platform}/...                            ledgers of compaction and later stages
"""

from collections.abc import Iterable
from datetime import date

from quirelake.conventions import FLAT_TARGETS


def braces(names: Iterable[str]) -> str:
    """A glob for a set of names."""
    names = list(names)
    return names[0] if len(names) == 1 else "{" + ",".join(names) + "}"


def landing_folder(root: str, platform: str, target: str) -> str:
    return f"{root}/raw/{platform}/{target}"


def landing_path(
    root: str,
    platform: str,
    target: str,
    dates: Iterable[date] | None = None,
    folders: Iterable[str] | None = None,
) -> str:
    """Where the files of a target lie, for all or the given dates and title folders.

    Only named folders are globbed.  Everything below them is left to Spark's
    recursive listing, which is a distributed job when there are many folders;
    a ``*`` over title folders would be listed one by one on the driver.
    """
    path = landing_folder(root, platform, target)
    if dates is not None:
        path += "/" + braces(f"{d:%Y/%m/%d}" for d in dates)
    if folders is not None and target not in FLAT_TARGETS:
        days = "" if dates is not None else "/*/*/*"
        path += f"{days}/" + braces(str(f) for f in folders)
    return path


def depth(target: str) -> int:
    """How many names, from its year on, end the path of a file of a target."""
    return 4 if target in FLAT_TARGETS else 5


#: The last names of a path (see ``depth``) that lies where the layout puts it.
FILE_PATTERN = r"^\d{4}/\d{2}/\d{2}/"


def day_partition(d: date) -> str:
    return f"year={d:%Y}/month={d:%m}/day={d:%d}"


def merged_path(root: str, platform: str, target: str) -> str:
    return f"{root}/historical/merged/{platform}/{target}"


def checkpoint_path(root: str, platform: str, target: str) -> str:
    return f"{root}/checkpoints/{platform}/{target}"


def covered_path(root: str, platform: str, stage: str) -> str:
    return f"{root}/checkpoints/{platform}/covered/{stage}"


def staged_path(root: str, platform: str, target: str) -> str:
    return f"{root}/temp/staged/{platform}/{target}"


def history_root(root: str, target: str) -> str:
    return f"{root}/historical/optimized/{target}"


def optimized_root(root: str, target: str) -> str:
    return f"{root}/optimized/{target}"


def curated_root(root: str, table: str) -> str:
    return f"{root}/processed/{table}"


def quarantine_root(root: str) -> str:
    return f"{root}/quarantine"


def backup_path(root: str, platform: str, target: str) -> str:
    return f"{root}/temp/{platform}/{target}"
