"""Incremental jobs: what has landed since the last run, and nothing else."""

from quirelake.streaming.compaction import compact, read_merged
from quirelake.streaming.ledger import pending, read_ledger, uncovered

__all__ = ["compact", "pending", "read_ledger", "read_merged", "uncovered"]
