"""DataFrame operators: compaction shapes, views, curation, frontier, skew."""
