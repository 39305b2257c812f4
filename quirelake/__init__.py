"""A catalogue lake on Spark: landed JSON documents to curated tables."""
