"""Incremental lakehouse tables on Spark: landed JSON in, merged typed tables out."""
