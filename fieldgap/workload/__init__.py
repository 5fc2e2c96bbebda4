"""Queries over the given tables, and the feeds that Spark derives from them."""
