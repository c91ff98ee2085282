"""Nested, keyed business events on Spark: intake, keyed state, metrics, documents, views."""
