"""Registered queries over the driver tables, each with the SQL that it is checked against."""

from gleanery.plans import control_queries, curation, history_queries, vector_queries  # noqa: F401
