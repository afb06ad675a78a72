"""Queries by name, each with the SQL that must give the same rows."""

from . import aggregate_queries, dataset_queries, log_queries, relational_queries, run_queries, service_queries, text_queries  # noqa: F401
