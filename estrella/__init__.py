"""Warehouse building blocks for Spark: staging, data quality, star schema, history, marts."""

from estrella.session import build_session, materialize, release_materialized

__all__ = ["build_session", "materialize", "release_materialized"]
