"""Queries over the shared tables: one per operator, with the SQL that gives the same rows."""

from __future__ import annotations

from feedloom.plans.registry import REGISTRY


def load_all() -> dict:
    from feedloom.plans import (  # noqa: F401
        catalog_queries,
        column_queries,
        feed_queries,
        flagship,
        nested_queries,
        quality_queries,
        relational_queries,
        state_queries,
        stream_queries,
        view_queries,
    )

    return REGISTRY
