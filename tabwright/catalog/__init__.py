"""Every operator as a named query over the shared tables, with the same result in SQL."""

from tabwright.catalog.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "load_all"]


def load_all() -> None:
    """Import the modules that register queries."""
    from tabwright.catalog import (  # noqa: F401
        columns,
        features,
        flows,
        lookups,
        profiles,
        rows,
        samples,
        stored,
        texts,
    )
