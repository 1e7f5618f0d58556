from regiocast.catalog.registry import QUERIES, Query, register

__all__ = ["QUERIES", "Query", "register", "load_all"]


def load_all() -> dict[str, Query]:
    """Import every query module once and return the filled registry."""
    from regiocast.catalog import (aggregates, decisions, features, forecasts,  # noqa: F401
                                   joins, metrics, quality, questions, refresh, scans, windows)
    return QUERIES
