"""Named queries over the shared test tables, each with its SQL twin where there is one."""

from brookmill.plans.registry import QUERIES, Query, query

__all__ = ["QUERIES", "Query", "query", "load_all"]


def load_all() -> dict[str, Query]:
    """Import every module of named queries and return them by name."""
    from brookmill.plans import (  # noqa: F401
        aggregates,
        changes,
        functions,
        joins,
        logs,
        merges,
        rollups,
        scans,
        sensors,
        sorting,
        streams,
        videos,
    )

    return QUERIES
