"""Query catalogue (Spark side) and its SQL twins (oracle side)."""


def all_queries():
    """``{name: (fn, sql | None)}`` with every module's entries registered."""
    from salesboard.plans import catalog, client_queries, live_queries  # noqa: F401
    return dict(catalog.QUERIES)
