"""Whole jobs: the index build and the registered queries."""


def all_queries():
    """``(queries, check SQL)`` of every query module."""
    from marquee.plans import catalogue_queries, dense_queries, search_queries, store_queries, text_queries  # noqa: F401
    from marquee.plans.registry import CHECK_SQL, QUERIES

    return dict(QUERIES), dict(CHECK_SQL)
