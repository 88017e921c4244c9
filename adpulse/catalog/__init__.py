from adpulse.catalog import extension_oracles, extensions, oracles
from adpulse.catalog import queries as table_queries
from adpulse.catalog.queries import Query, flagship


def queries() -> dict[str, Query]:
    return {**table_queries.queries(), **extensions.queries()}


def oracle_sql() -> dict[str, str]:
    return {**oracles.oracle_sql(), **extension_oracles.oracle_sql()}


__all__ = ["flagship", "oracle_sql", "queries"]
