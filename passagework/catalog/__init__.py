"""Every operator as a query over the given tables, with the equivalent SQL where there is one."""

from passagework.catalog import chat, compose, search, tables, text

_PARTS = (tables, text, search, chat, compose)


def all_queries() -> dict:
    return {name: query for part in _PARTS for name, query in part.QUERIES.items()}


def all_oracles() -> dict[str, str]:
    return {name: sql for part in _PARTS for name, sql in part.ORACLES.items()}
