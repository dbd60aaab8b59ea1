"""Registered queries over the driver tables, each with its SQL twin where SQL can express it."""

from __future__ import annotations

from . import associations, charts, cleaning, features, modelling, profiles, segments, series, sources

_MODULES = (sources, profiles, cleaning, features, segments, associations, modelling, series, charts)


def all_queries() -> dict:
    return {name: query for m in _MODULES for name, query in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in _MODULES for name, sql in m.SQL.items()}
