"""Registered queries: each operator on the star-schema tables, with its SQL where SQL can say it."""

from lapsewise.queries import activity, cleaning, evaluation, modelling, reports, scoring, segments, tables  # noqa: F401
from lapsewise.queries.base import REGISTRY


def callables() -> dict:
    return {name: entry.run for name, entry in REGISTRY.items()}


def oracles() -> dict:
    return {name: entry.sql for name, entry in REGISTRY.items() if entry.sql}
