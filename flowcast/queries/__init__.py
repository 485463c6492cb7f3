"""Registered queries over the supplied tables, each beside its SQL equivalent."""

from flowcast.queries import files, models, nesting, series

MODULES = (series, nesting, files, models)


def all_queries():
    return {name: run for module in MODULES for name, run in module.QUERIES.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
