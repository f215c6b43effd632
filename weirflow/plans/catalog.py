"""All registered queries and their oracles."""

from weirflow.plans import database, models, popularity, scans, storage, streams

MODULES = (popularity, scans, storage, database, streams, models)


def all_queries():
    return {name: run for m in MODULES for name, run in m.plans.queries.items()}


def all_oracles():
    return {name: sql for m in MODULES for name, sql in m.plans.oracles.items()}
