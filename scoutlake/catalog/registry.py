"""All registered queries and checks."""

import importlib

from . import views

MODULES = ["sources", "shaping", "aggregates", "windows", "resolution", "ratings", "similarity", "charts", "jobs"]


def _load():
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")


def queries():
    _load()
    return dict(views._QUERIES)


def oracle_sql():
    _load()
    return dict(views._SQL)
