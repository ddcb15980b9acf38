"""All queries of the text operators and their SQL checks."""

import importlib

from .common import ORACLE, QUERIES

MODULES = ["simhash", "pii", "language", "toxicity", "decontaminate", "token_counts", "packing", "token_files",
           "quality", "licenses", "alignment", "line_dedup", "hard_negatives"]


def queries():
    for name in MODULES:
        importlib.import_module(f"{__package__}.{name}")
    return dict(QUERIES)


def oracle_sql():
    queries()
    return dict(ORACLE)
