"""All registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

import importlib

MODULES = ("decontaminate", "toxicity", "packing", "tokens", "language", "warc", "extraction", "surrogates", "jaccard", "vectors", "phrases", "walks", "codebooks")


def _modules():
    return [importlib.import_module(f"{__package__}.{name}") for name in MODULES]


QUERIES = {name: query for module in _modules() for name, query in module.QUERIES.items()}
ORACLE = {name: sql for module in _modules() for name, sql in module.ORACLE.items()}
