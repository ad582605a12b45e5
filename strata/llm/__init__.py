"""Training-data operators (mixing, dedup, language, toxicity, licences, tokens, ...).

Functions of this subpackage travel to the executors by value, so the workers need only
Spark's Python dependencies, not an installed copy of this package.
"""

import importlib

from pyspark import cloudpickle

MODULES = [
    "common", "graph", "mixing", "substring", "language", "simhash", "text_stats",
    "quality_rules", "toxicity", "licenses", "token_store", "rule_ensemble",
    "decontaminate", "stages", "queries",
]

for _name in MODULES:
    cloudpickle.register_pickle_by_value(importlib.import_module(f"{__name__}.{_name}"))
