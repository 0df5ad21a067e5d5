"""Queries and SQL of the training-data operators."""

from importlib import import_module

MODULES = ["warc", "line_frequency", "url_filter", "langid", "simhash", "bpe", "audio", "pii", "mixing", "toxicity", "license_scan", "hard_negatives", "lexical_search"]

_found = [import_module(f"tallyspark.llm.{x}") for x in MODULES]
QUERIES = {k: f for m in _found for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _found for k, s in m.ORACLES.items()}
