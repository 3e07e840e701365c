"""Training-data operators: one module per operator, each with its general
interface and a thin ``op<N>`` query over the given tables. Nothing outside this
subpackage imports it, except ``__spark_entry__.py`` and ``corpus_pipeline.py``.
"""

import sys

from pyspark import cloudpickle

import cuenca

# Python workers get the operators' functions by value, so a job runs from any
# folder and on executors that do not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules["cuenca"])

MODULES = ("decontaminate", "ngram_join", "html_extract", "quality_llr", "pii", "token_files", "toxicity",
           "secrets", "licenses", "mixing", "merkle", "fim", "ctph")


def load() -> tuple[dict, dict]:
    """(queries, oracle SQL) of every operator module."""
    import importlib
    queries, sql = {}, {}
    for m in MODULES:
        mod = importlib.import_module(f"cuenca.llm.{m}")
        queries[mod.NAME] = mod.query
        if mod.SQL:
            sql[mod.NAME] = mod.SQL
    return queries, sql
