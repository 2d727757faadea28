"""Operators for preparing language-model training text, one module each.

Nothing outside this folder imports it. ``queries.py`` applies each operator to its whole table;
``corpus_pipeline.py`` at the repository top chains five of them.
"""
