"""Operators that clean, deduplicate, label and pack text corpora for model training.

Nothing outside this package imports it. Each module holds one operator with its
own interface; ``queries.py`` holds the thin registered queries and their SQL.
"""
