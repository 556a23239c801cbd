"""Tidemark: multi-tenant metric-event ingest, archive and query operators on PySpark."""
