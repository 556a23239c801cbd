"""Whole jobs: batch ingest, archive ETL, maintenance, and the registered queries."""
