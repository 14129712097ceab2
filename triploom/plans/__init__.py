"""Composed jobs: batch ingest, the registered query catalog and its
reference SQL."""
