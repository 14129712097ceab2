"""Trip analytics on Spark: ingest trip records, conform them into a star
schema and answer weekly-average questions, all as DataFrame plans."""

__version__ = "0.1.0"
