"""Daily summaries and activity analysis of event-like Parquet tables on Spark."""

__version__ = "0.1.0"
