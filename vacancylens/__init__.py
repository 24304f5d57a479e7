"""Job-posting analytics as Spark DataFrame operators and a streaming ingest."""

__version__ = "0.1.0"
