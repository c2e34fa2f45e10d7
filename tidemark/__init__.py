"""tidemark: event and transaction analytics written as Spark DataFrame operators."""

__version__ = "0.1.0"
