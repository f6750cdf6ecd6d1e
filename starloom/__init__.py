"""starloom: a Spark-native star-schema builder and data-quality checker for order extracts."""

__version__ = "0.1.0"
