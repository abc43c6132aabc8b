"""News-to-procurement analytics on PySpark: DataFrame operators, sources and streams."""

__version__ = "0.1.0"
