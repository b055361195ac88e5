"""millrace: scale-safe analytics operators on the PySpark DataFrame, SQL, ML and streaming APIs."""

__version__ = "0.1.0"
