"""finquarry: banking and warehouse analytics operators as PySpark DataFrame functions."""

__version__ = "0.1.0"
