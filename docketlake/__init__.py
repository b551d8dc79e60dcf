"""docketlake: a PySpark-native analytics engine for large collections of public documents and comments."""

__version__ = "0.1.0"
