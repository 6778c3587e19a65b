"""basketry — Spark-native retail loyalty and reorder analytics."""

__version__ = "0.1.0"
