"""sylva: a Spark-native engine for curating sequence catalogues over a taxonomy-like hierarchy."""

__version__ = "0.1.0"
