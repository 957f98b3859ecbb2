"""souche: a Spark-first engine for name records, their texts and their links."""

__version__ = "0.1.0"
