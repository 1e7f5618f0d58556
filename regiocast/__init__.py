"""Monthly regional demand analytics expressed as Spark DataFrame and streaming jobs."""

__version__ = "0.1.0"
