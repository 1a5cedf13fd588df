"""regionlake: territorial analytics as Spark DataFrame and stream jobs."""

__version__ = "0.1.0"
