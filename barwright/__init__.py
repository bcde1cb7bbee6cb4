"""Daily market bars on Spark: bronze, silver and gold tables as DataFrame jobs."""

__version__ = "0.1.0"
