"""Customer-churn analytics as Spark jobs."""

__version__ = "1.0.0"
