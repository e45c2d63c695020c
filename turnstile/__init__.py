"""Class-attendance analytics for membership businesses, as Spark DataFrame jobs."""

__version__ = "0.1.0"
