"""Question-and-answer corpus preparation as composable Spark DataFrame functions."""

__version__ = "0.1.0"
