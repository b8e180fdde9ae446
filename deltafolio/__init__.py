"""Edition-change analytics on Spark: typed blocks, matching, change logs, classification and reports."""

__version__ = "0.1.0"
