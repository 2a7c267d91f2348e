"""framewise — frames, hand geometry, models and survey analytics on Spark."""

__version__ = "0.1.0"
