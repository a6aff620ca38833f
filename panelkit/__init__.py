"""Panel analytics on Spark: clean, profile, aggregate, test, model, cluster, forecast and mine text."""

__version__ = "0.1.0"
