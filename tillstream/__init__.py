"""Invoice-line analytics on Spark: parsing, totals, anomaly models, live feeds."""

__version__ = "0.1.0"
