"""Market-bar analytics on Spark: raw daily bars in, return and risk tables out."""

__version__ = "0.1.0"
