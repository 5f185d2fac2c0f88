"""fieldlens: analytics on long-format experiment data, expressed as Spark DataFrame plans."""

__version__ = "0.1.0"
