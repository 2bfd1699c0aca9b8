"""Market time-series engine: Spark jobs over minute-level price feeds."""

__version__ = "0.1.0"
