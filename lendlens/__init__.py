"""lendlens: credit-risk data preparation, profiling and modelling on Spark."""

__version__ = "0.1.0"
