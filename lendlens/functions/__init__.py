from lendlens.functions import exprs, quantiles, stats_math  # noqa: F401
