"""Commerce warehouse on Spark: contracts, quarantine, facts, metrics, checks, releases."""

__version__ = "0.1.0"
