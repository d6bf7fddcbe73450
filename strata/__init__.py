"""strata: layered retail analytics (raw, staging, core, analytics) on Spark."""

__version__ = "0.1.0"
