"""gapweave: irregular, event-style series turned into gap-aware sequences on Spark."""

__version__ = "0.1.0"
