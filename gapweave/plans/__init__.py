"""The whole preparation as one plan, and its statistics."""

from gapweave.plans.pipeline import Prepared, prepare, process

__all__ = ["Prepared", "prepare", "process"]
