"""Manifest-driven file intake on Spark: check, load, publish, archive, log."""

from quayside.config import IntakeConfig
from quayside.plans.run import load_category

__all__ = ["IntakeConfig", "load_category"]
