"""Triage of large paper collections as Spark DataFrame and streaming jobs."""

from paperloom.config import FilterConfig
from paperloom.plans.run import run_month, run_window
from paperloom.plans.store import PaperStore

__all__ = ["FilterConfig", "PaperStore", "run_month", "run_window"]
