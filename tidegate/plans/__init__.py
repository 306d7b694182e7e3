"""The operators put together: silver and quarantine, the gated publish, and whole runs."""

from tidegate.plans.pipeline import run_folder, run_landed, run_pages
from tidegate.plans.publish import publish_gold
from tidegate.plans.silver import silver_of, transform

__all__ = ["publish_gold", "run_folder", "run_landed", "run_pages", "silver_of", "transform"]
