"""Queries over the given tables, with comparison SQL where SQL can say the same."""

from stayline.checks import breakdowns, features, models, tables  # noqa: F401
from stayline.checks.registry import CHECKS, runner

__all__ = ["CHECKS", "runner"]
