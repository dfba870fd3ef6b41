"""The operators applied to the test tables, each with an independent SQL statement of its result."""

from . import cleaning_entries, market_entries, model_entries, profile_entries, selection_entries, storage_entries  # noqa: F401
from . import account_entries  # noqa: F401, isort: skip
from .registry import ENTRIES, Entry

__all__ = ["ENTRIES", "Entry"]
