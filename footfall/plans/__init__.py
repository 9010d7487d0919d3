"""The reports, and the run that computes and delivers all of them."""

from footfall.plans.reports import (
    category_session_top,
    category_top,
    page_conversion,
    session_extract,
    session_stats,
)
from footfall.plans.run import run_all

__all__ = [
    "category_session_top",
    "category_top",
    "page_conversion",
    "run_all",
    "session_extract",
    "session_stats",
]
