"""Maintenance of fact tables whose rows keep changing for a while after they land."""

from tidemark.functions import lookback_window
from tidemark.plans import rebuild, rebuild_dates, repair, validation
from tidemark.session import build_session

__all__ = ["build_session", "lookback_window", "rebuild", "rebuild_dates", "repair", "validation"]
