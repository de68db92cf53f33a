from tidemark.functions.bands import BANDS, Band, by_band
from tidemark.functions.dates import (
    LOOKBACK_DAYS,
    Window,
    in_window,
    lookback_window,
    on_dates,
    window_spine,
)
from tidemark.functions.fingerprint import checksum_aggregates

__all__ = [
    "BANDS",
    "Band",
    "LOOKBACK_DAYS",
    "Window",
    "by_band",
    "checksum_aggregates",
    "in_window",
    "lookback_window",
    "on_dates",
    "window_spine",
]
