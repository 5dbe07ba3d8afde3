from tickloom.functions.parsed import fields_once, once
from tickloom.functions.signals import (
    risk_band,
    signal_band,
    signal_or_fallback,
    strong_prediction,
    trend_label,
)
from tickloom.functions.stats import exact_mean
from tickloom.functions.ticks import (
    is_anomaly,
    price_change,
    price_change_pct,
    spread,
    to_event_time,
)

__all__ = [
    "exact_mean",
    "fields_once",
    "is_anomaly",
    "once",
    "price_change",
    "price_change_pct",
    "risk_band",
    "signal_band",
    "signal_or_fallback",
    "spread",
    "strong_prediction",
    "to_event_time",
    "trend_label",
]
