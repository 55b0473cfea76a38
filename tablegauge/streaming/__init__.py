"""Streaming: drift monitoring of batch files as they arrive."""
from tablegauge.streaming.drift_monitor import run_drift_monitor_once, start_drift_monitor  # noqa: F401
