"""Telemetry-log analytics on Spark: log files in, time-stamped entity components out."""

__version__ = "0.1.0"
