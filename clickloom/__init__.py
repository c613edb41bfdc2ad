"""clickloom: clickstream quality, sessions, attribution and monitoring on Spark."""

from clickloom.config import Config, MonitorLimits, QualityLimits

__all__ = ["Config", "MonitorLimits", "QualityLimits"]
