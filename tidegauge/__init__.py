"""tidegauge: sensor-event analytics as DataFrame-to-DataFrame functions on Spark."""

from tidegauge.session import build_session, tune

__all__ = ["build_session", "tune"]
