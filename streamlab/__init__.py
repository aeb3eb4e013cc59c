"""Event-stream, text and graph analytics as plain DataFrame functions on Spark."""

from streamlab.session import build_session

__all__ = ["build_session"]
