"""Picking up newly landed payload files."""

from .landing import land_payloads, payload_stream

__all__ = ["land_payloads", "payload_stream"]
