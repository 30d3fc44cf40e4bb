"""Gives executors this package; the helper is the library's own."""

from tillwright.shipping import ship

__all__ = ["ship"]
