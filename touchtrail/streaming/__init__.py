"""Streaming form of the daily raw append."""

from .daily_append import append_new_files

__all__ = ["append_new_files"]
