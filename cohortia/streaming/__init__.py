"""Structured Streaming versions of the 15-minute metrics and alerts."""
