"""Operators from frames to frames."""
