"""Structured Streaming jobs: landing -> bronze, and bronze -> live tables."""
