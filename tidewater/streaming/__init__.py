"""Structured Streaming jobs: staged-buffer loader (K4), intake, alerts."""
