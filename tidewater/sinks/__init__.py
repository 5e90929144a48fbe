"""Sinks (K1-K3, K5); the streaming loader K4 is in :mod:`tidewater.streaming.load`."""
