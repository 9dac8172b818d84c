"""Incremental (availableNow) forms of the batch loops."""
