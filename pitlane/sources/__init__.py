"""Readers, fixture projections and sinks."""
