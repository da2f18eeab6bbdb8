"""Readers, fixture views over the driver tables, and sinks."""
