"""Structured Streaming form of the micro-batch consumer."""
