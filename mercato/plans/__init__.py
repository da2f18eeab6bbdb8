"""Batch plans: staging, warehouse, aggregates, reads, micro-batch, roll-ups, pipeline."""
