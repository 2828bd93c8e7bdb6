"""Structured Streaming: the micro-batch job, native state-store measures, replay feeder."""
