"""Readers, sinks, seeds and incremental loading."""
