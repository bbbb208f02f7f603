"""Readers, table sinks and the synthetic customer source."""
