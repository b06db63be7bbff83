"""Readers, writers, layer stores and input adapters."""
