"""Readers: binary depth logs, trade files, and adapters from the generic tables."""
