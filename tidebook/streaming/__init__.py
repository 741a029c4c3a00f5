"""Structured Streaming forms of the tape features, the sampling fold, and the action sink."""
