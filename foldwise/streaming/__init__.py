"""Structured Streaming surface: stateless batch scoring of a stream."""
