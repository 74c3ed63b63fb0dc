"""Structured Streaming forms of the stateless filters and of event windows."""
