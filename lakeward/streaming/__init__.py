"""Structured Streaming steps built from the batch operators."""
