"""Structured Streaming surfaces."""
