"""Structured Streaming form of the nightly load."""
