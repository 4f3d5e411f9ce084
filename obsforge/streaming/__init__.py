"""Structured Streaming form of the row feed."""
