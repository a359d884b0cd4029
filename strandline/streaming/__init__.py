"""Adapters for streams."""
