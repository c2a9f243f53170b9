"""Readers and writers for raw trips and model tables."""
