"""Composed plans, from raw messages to documents and track points."""
