"""Marker-framed XML track messages on PySpark."""
